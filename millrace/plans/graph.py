"""Run many tables for a date: each as soon as the tables it reads are loaded."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target

from millrace.plans.lake import Lake
from millrace.plans.runner import ALL_TABLES, RunResult, run
from millrace.plans.spec import TableSpec

log = logging.getLogger(__name__)

#: Session settings under which tables that run together share the executors.
FAIR = {"spark.scheduler.mode": "FAIR"}
POOL = "spark.scheduler.pool"


@dataclass(frozen=True)
class Outcome:
    """What became of one table: loaded, empty, failed or skipped, and why."""

    table: str
    status: str
    rows: int = 0
    why: str = ""
    result: RunResult | None = None
    error: Exception | None = None

    @property
    def ok(self) -> bool:
        return self.status in ("loaded", "empty")


def dependencies(tables: Iterable[TableSpec]) -> dict[str, set[str]]:
    """Which of the given tables each of them reads; others must be there already."""
    specs = {spec.path.strip("/"): spec for spec in tables}
    return {
        path: {read.strip("/") for read in spec.reads} & set(specs) for path, spec in specs.items()
    }


def run_graph(
    lake: Lake,
    day: dt.date,
    tables: Iterable[TableSpec] = ALL_TABLES,
    at_once: int = 4,
    load: Callable[[Lake, TableSpec, dt.date], RunResult] = run,
) -> dict[str, Outcome]:
    """Load tables, ``at_once`` at most together, and tell what became of each.

    A table waits for those it reads and for no others. One that fails stops
    only the tables that read it, directly or through others: they are skipped,
    and what they hold stays as it was. Every table runs in a scheduler pool of its
    own, so with a FAIR scheduler a small table does not queue behind the stages of
    a large one. All work on rows is in the tables' own Spark jobs; a thread
    here only waits for them. Tables that read each other in a circle fail before
    anything is loaded.
    """
    specs = {spec.path.strip("/"): spec for spec in tables}
    needs = dependencies(specs.values())
    order = TopologicalSorter(needs)
    order.prepare()
    outcomes: dict[str, Outcome] = {}
    running: dict[Future, str] = {}
    context = lake.spark.sparkContext

    def one(path: str) -> RunResult:
        context.setLocalProperty(POOL, path)
        try:
            return load(lake, specs[path], day)
        finally:
            context.setLocalProperty(POOL, None)

    def settled(outcome: Outcome) -> None:
        outcomes[outcome.table] = outcome
        order.done(outcome.table)

    with ThreadPoolExecutor(at_once, thread_name_prefix="table") as threads:
        while order.is_active():
            for path in order.get_ready():
                broken = sorted(p for p in needs[path] if not outcomes[p].ok)
                if broken:
                    log.warning("%s: skipped, as %s did not load", path, ", ".join(broken))
                    settled(Outcome(path, "skipped", why=f"not loaded: {', '.join(broken)}"))
                else:
                    running[threads.submit(inheritable_thread_target(lake.spark)(one), path)] = path
            if not running:
                continue
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                path = running.pop(future)
                error = future.exception()
                if error is None:
                    result = future.result()
                    settled(Outcome(path, result.status, result.rows, result=result))
                elif isinstance(error, Exception):
                    log.error("%s: failed: %s", path, error)
                    settled(Outcome(path, "failed", why=str(error)[:500], error=error))
                else:
                    raise error
    return {path: outcomes[path] for path in specs}

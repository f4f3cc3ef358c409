"""What a table has read of the event lines: which batches, by day."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from millrace.sources.files import create_text, delete_tree, matching, read_text


@dataclass(frozen=True)
class Seen:
    """All of the batches up to ``up_to``, and of later ones those listed by day."""

    up_to: int = -1
    days: dict[str, list[int]] = field(default_factory=dict)

    def has(self, day: dt.date, batch: int) -> bool:
        return batch <= self.up_to or batch in self.days.get(day.isoformat(), ())

    def after(self, read: Iterable[tuple[dt.date, int]], complete: int) -> Seen:
        """With more read, when nothing is left of the batches up to ``complete``."""
        up_to = max(self.up_to, complete)
        pairs = {(day, batch) for day, batches in self.days.items() for batch in batches}
        pairs |= {(day.isoformat(), batch) for day, batch in read}
        days: dict[str, list[int]] = {}
        for day, batch in sorted(pairs):
            if batch > up_to:
                days.setdefault(day, []).append(batch)
        return Seen(up_to, days)


class SeenLog:
    """The state in numbered files, of which the last counts; one table writes it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self) -> list[str]:
        return sorted(matching(self.spark, f"{self.path}/*.json"))

    def read(self) -> Seen:
        files = self._files()
        return Seen(**json.loads(read_text(self.spark, files[-1]))) if files else Seen()

    def write(self, seen: Seen) -> None:
        files = self._files()
        number = int(files[-1].rsplit("/", 1)[1].removesuffix(".json")) + 1 if files else 1
        text = json.dumps({"up_to": seen.up_to, "days": seen.days})
        create_text(self.spark, f"{self.path}/{number:010d}.json", text)
        for old in files[:-1]:
            delete_tree(self.spark, old)

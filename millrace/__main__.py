"""Load tables for one run date: ``spark-submit`` or ``python -m millrace``."""

from __future__ import annotations

import argparse
import logging
import sys

from millrace.functions.calendar import run_date
from millrace.plans.graph import FAIR, run_graph
from millrace.plans.lake import Lake
from millrace.plans.runner import ALL_TABLES, LATE_TABLES, find_table
from millrace.session import build_session
from millrace.sources.documents import collection_documents, json_documents
from millrace.sources.relational import JdbcRelations


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    parser.add_argument("--execution_date", required=True, type=run_date)
    parser.add_argument("--environment", required=True)
    parser.add_argument("--owner", required=True)
    parser.add_argument("--root", required=True, help="folder that holds the layers")
    parser.add_argument(
        "--table", action="append", help="layer/source/table; all tables if left out"
    )
    parser.add_argument("--tables_at_once", type=int, default=4)
    parser.add_argument(
        "--late_events", action="store_true",
        help="take events of earlier days that arrived late, and count their facts anew",
    )
    parser.add_argument("--jdbc_url")
    parser.add_argument("--jdbc_user", default="")
    parser.add_argument("--jdbc_password", default="")
    parser.add_argument("--jdbc_schema", default="")
    parser.add_argument("--jdbc_window_reads", type=int, default=8)
    parser.add_argument("--documents_path", help="JSON export of the equipment documents")
    parser.add_argument("--mongo_uri")
    parser.add_argument("--mongo_database")
    parser.add_argument("--mongo_collection")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session("millrace", **FAIR)
    relations = None
    if args.jdbc_url:
        login = {"user": args.jdbc_user, "password": args.jdbc_password}
        relations = JdbcRelations(
            spark,
            args.jdbc_url,
            args.jdbc_schema,
            {k: v for k, v in login.items() if v},
            window_reads=args.jdbc_window_reads,
        )

    def documents():
        if args.documents_path:
            return json_documents(spark, args.documents_path)
        return collection_documents(
            spark, args.mongo_uri, args.mongo_database, args.mongo_collection
        )

    lake = Lake(spark, args.root, args.environment, relations, documents, args.owner)
    known = LATE_TABLES if args.late_events else ALL_TABLES
    tables = [find_table(path, known) for path in args.table] if args.table else known
    outcomes = run_graph(lake, args.execution_date, tables, args.tables_at_once)
    for outcome in outcomes.values():
        logging.info("%s: %s, %d rows %s", outcome.table, outcome.status, outcome.rows, outcome.why)
    spark.stop()
    if not all(outcome.ok for outcome in outcomes.values()):
        sys.exit(1)


if __name__ == "__main__":
    main()

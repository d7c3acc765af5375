"""The daily report job: ``spark-submit -m natspark.job`` or ``python -m natspark.job``; it fails if a case fails."""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from natspark.functions.times import OFFSET_S
from natspark.operators import runner
from natspark.sources.sessions import read_sessions


def yesterday(now_s: float) -> datetime.date:
    """The last whole day at the sessions' offset from UTC."""
    local = datetime.datetime.fromtimestamp(now_s + OFFSET_S, datetime.timezone.utc)
    return local.date() - datetime.timedelta(days=1)


def address(text: str) -> int:
    parts = [int(p) for p in text.split(".")]
    if len(parts) != 4 or not all(0 <= p < 256 for p in parts):
        raise ValueError(f"{text} isn't an address")
    return int.from_bytes(bytes(parts), "big")


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """The exit status: 1 if a case failed. A dry run prints each case's plan and writes nothing."""
    parser = argparse.ArgumentParser(prog="natspark.job")
    parser.add_argument("--sessions", required=True, help="the session table")
    parser.add_argument("--out", required=True, help="where the reports are published")
    parser.add_argument("--nodes", required=True, nargs="+")
    parser.add_argument("--date", type=datetime.date.fromisoformat, default=yesterday(datetime.datetime.now().timestamp()))
    parser.add_argument("--cases", nargs="+", choices=list(runner.CASES))
    parser.add_argument("--public-ip", nargs="*", type=address, default=[])
    parser.add_argument("--dry-run", action="store_true")
    given = parser.parse_args(args)
    cases = given.cases or [c for c in runner.CASES if c != runner.BY_ADDRESS or given.public_ip]
    if runner.BY_ADDRESS in cases and not given.public_ip:
        parser.error(f"{runner.BY_ADDRESS} asks for --public-ip")
    spark = spark or SparkSession.builder.appName("natspark").getOrCreate()
    if given.dry_run:
        sessions = read_sessions(spark, given.sessions, given.date, given.nodes)
        for case in cases:
            print(case)
            (runner.CASES[case](sessions, given.public_ip) if case == runner.BY_ADDRESS else runner.CASES[case](sessions)).explain("formatted")
        return 0
    status = runner.run_reports(spark, given.sessions, given.date, cases, given.out, given.nodes, given.public_ip).collect()
    for r in status:
        print(f"{r.case} {r.data_date} rows={r.rows} error={r.error}")
    return int(any(r.error for r in status))


if __name__ == "__main__":
    raise SystemExit(main())

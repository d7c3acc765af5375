"""A day's reports side by side: one that fails neither stops nor taints the others."""

from __future__ import annotations

import datetime
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.operators import reports
from natspark.sources.sessions import publish_partition, read_sessions
from natspark.sources.shared import stored

CASES: dict[str, Callable[..., DataFrame]] = {
    "public_ip_pool": reports.public_ip_pool,
    "subscribers_of_public_ip": reports.subscribers_of_public_ip,
    "hourly_nat_load": reports.hourly_nat_load,
    "smtp_abuse": reports.smtp_abuse,
    "top_service_ports": reports.top_service_ports,
    "router_hour_observations": reports.router_hour_observations,
    "public_ip_sharing_hour": reports.public_ip_sharing_hour,
}
BY_ADDRESS = "subscribers_of_public_ip"
STATUS = "case string, data_date date, rows bigint, error string"


def run_reports(
    spark: SparkSession, path: str, day: datetime.date, cases: Iterable[str], out: str, nodes: Iterable[str], ips: Iterable[int] = (), parallel: int = 4
) -> DataFrame:
    """Run ``cases`` over one day of the session table and publish each with the time of loading (``loaded_at``);
    returns a status row per case. The subscribers of each address are a partition of their own, so that one address
    doesn't replace another. Cases read their own columns of the day's partitions and nothing else. Jobs of different
    threads share the executors if the session's scheduler mode is FAIR."""
    cases, nodes, ips = list(cases), list(nodes), list(ips)
    loaded_at = F.timestamp_seconds(F.lit(int(time.time())))

    def one(case: str) -> tuple[str, datetime.date, int | None, str | None]:
        try:
            sessions = read_sessions(spark, path, day, nodes)
            if case != BY_ADDRESS:
                return case, day, publish_partition(CASES[case](sessions).withColumn("loaded_at", loaded_at), f"{out}/{case}", data_date=day), None
            report = stored(CASES[case](sessions, ips).withColumn("loaded_at", loaded_at), case)
            rows = [publish_partition(report.where(F.col("public_ip") == ip), f"{out}/{case}", data_date=day, public_ip=ip) for ip in ips]
            return case, day, sum(rows), None
        except Exception as e:
            return case, day, None, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"

    with ThreadPoolExecutor(parallel) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(one), cases))
    return spark.createDataFrame(found, STATUS)

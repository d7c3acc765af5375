"""Live incidents: the state of each series is kept by Spark and survives restarts."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import astuple
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from natspark.operators.health import RETENTION_S
from natspark.operators.incidents import KEYS, VERSIONS, Rule, State, fold, tick_columns, tick_tuples, version_rows

STATE = "active boolean, breaches int, clears int, incident bigint, start bigint, peak double, emitted bigint, dirty boolean, version bigint, held array<struct<tick:bigint,indicator:double,valid:boolean,denominator:bigint>>"


def stream_incidents(
    ticks: DataFrame, threshold: float, clear: float, trigger: int = 1, clear_n: int = 3, update_s: int = 60, min_batches: int = 0, delay_s: int = RETENTION_S
) -> DataFrame:
    """Versions of incidents from a stream of ticks; append them with an idempotent sink keyed by incident and version.

    Ticks may come in any order within ``delay_s`` seconds: a tick is held until the watermark has passed it, and is
    folded then, after all earlier ones. State is bounded by the ticks of that time. Later ticks are dropped (Spark
    counts them), and so are those without a second; ticks of one second are folded as they came."""
    rule = Rule(threshold, clear, trigger, clear_n, min_batches)

    def run(key: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        *values, held = kept.get if kept.exists else (*astuple(State()), [])
        state = State(*values)
        waiting = [tuple(t) for t in held]
        for frame in frames:
            waiting += tick_tuples(frame)
        waiting.sort(key=itemgetter(0))
        due = bisect_right(waiting, kept.getCurrentWatermarkMs() // 1000, key=itemgetter(0))
        yield version_rows(key, list(fold(state, waiting[:due], rule, update_s)))
        kept.update((*astuple(state), waiting[due:]))
        if waiting[due:]:
            kept.setTimeoutTimestamp(waiting[due][0] * 1000 - 1)

    timed = tick_columns(ticks).where("tick is not null").withColumn("at", F.timestamp_seconds("tick")).withWatermark("at", f"{delay_s} seconds")
    return timed.groupBy(*KEYS).applyInPandasWithState(run, VERSIONS, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def watermarked(events: DataFrame, retention_s: int = RETENTION_S) -> DataFrame:
    """Events whose cohort is no older than the retention, measured against the newest one."""
    return events.withWatermark("cohort_time", f"{retention_s} seconds")

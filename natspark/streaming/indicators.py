"""Live indicators: the windows before each tick as they were known at it, for every host, silent ones too.

State of a host: a map from cohort second, of those at which windows may begin, to the events from it to the next, summed by
kind and by the second in which they were done, and the next tick. A tick is due when the watermark has passed it: all events done by then have come, in whatever
order and micro-batches, so results don't depend on either. A timer stands at the next tick, and fires for hosts
without events as well. Seconds that no later window reaches are dropped, which bounds the state by the longest window
and the watermark's delay.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from natspark.operators.health import RETENTION_S, SLA_S, STEP_S, WINDOW_S

ALERTS = ("no_traffic", "drop_rate", "parse_sla", "insert_sla")
KINDS = ("received", "parsed", "inserted", "dropped")
INDICATORS = "host string, alert string, tick timestamp, window_start timestamp, indicator double, numerator bigint, denominator bigint, valid boolean"
#: What is kept of an event: when it was done, its kind by place in ``KINDS``, and sums.
CELL = np.dtype([("done", "<i8"), ("kind", "<i8"), ("packets", "<i8"), ("rows", "<i8")])
#: New events that are summed at a time.
HELD = 1_000_000
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _added(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Cells of one second, one for each moment and kind."""
    both = np.concatenate([old, new])
    return _summed(np.zeros(len(both), np.int64), both)[1]


def _summed(second: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells with their seconds, one for each second, moment and kind, in this order."""
    order = np.lexsort((cells["kind"], cells["done"], second))
    second, cells = second[order], cells[order]
    new = np.ones(len(cells), bool)
    new[1:] = (second[1:] != second[:-1]) | (cells["done"][1:] != cells["done"][:-1]) | (cells["kind"][1:] != cells["kind"][:-1])
    out, begin = cells[new], np.flatnonzero(new)
    if len(begin):
        for c in ("packets", "rows"):
            out[c] = np.add.reduceat(cells[c], begin)
    return second[new], out


class Indicators(StatefulProcessor):
    def __init__(self, window_s: int, step_s: int, sla_s: int, min_packets: int, min_rows: int):
        self.window, self.step, self.sla, self.min_packets, self.min_rows = window_s, step_s, sla_s, min_packets, min_rows
        #: Windows begin and end at multiples of it, so seconds between two are one in the state.
        self.grain = gcd(window_s, step_s, sla_s)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seconds = handle.getMapState("seconds", "second long", "cells binary")
        self.clock = handle.getValueState("clock", "tick long, started boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        tick, started = self.clock.get() if self.clock.exists() else (None, False)
        first, new, n = tick, [], 0
        for frame in rows:
            frame = frame[frame["kind"].isin(KINDS)].dropna(subset=["second", "done"])
            if not len(frame):
                continue
            if not started:
                due = -(-int(frame["done"].min()) // self.step) * self.step
                first = due if first is None else min(first, due)
            cells = np.zeros(len(frame), CELL)
            cells["done"], cells["packets"], cells["rows"] = frame["done"], frame["packets"].fillna(0), frame["rows"].fillna(0)
            cells["kind"] = frame["kind"].map(KINDS.index)
            new.append((frame["second"].to_numpy(np.int64) // self.grain * self.grain, cells))
            n += len(cells)
            if n > HELD:
                new = [_summed(*map(np.concatenate, zip(*new)))]
                n = 0
        # A second of the state is read and written once a micro-batch, however many events it has.
        if new:
            of, cells = _summed(*map(np.concatenate, zip(*new)))
            begin = np.flatnonzero(np.diff(of, prepend=of[0] - 1))
            for second, part in zip(of[begin].tolist(), np.split(cells, begin[1:])):
                if self.seconds.containsKey((second,)):
                    part = _added(np.frombuffer(self.seconds.getValue((second,))[0], CELL), part)
                self.seconds.updateValue((second,), (part.tobytes(),))
        if first is not None and first != tick:
            if tick is not None:
                self.handle.deleteTimer(tick * 1000)
            self.clock.update((first, started))
            self.handle.registerTimer(first * 1000)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        tick, _ = self.clock.get()
        last = timerValues.getCurrentWatermarkInMs() // 1000 // self.step * self.step
        held = dict(sorted((k[0], np.frombuffer(v[0], CELL)) for k, v in self.seconds.iterator()))
        second = np.repeat(np.array(list(held), np.int64), [len(c) for c in held.values()])
        cells = np.concatenate([*held.values(), np.zeros(0, CELL)])
        out = [row for t in range(tick, last + 1, self.step) for row in self._at(t, second, cells)]
        next_tick = max(last + self.step, tick)
        for s in held:
            if s < next_tick - self.sla - self.window:
                self.seconds.removeKey((s,))
        self.clock.update((next_tick, True))
        self.handle.registerTimer(next_tick * 1000)
        frame = pd.DataFrame(out, columns=["alert", "tick", "window_start", "indicator", "numerator", "denominator", "valid"])
        frame.insert(0, "host", key[0])
        for c in ("tick", "window_start"):
            frame[c] = pd.to_datetime(frame[c], unit="s", utc=True)
        yield frame

    def _at(self, tick: int, second: np.ndarray, cells: np.ndarray) -> Iterator[tuple]:
        """The indicators at a tick; cells stand in the order of their seconds, and only those of a window are looked at."""

        def total(kind: str, value: str, begin: int) -> int:
            inside = cells[slice(*np.searchsorted(second, (begin, begin + self.window)))]
            return int(inside[value][(inside["done"] <= tick) & (inside["kind"] == KINDS.index(kind))].sum())

        def row(alert: str, begin: int, numerator: int, denominator: int, least: int) -> tuple:
            return alert, tick, begin, numerator * 100.0 / denominator if denominator else 0.0, numerator, denominator, denominator >= least

        begin = tick - self.window
        received, dropped = total("received", "packets", begin), total("dropped", "packets", begin)
        yield row("no_traffic", begin, int(received == 0), 1, 1)
        yield row("drop_rate", begin, dropped, received + dropped, self.min_packets)
        begin -= self.sla
        received, expected = total("received", "packets", begin), total("parsed", "rows", begin)
        yield row("parse_sla", begin, max(received - total("parsed", "packets", begin), 0), received, self.min_packets)
        yield row("insert_sla", begin, max(expected - total("inserted", "rows", begin), 0), expected, self.min_rows)

    def close(self) -> None:
        pass


def stream_indicators(
    events: DataFrame, window_s: int = WINDOW_S, step_s: int = STEP_S, sla_s: int = SLA_S, min_packets: int = 1000, min_rows: int = 1000, delay_s: int = RETENTION_S
) -> DataFrame:
    """Rows of the four indicators at every tick of each host, from its first event on, as the events done by the tick make
    them. Events may come in any order within ``delay_s`` seconds of the newest ``done_time``. Sets the session's state store to RocksDB, which timers need."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    timed = events.withWatermark("done_time", f"{delay_s} seconds")
    kept = timed.select("host", "kind", "done_time", F.unix_seconds("cohort_time").alias("second"), F.unix_seconds("done_time").alias("done"), F.col("packets").cast("long"), F.col("rows").cast("long"))
    made = kept.groupBy("host").transformWithStateInPandas(Indicators(window_s, step_s, sla_s, min_packets, min_rows), INDICATORS, "append", "EventTime")
    return made

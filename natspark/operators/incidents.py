"""Incidents with hysteresis, their versions, and the latest version of each."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natspark.operators.ordered import fold_in_order
from natspark.sources.shared import stored

KEYS = ["host", "alert"]
ACTIVE, CLEARED = "ACTIVE", "CLEARED"


def _run_length(hit: Column, rn: Column, w) -> Column:
    """Length of the run of ``hit`` that ends at this row."""
    return rn - F.coalesce(F.max(F.when(~hit, rn)).over(w), F.lit(0))


def _marked(ticks: DataFrame, breach: Column, clear: Column, trigger: int, clear_n: int) -> DataFrame:
    """Incidents from the marks "run of breaches long enough" and "run of clear ticks long enough": the state of a tick
    is the later of them. ``clear < threshold`` keeps a run from straddling a change of state."""
    order = Window.partitionBy(*KEYS).orderBy("tick")
    past = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = ticks.withColumns({"breach": breach, "clear": clear}).withColumn("rn", F.row_number().over(order))
    rn = F.col("rn")
    rows = rows.withColumns({"rb": _run_length(F.col("breach"), rn, past), "rc": _run_length(F.col("clear"), rn, past)})
    opened = F.max(F.when(F.col("rb") >= trigger, rn)).over(past)
    closed = F.max(F.when((F.col("rb") < trigger) & (F.col("rc") >= clear_n), rn)).over(past)
    rows = rows.withColumn("open", (F.coalesce(opened, F.lit(0)) > F.coalesce(closed, F.lit(0))).cast("int"))
    before = F.lag("open", 1, 0).over(order)
    rows = rows.withColumns({"starts": ((F.col("open") == 1) & (before == 0)).cast("int"), "ends": (F.col("open") == 0) & (before == 1)})
    rows = rows.withColumn("incident", F.sum("starts").over(past)).where((F.col("open") == 1) | F.col("ends"))
    return rows.groupBy(*KEYS, "incident").agg(
        F.min("tick").alias("start_tick"), F.max(F.when(F.col("ends"), F.col("tick"))).alias("end_tick"), F.max("indicator").alias("peak")
    )


def incidents(ticks: DataFrame, threshold: float, clear: float, trigger: int = 1, clear_n: int = 3) -> DataFrame:
    """``host, alert, incident, start_tick, end_tick, peak`` of the series ``host, alert, tick, indicator, valid``: an
    incident opens after ``trigger`` ticks in a row at the threshold or above, and ends after ``clear_n`` in a row below
    the clear level. Invalid ticks are as if they weren't there."""
    if clear >= threshold:
        raise ValueError("the clear level must lie below the threshold")
    kept = ticks.where("valid") if "valid" in ticks.columns else ticks
    return _marked(kept, F.col("indicator") >= threshold, F.col("indicator") < clear, trigger, clear_n)


def replay_incidents(ticks: DataFrame, threshold: float, clear: float, trigger: int = 1, clear_n: int = 3, min_batches: int = 1) -> DataFrame:
    """The same where a tick with a ``denominator`` below ``min_batches`` counts only while an incident is open, so
    that it can end; there are no other invalid ticks. With one trigger tick this is a matter of marks; with more, whether a tick counts depends on the
    state, and each series is scanned in stretches (:func:`scanned`)."""
    if clear >= threshold:
        raise ValueError("the clear level must lie below the threshold")
    if trigger == 1:
        breach = (F.col("indicator") >= threshold) & (F.col("denominator") >= min_batches)
        return _marked(ticks, breach, F.col("indicator") < clear, 1, clear_n)
    return scanned(ticks.drop("valid"), Rule(threshold, clear, trigger, clear_n, min_batches))


@dataclass(frozen=True)
class Rule:
    threshold: float
    clear: float
    trigger: int = 1
    clear_n: int = 3
    min_batches: int = 0


@dataclass
class State:
    """The state of one series between ticks; small, and all that a stream has to keep."""

    active: bool = False
    breaches: int = 0
    clears: int = 0
    incident: int = 0
    start: int = 0
    peak: float = 0.0
    emitted: int = 0
    dirty: bool = False
    version: int = 0


#: incident, version, emitted at, start, end, peak, state
Version = tuple[int, int, int, int, int | None, float, str]


def fold(state: State, ticks: Iterable[tuple[int, float, bool, int]], rule: Rule, update_s: int | None = 60) -> Iterator[Version]:
    """Versions emitted over ticks (second, indicator, valid, denominator): one when an incident opens and when it
    ends, and one at most every ``update_s`` seconds (none if that is None) after its peak rose."""

    def emit(tick: int, end: int | None) -> Version:
        state.emitted, state.dirty, state.version = tick, False, state.version + 1
        return state.incident, state.version, tick, state.start, end, state.peak, CLEARED if end is not None else ACTIVE

    for tick, indicator, valid, denominator in ticks:
        if not valid or (denominator < rule.min_batches and not state.active):
            continue
        if not state.active:
            state.breaches = state.breaches + 1 if indicator >= rule.threshold else 0
            if state.breaches >= rule.trigger:
                state.active, state.breaches, state.clears = True, 0, 0
                state.incident, state.start, state.peak = state.incident + 1, tick, indicator
                yield emit(tick, None)
            continue
        if indicator > state.peak:
            state.peak, state.dirty = indicator, True
        state.clears = state.clears + 1 if indicator < rule.clear else 0
        if state.clears >= rule.clear_n:
            state.active = False
            yield emit(tick, tick)
        elif state.dirty and update_s is not None and tick - state.emitted >= update_s:
            yield emit(tick, None)


VERSIONS = "host string, alert string, incident bigint, version bigint, emitted_tick bigint, start_tick bigint, end_tick bigint, peak double, state string"
_NAMES = [c.split()[0] for c in VERSIONS.split(", ")]


def version_rows(key: tuple, versions: Iterable[Version]) -> pd.DataFrame:
    out = pd.DataFrame([(*key, *v) for v in versions], columns=_NAMES)
    return out.astype({"incident": "int64", "version": "int64", "emitted_tick": "int64", "start_tick": "int64", "end_tick": "Int64", "peak": "float64"})


def tick_columns(ticks: DataFrame) -> DataFrame:
    """``host, alert, tick, indicator, valid, denominator`` with defaults for the last two."""
    valid = F.col("valid") if "valid" in ticks.columns else F.lit(True)
    enough = F.col("denominator").cast("bigint") if "denominator" in ticks.columns else F.lit(1).cast("bigint")
    return ticks.select(*KEYS, F.col("tick").cast("bigint").alias("tick"), F.col("indicator").cast("double").alias("indicator"), valid.alias("valid"), enough.alias("denominator"))


def tick_tuples(frame: pd.DataFrame) -> list[tuple[int, float, bool, int]]:
    ordered = frame.sort_values("tick", kind="stable")
    return list(zip(ordered["tick"].tolist(), ordered["indicator"].tolist(), ordered["valid"].tolist(), ordered["denominator"].tolist()))


def _folded(ticks: DataFrame, rule: Rule, update_s: int | None) -> DataFrame:
    def run(key: tuple, state: State, frame: pd.DataFrame) -> pd.DataFrame:
        return version_rows(key, fold(state, tick_tuples(frame), rule, update_s))

    return fold_in_order(tick_columns(ticks), KEYS, ["tick"], State, run, VERSIONS)


#: Seconds of a stretch of a series: a day has 8,640 ticks.
STRETCH_S = 86_400


def _transitions(rule: Rule) -> np.ndarray:
    """The state after a tick, by kind of tick and state before. States: so many breaches in a row without an incident, then
    so many clear ticks in a row within one. A kind has bits for a tick with enough counted, a breach and a clear tick."""
    out = np.empty((8, rule.trigger + rule.clear_n), np.int64)
    for kind in range(8):
        enough, breach, clear = kind & 1, kind & 2, kind & 4
        for s in range(rule.trigger):
            after = s + 1 if breach else 0  # the state of ``trigger`` breaches is the first within an incident
            out[kind, s] = after if enough else s
        for c in range(rule.clear_n):
            after = c + 1 if clear else 0
            out[kind, rule.trigger + c] = 0 if after == rule.clear_n else rule.trigger + after
    return out


def _kinds(frame: pd.DataFrame, rule: Rule) -> np.ndarray:
    indicator = frame["indicator"].to_numpy()
    return (frame["denominator"].to_numpy() >= rule.min_batches) + 2 * (indicator >= rule.threshold) + 4 * (indicator < rule.clear)


def scanned(ticks: DataFrame, rule: Rule, stretch_s: int = STRETCH_S) -> DataFrame:
    """Incidents of series of any length by a scan of stretches, so that one series is the work of many tasks.

    The states between ticks are few, so that a stretch is a map from the state before it to the state after it and the
    number of incidents that begin in it. The maps of a series, a row for each stretch, are composed in order, which gives each stretch its first state
    and incident; then stretches are gone through once more, each for itself. An incident that spans stretches is put
    together from what each knows of it."""
    after, inside = _transitions(rule), rule.trigger
    n_states = inside + rule.clear_n
    keys = [*KEYS, "stretch"]
    kept = tick_columns(ticks).where("tick is not null").withColumn("stretch", F.floor(F.col("tick") / stretch_s).cast("bigint"))

    def mapped(key: tuple, state: dict, frame: pd.DataFrame) -> pd.DataFrame:
        """The stretch's map up to here; the one with most ticks is that of the whole."""
        now, begun = state.setdefault("now", np.arange(n_states)), state.setdefault("begun", np.zeros(n_states, np.int64))
        for step in after[_kinds(frame, rule)]:
            then = step[now]
            begun += (now < inside) & (then >= inside)
            now[:] = then
        state["n"] = state.get("n", 0) + len(frame)
        return pd.DataFrame([(*key, state["n"], now.tolist(), begun.tolist())], columns=[*keys, "n", "then", "begun"])

    parts = fold_in_order(kept, keys, ["tick"], dict, mapped, "host string, alert string, stretch bigint, n bigint, then array<bigint>, begun array<bigint>")
    maps = parts.groupBy(*keys).agg(F.max_by(F.struct("then", "begun"), "n").alias("map")).select(*keys, "map.*")

    def composed(key: tuple, state: dict, frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for stretch, then, begun in zip(frame["stretch"].tolist(), frame["then"], frame["begun"]):
            first, incident = state.get("first", 0), state.get("incident", 0)
            rows.append((*key, stretch, first, incident))
            state["first"], state["incident"] = int(then[first]), incident + int(begun[first])
        return pd.DataFrame(rows, columns=[*keys, "first", "before"])

    starts = stored(fold_in_order(maps, KEYS, ["stretch"], dict, composed, "host string, alert string, stretch bigint, first bigint, before bigint"), "starts")

    def gone_through(key: tuple, state: dict, frame: pd.DataFrame) -> pd.DataFrame:
        now, incident = state.get("now", int(frame["first"].iloc[0])), state.get("incident", int(frame["before"].iloc[0]))
        known: dict[int, list] = {}
        for kind, tick, indicator in zip(_kinds(frame, rule).tolist(), frame["tick"].tolist(), frame["indicator"].tolist()):
            then = int(after[kind, now])
            opens, ends = now < inside <= then, then < inside <= now
            incident += opens
            if now >= inside or opens:
                one = known.setdefault(incident, [None, None, indicator])
                one[0], one[1], one[2] = tick if opens else one[0], tick if ends else one[1], max(one[2], indicator)
            now = then
        state["now"], state["incident"] = now, incident
        out = pd.DataFrame([(*key[:2], i, *of) for i, of in known.items()], columns=[*KEYS, "incident", "start_tick", "end_tick", "peak"])
        return out.astype({"incident": "int64", "start_tick": "Int64", "end_tick": "Int64", "peak": "float64"})

    again = kept.join(starts.hint("shuffle_hash"), keys)
    found = fold_in_order(again, keys, ["tick"], dict, gone_through, "host string, alert string, incident bigint, start_tick bigint, end_tick bigint, peak double")
    return found.groupBy(*KEYS, "incident").agg(F.max("start_tick").alias("start_tick"), F.max("end_tick").alias("end_tick"), F.max("peak").alias("peak"))


def incident_versions(ticks: DataFrame, threshold: float, clear: float, trigger: int = 1, clear_n: int = 3, update_s: int = 60, min_batches: int = 0) -> DataFrame:
    """The versions that a collector would emit; when one is due depends on the one before, so each series is folded in
    order, with its state carried along."""
    return _folded(ticks, Rule(threshold, clear, trigger, clear_n, min_batches), update_s)


def latest_incident(versions: DataFrame, limit: int = 100, key: str = "id", newest: str = "start_time") -> DataFrame:
    """The newest version of each incident, the newest incidents first."""
    w = Window.partitionBy(key).orderBy(F.desc("version"))
    return versions.withColumn("place", F.row_number().over(w)).where("place = 1").drop("place").orderBy(F.desc(newest), key).limit(limit)

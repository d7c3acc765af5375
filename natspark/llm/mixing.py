"""Mixing of sources to target weights by entropy balancing. Built-in functions only.

Each source has a target of words. Of all document rates between 0 and ``cap``, those that keep the relative entropy to
one copy each least while they meet the source's target are ``min(cap, exp(tilt * size / mean size))``; the source's
``tilt`` is the minimum of the convex dual and is found by Newton steps, kept between bounds that close in. The sums
over documents that a step needs are sums over the source's size bins (exact below 4096 words, 1/256 of an octave
above), which are aggregated map-side first; all sources take their steps in parallel. Sources that hold a large share
of the documents are thus no larger than others.

Rates become whole copies from the largest bin down: each takes as many copies as bring the words so far closest to
their expected sum, so that the error left at the end is about the smallest document. Inside a bin, documents are
ranked by a hash of their id; ranks run over hash buckets, so that a bin with very many documents is spread.

Defined cases: null text has size 0 and takes nothing; null source is a source, last in order; rows with equal ids are
interchangeable; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natspark.llm.common import stored, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
STEPS = 40
BUCKETS = 256
_EXACT = 4096
_KEY = ["named", "source"]


def _sized(docs: DataFrame, size: Column) -> DataFrame:
    """Each row as the struct ``doc``, with the keys that the plan needs beside it."""
    wide = F.floor(F.log2(size / _EXACT) * 256)
    return docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col("source").isNotNull().alias("named"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        size.alias("size"),
        F.when(size < _EXACT, size).otherwise(_EXACT + wide).cast("int").alias("bin"),
        F.xxhash64(F.col("doc_id")).alias("order"),
        F.pmod(F.xxhash64(F.col("doc_id")), F.lit(BUCKETS)).cast("int").alias("bucket"),
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources`` (``named, source, words``) with ``target``: the words of all sources, shared by weight. Sources
    that would pass ``cap`` times their words stop there; those with the least words for their weight do so first, and
    the rest share what remains. One row per source."""
    order = Window.orderBy(F.desc("named"), "source")
    cycle = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sources.withColumn("weight", cycle.cast("long"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("words") / F.col("weight"), F.desc("named"), "source").rowsBetween(Window.unboundedPreceding, -1)
    taken = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    rest = (F.sum("words").over(everything) - cap * taken("words")) / (F.sum("weight").over(everything) - taken("weight"))
    ranked = weighed.withColumn("rest", rest).withColumn("full", cap * F.col("words") < F.col("rest") * F.col("weight"))
    level = F.max(F.when(~F.col("full"), F.col("rest"))).over(everything)
    target = F.when(F.col("full"), (cap * F.col("words")).cast("double")).otherwise(F.coalesce(level * F.col("weight"), F.lit(0.0)))
    return ranked.withColumn("target", target).select(*_KEY, "words", "target")


def _tilt(bins: Column, mean: Column, target: Column, cap: int) -> Column:
    """The root of (words taken at a tilt) - target, after :data:`STEPS` safeguarded Newton steps."""

    def sums(tilt: Column) -> Column:
        def add(s: Column, b: Column) -> Column:
            x = b["mean"] / mean
            rate = F.least(F.exp(F.least(tilt * x, F.lit(700.0))), F.lit(float(cap)))
            slope = F.when(rate < cap, b["words"] * rate * x).otherwise(0.0)
            return F.struct((s["f"] + b["words"] * rate).alias("f"), (s["h"] + slope).alias("h"))

        return F.aggregate(bins, F.struct(F.lit(0.0).alias("f"), F.lit(0.0).alias("h")), add)

    def step(s: Column, _: Column) -> Column:
        def moved(at: Column) -> Column:
            low = F.when(at["f"] < target, s["tilt"]).otherwise(s["low"])
            high = F.when(at["f"] < target, s["high"]).otherwise(s["tilt"])
            newton = s["tilt"] - F.try_divide(at["f"] - target, at["h"])
            inside = F.coalesce((newton >= low) & (newton <= high), F.lit(False))
            return F.struct(F.when(inside, newton).otherwise((low + high) / 2).alias("tilt"), low.alias("low"), high.alias("high"))

        return F.element_at(F.transform(F.array(sums(s["tilt"])), moved), 1)

    start = F.struct(F.lit(0.0).alias("tilt"), (-40 * mean - 1).alias("low"), (40 * mean + 1).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda s: s["tilt"])


def _copies(bins: Column, tilt: Column, mean: Column, cap: int) -> Column:
    """Whole copies of each bin, in the order of ``bins``, which runs from the largest size down."""
    start = F.struct(F.lit(0.0).alias("want"), F.lit(0.0).alias("got"), F.array().cast("array<bigint>").alias("copies"))

    def add(s: Column, b: Column) -> Column:
        rate = F.least(F.exp(F.least(tilt * b["mean"] / mean, F.lit(700.0))), F.lit(float(cap)))
        want = s["want"] + b["words"] * rate
        n = F.greatest(F.least(F.round((want - s["got"]) / b["mean"]), cap * b["n"]), F.lit(0)).cast("long")
        return F.struct(want.alias("want"), (s["got"] + n * b["mean"]).alias("got"), F.concat(s["copies"], F.array(n)).alias("copies"))

    return F.aggregate(bins, start, add, lambda s: s["copies"])


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source, bin and hash bucket: the source's words and target, the bin's documents and copies, and the
    number of its documents in earlier buckets."""
    counted = stored(sized.groupBy(*_KEY, "bin", "bucket").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("words")), "counted")
    sources = targets(counted.groupBy(*_KEY).agg(F.sum("words").alias("words")), weights, cap)
    by_bin = counted.where("words > 0").groupBy(*_KEY, "bin").agg(F.sum("docs").alias("n"), F.sum("words").alias("words"))
    one = F.struct("bin", "n", F.col("words").cast("double").alias("words"), (F.col("words") / F.col("n")).alias("mean"))
    bins = by_bin.groupBy(*_KEY).agg(F.sort_array(F.collect_list(one), asc=False).alias("bins"), (F.sum("words") / F.sum("n")).alias("mean"))
    solved = stored(bins.join(sources.select(*_KEY, "target"), _KEY), "sources").withColumn("tilt", _tilt(F.col("bins"), F.col("mean"), F.col("target"), cap))
    solved = stored(solved, "tilts").withColumn("copies", _copies(F.col("bins"), F.col("tilt"), F.col("mean"), cap))
    rounded = solved.select(*_KEY, F.explode(F.arrays_zip(F.col("bins.bin").alias("bin"), F.col("bins.n").alias("n"), "copies")).alias("b")).select(*_KEY, "b.*")
    earlier = Window.partitionBy(*_KEY, "bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("earlier", F.coalesce(F.sum("docs").over(earlier), F.lit(0))).select(*_KEY, "bin", "bucket", "earlier")
    full = placed.join(rounded, [*_KEY, "bin"], "left").join(sources.withColumnRenamed("words", "source_size"), _KEY)
    return stored(full, "mix")


def mix(docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``doc`` (the row), ``size``, ``source_size``, ``target`` and ``copies`` of every row."""
    sized = _sized(docs, word_count(F.col("text").cast("string")) if size is None else size)
    keys = [*_KEY, "bin", "bucket"]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("order"))
    ranked = sized.withColumn("rank", rank).join(plan(sized, weights, cap), keys)
    more = (F.col("rank") + F.col("earlier") <= F.pmod("copies", "n")).cast("long")
    copies = F.coalesce(F.floor(F.col("copies") / F.col("n")) + more, F.lit(0)).cast("long")
    return ranked.select("doc", "size", "source_size", "target", copies.alias("copies"))


def resample(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    return mix(docs, None, weights, cap).where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")

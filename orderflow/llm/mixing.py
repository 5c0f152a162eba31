"""Mixing sources to target weights by entropy balancing.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share ``SHARE`` times all words; a
target stops at ``LIMIT`` times its source's words and the excess is shared again by weight until none is above.
That fixed point is ``min(LIMIT * size, weight * level)`` for one level, found by rounds of sums over the sources.

Rates: among all document rates between 0 and ``LIMIT`` that meet the token constraints, entropy balancing takes
the ones closest to one copy each.  They are exponentially tilted, ``LIMIT * sigmoid(l * z / mean)`` for a document of
z words, with one multiplier l per source.  The dual is convex and separate by source; its Newton iterations (kept
between brackets) run as grouped sums over the histogram of sizes, for all sources at once.

Copies: the histogram's buckets of a source are visited from the largest size down; each takes the whole number of
copies that brings the words taken closest to the words expected so far, so the last error is below the smallest
sizes.  A source of W words has at most sqrt(2 W) distinct sizes, which bounds that step.  Copies of a bucket go to
its documents in the order of an md5 of the id and the text's checksum, as equally as possible.  Newton rounds that
do not meet every constraint raise an error.

Defined cases: a null or blank text has size 0 and takes no words (it stays once in ``mixed``); a null source is a
source of its own; rows with a null or repeated id are mixed like any others; a source without words has target 0;
an empty table gives an empty result.  Only doc_id, text and source are read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import id_text_hash, spread_rank, stored, text_bytes

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
LIMIT = 2
TOLERANCE = 1e-9
MAX_ROUNDS = 200


def word_count(text: str = "text") -> Column:
    """Number of runs of characters other than ASCII white space."""
    plain = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+", " "))
    # Inside a lambda the replaced text is computed once, not at each of its uses.
    return F.transform(F.array(plain), lambda p: F.when(p == "", F.lit(0)).otherwise(
        F.octet_length(p) - F.octet_length(F.replace(p, F.lit(" "))) + 1).cast("long"))[0]


def _weighted(sources: DataFrame) -> DataFrame:
    """Add ``weight`` by the source's place in code point order, null last.

    Sources are sorted into ranges; a place is the rank inside the range plus the sources of the ranges before, so
    neither a task nor the driver sees them all.
    """
    last = F.col("source").isNull()
    ranged = stored(sources.repartitionByRange(last, F.col("source")).withColumn("__part", F.spark_partition_id()))
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__here"))
    # One row per range.
    before = F.coalesce(F.sum("__here").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranged = ranged.join(counts.select("__part", before.alias("__before")), "__part")
    place = F.col("__before") + F.row_number().over(Window.partitionBy("__part").orderBy(last, "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(place, F.lit(len(WEIGHTS))) + 1).cast("int"))
    return ranged.select("source", "source_size", weight.alias("weight"))


def source_targets(sizes: DataFrame, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) from (source, size) rows; one row per source.

    The level rises round by round: what the sources that are full at a level leave over is shared again by weight.
    A round is one sum over the sources; it ends when no further source is full.
    """
    sources = stored(_weighted(sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))))
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, full_before = 0.0, -1
    while True:
        full = F.lit(float(limit)) * F.col("source_size") <= F.lit(level) * F.col("weight")
        found = sources.agg(F.count(F.when(full, 1)).alias("full"), F.sum(F.when(full, F.col("source_size"))).alias("filled"),
                            F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if found.open is None or found.full == full_before:
            break
        level, full_before = (budget - limit * (found.filled or 0)) / found.open, found.full
    most = F.lit(float(limit)) * F.col("source_size")
    return sources.select("source", "source_size", F.least(most, F.lit(level) * F.col("weight")).alias("target"))


def _rate(multiplier: Column, size: Column, limit: int) -> Column:
    tilt = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), multiplier * size / F.col("mean")))
    return F.lit(float(limit)) / (F.lit(1.0) + F.exp(-tilt))


def tilted(histogram: DataFrame, targets: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(source, multiplier): the dual solution, by bracketed Newton rounds over (source, size, docs) rows."""
    mean = F.greatest(F.lit(1.0), F.col("source_size") / F.col("docs_with_words"))
    state = (targets.join(histogram.where("size > 0").groupBy(F.col("source").alias("s"))
                          .agg(F.sum("docs").alias("docs_with_words")), F.col("source").eqNullSafe(F.col("s")))
             .where("source_size > 0")
             .select("source", "source_size", "target", mean.alias("mean"), F.lit(0.0).alias("multiplier"),
                     F.lit(-1e4).alias("low"), F.lit(1e4).alias("high"), F.lit(1.0).alias("miss")))
    open_ = F.col("target") < F.lit(limit) * F.col("source_size")
    # A bracket as narrow as doubles allow meets a constraint as nearly as they can.
    missed = open_ & (F.col("miss") >= TOLERANCE) & (F.col("high") - F.col("low") > 1e-12 * F.greatest(F.lit(1.0), F.abs("multiplier")))
    for _ in range(MAX_ROUNDS):
        rate = _rate(F.col("multiplier"), F.col("size"), limit)
        words = F.col("size") * F.col("docs")
        now = (state.join(histogram.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
               .groupBy("source", "source_size", "target", "mean", "multiplier", "low", "high")
               .agg(F.sum(words * rate).alias("taken"),
                    F.sum(words * rate * (F.lit(1.0) - rate / limit) * F.col("size") / F.col("mean")).alias("slope")))
        over = F.col("taken") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.col("multiplier"))
        high = F.when(over, F.col("multiplier")).otherwise(F.col("high"))
        step = F.col("multiplier") + F.when(F.col("slope") > 1e-12, (F.col("target") - F.col("taken")) / F.col("slope"))
        inside = (step > F.col("new_low")) & (step < F.col("new_high"))
        miss = F.abs(F.col("taken") - F.col("target")) / F.col("source_size")
        state = stored(
            now.withColumn("new_low", low).withColumn("new_high", high).withColumn("miss", miss)
            .select("source", "source_size", "target", "mean",
                    F.when(F.col("miss") < TOLERANCE, F.col("multiplier")).when(inside, step)
                    .otherwise((F.col("new_low") + F.col("new_high")) / 2).alias("multiplier"),
                    F.col("new_low").alias("low"), F.col("new_high").alias("high"), "miss"))
        if state.where(missed).isEmpty():
            return state
    worst = state.where(missed).orderBy(F.desc("miss")).first()
    raise RuntimeError(f"source {worst.source!r} misses its target by {worst.miss:.1e} of its words after {MAX_ROUNDS} rounds")


def _carry(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of each bucket of one source, largest sizes first, carrying the words still owed."""
    rows = rows.sort_values("size", ascending=False)
    owed, copies = 0.0, []
    for size, most, expected in zip(rows["size"], rows["most"], rows["expected"]):
        owed += expected
        take = min(int(most), max(0, int(owed / size + 0.5)))
        owed -= take * size
        copies.append(take)
    return rows.assign(copies=copies)[["source", "size", "docs", "copies"]]


def copies_by_size(histogram: DataFrame, state: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(source, size, docs, copies): the copies that each bucket of equal size and source gets in all."""
    full = F.col("target") >= F.lit(limit) * F.col("source_size")
    rate = F.when(full, F.lit(float(limit))).otherwise(_rate(F.col("multiplier"), F.col("size"), limit))
    rows = (histogram.where("size > 0").withColumnRenamed("source", "s")
            .join(state, F.col("source").eqNullSafe(F.col("s")))
            .select("source", "size", "docs", (F.col("docs") * limit).alias("most"),
                    (rate * F.col("docs") * F.col("size")).alias("expected")))
    return rows.groupBy("source").applyInPandas(_carry, "source string, size long, docs long, copies long")


def _plan(sizes: DataFrame, share: float, limit: int) -> DataFrame:
    """One row per (source, size): source_size, target, docs and the copies for the bucket's documents in all."""
    histogram = stored(sizes.groupBy("source", "size").agg(F.count("*").alias("docs")))
    targets = stored(source_targets(histogram.select("source", (F.col("size") * F.col("docs")).alias("size")), share, limit))
    copies = copies_by_size(histogram, tilted(histogram, targets, limit), limit)
    return (histogram.join(targets.withColumnRenamed("source", "t"), F.col("source").eqNullSafe(F.col("t")))
            .join(copies.select(F.col("source").alias("s"), F.col("size").alias("z"), "copies"),
                  F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left")
            .select("source", "size", "source_size", "target", F.col("docs").alias("__docs"),
                    F.when(F.col("size") == 0, F.col("docs")).otherwise(F.coalesce("copies", F.lit(0))).alias("__copies")))


def _share_out(rows: DataFrame, keys: list[str], plan: DataFrame, out: str) -> DataFrame:
    """Add ``out``, the copies of each row, and the plan's columns; ``keys`` name the rows' source and size."""
    plan = plan.withColumnsRenamed(dict(zip(("source", "size"), keys)))
    ranked = spread_rank(rows.withColumn("__hash", id_text_hash(F.col("doc_id"), F.col("__crc"))), keys, "__hash", ["doc_id"], "__rank", plan)
    base = F.floor(F.col("__copies") / F.col("__docs"))
    extra = (F.col("__rank") < F.col("__copies") - base * F.col("__docs")).cast("long")
    return ranked.withColumn(out, (base + extra).cast("long")).drop("__hash", "__crc", "__rank", "__docs", "__copies")


def _sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count().alias("size"),
                       F.crc32(text_bytes()).alias("__crc"))


def mix(docs: DataFrame, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """One narrow row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = stored(_sizes(docs))
    return (_share_out(sizes, ["source", "size"], _plan(sizes, share, limit), "copies")
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed(docs: DataFrame, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """The documents, all columns unchanged, each row repeated as often as the mix takes it; others go."""
    plan = _plan(stored(_sizes(docs).select("source", "size")), share, limit)
    rows = docs.withColumn("__source", F.col("source").cast("string")).withColumn("__size", word_count())
    rows = rows.withColumn("__crc", F.crc32(text_bytes()))
    plan = plan.select("source", "size", "__docs", "__copies")
    return (_share_out(rows, ["__source", "__size"], plan, "__taken")
            .where("__taken > 0")
            .withColumn("__copy", F.explode(F.array_repeat(F.lit(True), F.col("__taken").cast("int"))))
            .select(*docs.columns))

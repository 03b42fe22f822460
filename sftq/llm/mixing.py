"""Mixing sources to target token counts by entropy balancing.

The rate of a document of ``size`` words is ``2 / (1 + exp(-tilt * size / mean))``: among
all rates from 0 to 2 that meet a source's token constraint it is the one of greatest
entropy, and ``tilt``, one number a source, solves its convex dual. Newton steps find it,
each an aggregation of a histogram of sizes. Rates then become whole copies.

* A null or empty text has size 0 and is taken 0 times; a null ``source`` is the last source. Texts are
  counted whole.
* Equal rows are told apart by a number among their equals; ties of rounding go by hash. Reruns agree.
* An empty table gives an empty result; a source without words has target 0.
* ``mix`` returns all columns as they are, whatever their names; ``mixed`` reads three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftq.llm.common import stored, whole_rows, word_count

#: Weights of the sources in order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Share of all words that the mix takes, and the most that it takes of one source or document.
SHARE, MOST = 1.5, 2
#: Sizes picked one by one to fill what rounding leaves.
PICKS = 2
#: Groups that documents of one source and size are dealt to.
SALTS = 64
STEPS, TILT_LIMIT, NEAR = 40, 1e6, 1e-5


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row a source.

    Sources by code point, null last, take the weights in turn. What exceeds ``MOST`` times
    a source's size goes to the others by weight until none is above: sorted by room for
    each unit of weight, the sources before a point are full and the rest share evenly.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    room = MOST * F.col("source_size")
    rows = sources.withColumn("weight", weight).withColumn("room", room.cast("double"))
    by = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = rows.withColumns(
        {
            "used": F.coalesce(F.sum("room").over(before), F.lit(0.0)),
            "spent": F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            "all": F.sum("source_size").over(every) * share,
            "total": F.sum("weight").over(every),
        }
    )
    level = (F.col("all") - F.col("used")) / (F.col("total") - F.col("spent"))
    rows = rows.withColumn("level", F.when(level * F.col("weight") <= F.col("room"), level))
    rows = rows.withColumn("level", F.coalesce(F.max("level").over(every), F.lit(float("inf"))))
    target = F.least(F.col("room"), F.col("level") * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def rate(size: Column, tilt: Column) -> Column:
    return MOST / (1 + F.exp(-tilt * size))


def tilts(histogram: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` with ``tilt`` added, for the sizes ``sid, x, size, n`` of its sources ``sid``.

    Newton's step on the dual of each source; a step that leaves the bracket of the root
    becomes its middle. A source wanted at ``MOST`` times its size has an infinite tilt.
    Stops when every other is within ``NEAR`` of its size; rounding mends the rest.
    """
    full = F.col("target") >= MOST * F.col("source_size") - 0.5
    state = goals.withColumns({"tilt": F.when(full, F.lit(float("inf"))).otherwise(0.0), "lo": F.lit(-TILT_LIMIT), "hi": F.lit(TILT_LIMIT), "off": F.lit(float("inf"))})
    for _ in range(STEPS):
        r = rate(F.col("x"), F.col("tilt"))
        slope = r * (1 - r / MOST) * F.col("x")
        sums = (
            histogram.join(state.select("sid", "tilt"), "sid")
            .groupBy("sid")
            .agg(F.sum(r * F.col("size") * F.col("n")).alias("words"), F.sum(slope * F.col("size") * F.col("n")).alias("slope"))
        )
        gap = F.coalesce("words", F.lit(0.0)) - F.col("target")
        state = state.join(sums, "sid", "left").withColumn("gap", gap)
        state = state.withColumns({"hi": F.when(F.col("gap") > 0, F.col("tilt")).otherwise(F.col("hi")), "lo": F.when(F.col("gap") > 0, F.col("lo")).otherwise(F.col("tilt"))})
        step = F.col("tilt") - F.col("gap") / F.when(F.col("slope") > 0, F.col("slope"))
        middle = (F.col("lo") + F.col("hi")) / 2
        near = full | (F.abs("gap") <= F.greatest(F.lit(1.0), NEAR * F.col("source_size")))
        inside = (step > F.col("lo")) & (step < F.col("hi"))
        moved = F.when(near, F.col("tilt")).when(inside, step).otherwise(middle)
        state = stored(state.select("sid", "source_size", "target", moved.alias("tilt"), "lo", "hi", F.when(near, 0.0).otherwise(F.abs("gap")).alias("off")))
        if not (state.agg(F.max("off")).first()[0] or 0.0):
            break
    return state.select("sid", "source_size", "target", "tilt")


def _rounded(histogram: DataFrame, tilt: DataFrame) -> DataFrame:
    """``sid, size, docs, taken``: whole copies of each size, near its rate and the target.

    Rates are rounded size by size. What this leaves over or short is given to, or taken from, the sizes
    in ascending order as far as it reaches, then ``PICKS`` times to the largest size that fits.
    """
    r = histogram.join(tilt, "sid").withColumn("want", rate(F.col("x"), F.col("tilt")) * F.col("n"))
    r = r.withColumn("taken", F.least(F.round("want"), MOST * F.col("n")).cast("long"))
    every = Window.partitionBy("sid")
    ascending = every.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("off", F.round(F.col("target") - F.sum(F.col("taken") * F.col("size")).over(every)).cast("long"))
    more = F.col("off") > 0
    r = r.withColumn("room", F.when(more, MOST * F.col("n") - F.col("taken")).otherwise(F.col("taken")))
    left = F.abs("off") - F.coalesce(F.sum(F.col("room") * F.col("size")).over(ascending), F.lit(0))
    r = r.withColumn("moved", F.least(F.col("room"), F.floor(F.greatest(left, F.lit(0)) / F.col("size"))))
    for _ in range(PICKS):
        r = r.withColumn("rest", F.abs("off") - F.sum(F.col("moved") * F.col("size")).over(every))
        fits = (F.col("size") <= F.col("rest")) & (F.col("room") > F.col("moved"))
        r = r.withColumn("pick", F.max(F.when(fits, F.col("size"))).over(every))
        extra = F.least(F.col("room") - F.col("moved"), F.floor(F.col("rest") / F.col("size")))
        r = r.withColumn("moved", F.col("moved") + F.when(F.col("size") == F.col("pick"), extra).otherwise(0))
    taken = F.col("taken") + F.when(more, F.col("moved")).otherwise(-F.col("moved"))
    return r.select("sid", "size", F.col("n").alias("docs"), taken.cast("long").alias("taken"))


def copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """``row`` (all of ``docs``), ``size, source_size, target, copies``.

    A null text has size 0 and is taken 0 times. Every document of one source and size has
    the same rate; the histogram of sizes is rounded first, from large sizes to small, so that each
    source's words come within about one small document of its target. Copies are then
    spread evenly over the documents of a size, in an order fixed by a hash of identifier
    and text: reruns agree, and repeated rows share what they get.
    """
    rows = whole_rows(docs).select("row", F.col("row.source").alias("source"), word_count(F.col("row.text")).alias("size"))
    salt = F.pmod(F.xxhash64(F.col("row.doc_id"), F.col("row.text")), F.lit(SALTS)).cast("int")
    rows = rows.withColumn("salt", salt)
    # Rows of sizes, sources and salts: no longer than the table, far shorter where sizes repeat.
    cells = stored(rows.groupBy("source", "size", "salt").agg(F.count("*").alias("n")))
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    sources = stored(sources)
    goals = targets(sources.select("source", "source_size"), weights, share)
    named = stored(
        goals.join(sources.select(F.col("source").alias("s"), "docs"), F.expr("source <=> s"))
        .select("source", "source_size", "target", "docs", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("sid"))
    )
    mean = F.greatest(F.col("source_size") / F.col("docs"), F.lit(1.0))
    means = named.select(F.col("source").alias("s"), "sid", mean.alias("mean"))
    counted = cells.where("size > 0").groupBy("source", "size").agg(F.sum("n").alias("n"))
    histogram = stored(
        counted.join(means, F.expr("source <=> s")).select("sid", "size", "n", (F.col("size") / F.col("mean")).alias("x"))
    )
    tilt = tilts(histogram, named.select("sid", "source_size", "target"))
    rounded = _rounded(histogram, tilt)
    cells = cells.join(means.select(F.col("s"), "sid"), F.expr("source <=> s")).drop("s")
    within = Window.partitionBy("sid", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cells.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(rounded, ["sid", "size"], "left")
        .join(named.select("sid", "source_size", "target"), "sid")
        .select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("salt").alias("t"), "first", "docs", "taken", "source_size", "target")
    )
    order = Window.partitionBy("source", "size", "salt").orderBy("row.doc_id", F.xxhash64(F.col("row.text")))
    ranked = rows.withColumn("place", F.row_number().over(order) - 1)
    met = ranked.join(offsets, F.expr("source <=> s and size = z and salt = t"))
    place = F.col("first") + F.col("place")
    # Of every run of documents as many are taken as its share asks for.
    upto = lambda k: F.floor(k * F.col("taken") / F.col("docs"))
    own = F.coalesce((upto(place + 1) - upto(place)).cast("int"), F.lit(0))
    return met.select("row", "size", "source_size", "target", own.alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    out = copies(docs.select("doc_id", "source", "text"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return out.select("row.doc_id", "size", "source_size", "target", taken)


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, columns unchanged."""
    out = copies(docs).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("row.*")

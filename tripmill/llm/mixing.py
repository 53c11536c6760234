"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import require, word_count

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Order scores are cut twice by so many bits to find where a source's sample ends.
CELL_BITS = 12
#: Plans of up to so many sources go to every task; larger ones are joined by a shuffle, whose hot sources are split.
FEW_SOURCES = 10_000


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources by code point, null last, take ``weights`` in turn. Targets share the sum of all sizes
    by weight; none is above ``most`` times its source's size. With sources sorted by size over
    weight, those that stop at their limit are a prefix: the level of the rest is the first one
    which its own next source does not undercut. Rows here are sources, not documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    )
    limit = F.lit(most) * F.col("source_size")
    ratio = limit / F.col("weight")
    upward = Window.orderBy(ratio.asc(), F.col("source").asc_nulls_last())
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total, all_weight = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    level = (total - F.coalesce(F.sum(limit).over(before), F.lit(0))) / (
        all_weight - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    place = F.row_number().over(upward)
    leveled = weighed.withColumn("_level", F.when(level <= ratio, F.struct(place.alias("n"), level.alias("level"))))
    chosen = F.min("_level").over(everything)["level"]
    return leveled.select(
        "source", "source_size",
        F.least(limit.cast("double"), F.col("weight") * F.coalesce(chosen, F.lit(0.0))).alias("target"),
    )


def pareto_mix(
    docs: DataFrame,
    size: Column | None = None,
    key: Sequence[str] = ("doc_id",),
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 17,
    affinity: Column | None = None,
) -> DataFrame:
    """``docs`` with size, source_size, target and copies (long): how often the mix takes a row.

    ``size`` is a long per row, by default the words of ``text`` (null: 0). ``affinity`` is a
    positive expression per row; expected copies follow it up to ``most``, at a rate per source that makes the
    expected words its target; it defaults to 1, so that a document expects target / source_size copies. The whole part of the expected copies is certain. The
    rest is the inclusion probability p of one copy more: with u uniform by a hash of the key and
    the seed, rows are ranked by (u / (1 - u)) / (p / (1 - p)), and each source takes rows in that
    order until its target is met in words, the last one only if that brings it nearer. No row
    exceeds ``most`` copies.

    The end of each source's sample is found from sums per cell of the order score, once over all
    rows and once inside the cell that holds the end; a sort by score happens only among the few
    rows of the last cell. A source with a third of all rows is never sorted or gathered.

    Nulls: a null text has size 0; a null source is a source of its own; a null key hashes like
    any value. Rows of size 0 are taken as the order says, and add no words. Repeated rows are
    ranked apart. Reruns agree, as nothing but the rows decides. An empty table gives no rows.
    Extra columns stay; those named like a result or starting with ``_mix_`` are refused.
    """
    taken = {"size", "source_size", "target", "copies"}
    if clash := [c for c in docs.columns if c.lower() in taken or c.lower().startswith("_mix_")]:
        raise ValueError(f"columns clash with the result: {clash}")
    size = word_count(F.col("text")) if size is None else size
    ids = F.xxhash64(F.lit(seed), *[docs[c] for c in key])
    uniform = (F.shiftrightunsigned(ids, 11).cast("double") + 0.5) / float(1 << 53)
    rows = docs.select(
        *docs.columns,
        F.coalesce(size, F.lit(0)).cast("long").alias("_mix_size"),
        uniform.alias("_mix_u"),
        F.coalesce(affinity if affinity is not None else F.lit(1.0), F.lit(1.0)).cast("double").alias("_mix_a"),
    )
    slim = rows.select("source", "_mix_size", "_mix_u", "_mix_a").checkpoint()
    plan = sample_plan(slim, weights, most, affinity is not None)
    joined = rows.join(_few(plan).withColumnRenamed("source", "_mix_source"),
                       F.col("source").eqNullSafe(F.col("_mix_source")))
    extra = F.when(_order(F.col("_mix_m") - F.floor("_mix_m")) < F.col("_mix_end"), 1).otherwise(0)
    copies = F.least(F.floor("_mix_m").cast("long") + extra, F.lit(most).cast("long"))
    joined = joined.withColumn("_mix_m", _expected(most))
    return joined.select(
        *[joined[c] for c in docs.columns],
        F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), copies.alias("copies"),
    )


def _expected(most: int) -> Column:
    return F.least(F.col("_mix_rate") * F.col("_mix_a"), F.lit(float(most)))


def _order(p: Column) -> Column:
    """The Pareto order of a row as a number in (0, 1): odds of u over odds of p, q / (1 + q).

    Rows without a chance (p of 0) come after all others, by u.
    """
    u = F.col("_mix_u")
    up, down = u * (1 - p), (1 - u) * p
    last = 1 - (1 - u) * (0.5 ** 30)
    return F.when(p <= 0, last).otherwise(F.least(up / (up + down), F.lit(1 - 0.5 ** 30)))


def _few(plan: DataFrame) -> DataFrame:
    """A frame with a row per source, broadcast if there are few: rows of documents then stay where they are."""
    return F.broadcast(plan) if plan.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES else plan


def _solve(slim: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """The rates at which expected words, none above ``most`` times its row, add up to each source's target.

    Rows that a rate lifts to the limit stay there, as rates only rise: the others share what these leave open.
    Rounds end when no source has another row at its limit.
    """
    same = F.col("source").eqNullSafe(F.col("_mix_source"))
    capped = None
    while True:
        held = slim.join(_few(sources.select(F.col("source").alias("_mix_source"), "_mix_rate")), same).withColumn(
            "_mix_full", F.col("_mix_rate") * F.col("_mix_a") >= most)
        sums = held.groupBy("_mix_source").agg(
            F.count_if("_mix_full").alias("n"),
            F.coalesce(F.sum(F.when(F.col("_mix_full"), F.col("_mix_size"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~F.col("_mix_full"), F.col("_mix_size") * F.col("_mix_a"))), F.lit(0.0)).alias("open"),
        ).checkpoint()
        now = sums.agg(F.sum("n")).first()[0] or 0
        if now == capped:
            return sources
        capped = now
        rest = F.greatest(F.col("_mix_target") - most * F.col("full"), F.lit(0.0))
        sources = sources.join(sums, same, "left").withColumn(
            "_mix_rate", F.when(F.col("open") > 0, F.greatest(rest / F.col("open"), "_mix_rate")).otherwise(F.col("_mix_rate"))
        ).drop("_mix_source", "n", "full", "open").checkpoint()


def sample_plan(slim: DataFrame, weights: Sequence[float], most: int, unequal: bool = True) -> DataFrame:
    """Per source: size, target, expected copies per affinity, and the order score that ends its sample.

    Columns source, _mix_source_size, _mix_target, _mix_rate, _mix_end.
    """
    words = F.col("_mix_size")
    sums = slim.groupBy("source").agg(
        F.sum(words).alias("source_size"), F.sum(words * F.col("_mix_a")).alias("_mix_weighted")
    )
    sources = sums.select(F.col("source").alias("_mix_source"), "_mix_weighted").join(
        targets(sums.drop("_mix_weighted"), weights, most),
        F.col("source").eqNullSafe(F.col("_mix_source")),
    ).select(
        "source", F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target"),
        F.when(F.col("_mix_weighted") > 0, F.col("target") / F.col("_mix_weighted"))
        .otherwise(0.0).alias("_mix_rate"),
    ).checkpoint()
    if unequal:
        sources = _solve(slim, sources, most)
    side = _few(sources.withColumnRenamed("source", "_mix_source"))
    same = F.col("source").eqNullSafe(F.col("_mix_source"))
    expected = slim.join(side, same).withColumn("_mix_m", _expected(most))
    free = F.col("_mix_m") < most
    scored = expected.withColumn("_mix_q", F.when(free, _order(F.col("_mix_m") - F.floor("_mix_m"))))
    span = 1 << CELL_BITS
    scored = scored.select(
        "source", "_mix_size", "_mix_q", (F.floor("_mix_m") * words).alias("_mix_sure"),
        F.least(F.floor(F.col("_mix_q") * span), F.lit(span - 1)).cast("int").alias("_mix_cell"),
        F.least(F.floor(F.col("_mix_q") * span * span) % span, F.lit(span - 1)).cast("int").alias("_mix_fine"),
    )
    cells = scored.groupBy("source", "_mix_cell").agg(
        F.sum("_mix_size").alias("n"), F.sum("_mix_sure").alias("sure")
    ).checkpoint()
    sure = cells.groupBy("source").agg(F.sum("sure").alias("_mix_sure"))
    open_words = sources.join(sure.withColumnRenamed("source", "_mix_source"), same).select(
        "source", (F.col("_mix_target") - F.col("_mix_sure")).alias("need")
    )
    end = _end_cell(cells.where(F.col("_mix_cell").isNotNull()).select("source", "_mix_cell", "n"),
                    open_words, "_mix_cell").checkpoint()
    inside = _within(scored, end, "_mix_cell")
    fine = inside.groupBy("source", "_mix_fine").agg(F.sum("_mix_size").alias("n"))
    last = _end_cell(fine, end.select("source", "need"), "_mix_fine").checkpoint()
    final = _within(inside, last, "_mix_fine")
    running = Window.partitionBy("source").orderBy("_mix_q", "_mix_size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    need = last.select(F.col("source").alias("_mix_source"), "need")
    summed = final.withColumn("sum", F.sum("_mix_size").over(running)).join(need, same)
    nearer = 2 * F.col("sum") - F.col("_mix_size") <= 2 * F.col("need")
    # The first score left out ends the sample; where all of the last cell is taken, the cell's end does.
    border = (F.col("_mix_cell") * span + F.col("_mix_fine") + 1) / float(span * span)
    stop = summed.groupBy(F.col("source").alias("_mix_source")).agg(
        F.coalesce(F.min(F.when(~nearer, F.col("_mix_q"))), F.max(border)).alias("_mix_end"))
    ended = sources.join(stop, same, "left").drop("_mix_source")
    # Without an end cell nothing is needed beyond the certain copies.
    return ended.withColumn("_mix_end", F.coalesce("_mix_end", F.lit(0.0))).checkpoint()


def _end_cell(cells: DataFrame, need: DataFrame, name: str) -> DataFrame:
    """(source, end, need): the cell in which each source's words reach what it needs, and what is then open."""
    running = Window.partitionBy("source").orderBy(name).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = cells.withColumn("sum", F.sum("n").over(running)).join(
        need.withColumnRenamed("source", "_mix_source"),
        F.col("source").eqNullSafe(F.col("_mix_source")))
    reached = summed.where((F.col("need") > 0) & (F.col("sum") - F.col("n") < F.col("need")) & (F.col("n") > 0))
    pick = reached.groupBy("source").agg(
        F.max(F.struct(F.col(name).alias("cell"), (F.col("need") - F.col("sum") + F.col("n")).alias("need"))).alias("x"))
    return pick.select("source", F.col("x.cell").alias("end"), F.col("x.need").alias("need"))


def _within(rows: DataFrame, end: DataFrame, name: str) -> DataFrame:
    side = end.select(F.col("source").alias("_mix_source"), F.col("end").alias("_mix_last"))
    return rows.join(
        side, F.col("source").eqNullSafe(F.col("_mix_source")) & (F.col(name) == F.col("_mix_last"))
    ).drop("_mix_source", "_mix_last")


def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: doc_id, size, source_size, target, taken. Longer texts have better chances, by the logarithm of their words."""
    docs = require(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id", "text", "source"])
    mixed = pareto_mix(docs, affinity=1 + F.log(1 + word_count(F.col("text")).cast("double")))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))

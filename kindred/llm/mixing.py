"""Mixing sources to target weights by Pareto order sampling.

Sources take weights in order of code point (null last), repeating, and share all words by
weight; a source's target stops at ``most`` times its size and the excess is shared by the
others.  A source whose target is f times its size takes floor(f) copies of every document
for certain; the rest is one more copy of some.  For it each document has inclusion odds, those of
the fraction left times a factor that favours short documents (so that no long one decides a
source), and a random number u from its id; documents come in order of u's odds over the
inclusion odds, and are taken until the words left are reached.  The last is taken if that
comes nearer.

The order is never sorted as a whole: sums by bins of the order, twice refined, find the
document at which a source stops, and every document is then judged by itself.  Only sums of
bins meet in one task.

Null texts have size 0, null sources are a source; documents without words may be taken but
count nothing; rows that repeat id, source and size are taken alike.  Rows without an id draw by their text and, where
they are equal, by a number among equal rows, so each is taken by itself.  Nothing is drawn at run time,
so reruns agree.  An empty table gives an empty mix.  Extra columns are kept, but for those named like a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.llm.columns import ROW, field, fields, packed
from kindred.sources.staging import cut, small

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
BINS = 4096

BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def word_count(text: str | Column) -> Column:
    """Words of a text: the pieces between blank runs, without the two outer ones."""
    return (F.size(F.split(F.concat(F.lit(" "), F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(" ")), BLANK_RUN)) - 2).cast("long")


def _same_source(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on a source that may be null; b has one row a source."""
    other = b.withColumnRenamed("_source", "_source_b")
    return a.join(other, F.col("_source").eqNullSafe(F.col("_source_b")), how).drop("_source_b")


def shares(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(_source, _source_size, _target, _whole, _left, _fraction, _mean)``, one row a source.

    In order of limit over weight, a source is held to its limit if the share per weight that the
    words left allow is higher; the first that is not sets the share of all after it.
    """
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    own = sizes.groupBy("_source").agg(F.sum("_size").alias("_source_size"), F.count("*").alias("_n"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    own = own.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1)).withColumn(
        "_limit", F.col("_source_size") * most
    )
    rising = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("_source").asc_nulls_last())
    everything = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("_source_size").over(everything) - F.coalesce(F.sum("_limit").over(before), F.lit(0))) / F.sum("_weight").over(after)
    held = own.withColumn("_level", level).withColumn("_held", F.col("_level") * F.col("_weight") >= F.col("_limit"))
    share = F.min(F.when(~F.col("_held"), F.struct(F.col("_limit") / F.col("_weight"), "_level"))).over(everything)["_level"]
    target = F.when(F.col("_held"), F.col("_limit").cast("double")).otherwise(share * F.col("_weight"))
    ratio = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    return (
        held.withColumn("_target", target)
        .withColumn("_whole", F.floor(ratio + 1e-12))
        .withColumn("_left", F.greatest(F.col("_target") - F.col("_whole") * F.col("_source_size"), F.lit(0.0)))
        .withColumn("_fraction", F.greatest(ratio - F.col("_whole"), F.lit(0.0)))
        .withColumn("_mean", F.col("_source_size") / F.col("_n"))
        .select("_source", "_source_size", "_target", "_whole", "_left", "_fraction", "_mean")
    )


def pareto_rank(seed: str) -> Column:
    """Odds of the random number over the inclusion odds."""
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("")), "_mark", F.lit(":" + seed))), 1, 13), 16, 10)
    u = (draw.cast("double") + 0.5) / F.lit(float(1 << 52))
    favour = F.when(F.col("_size") > 0, F.sqrt(F.col("_mean") / F.col("_size"))).otherwise(1.0)
    return (u / (1 - u)) / (F.col("_fraction") / (1 - F.col("_fraction")) * favour)


def _stops(ranked: DataFrame, by: list[str], left: str) -> DataFrame:
    """The bin or document at which each source's running sum reaches the words left, and the sum before it."""
    order = Window.partitionBy("_source").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranked.withColumn("_sum", F.sum("_size").over(order))
        .where((F.col("_sum") >= F.col(left)) & (F.col("_sum") - F.col("_size") < F.col(left)))
        .withColumn("_before", F.col("_sum") - F.col("_size"))
    )


def _marked(rows: DataFrame) -> DataFrame:
    """Rows without an id, marked by source and text and a number among equal rows.

    Numbers run on from task to task, so equal rows, however many, meet in no task; written once, since they go by tasks.
    """
    same = F.sha2(F.to_json(F.struct(field("source").alias("s"), field("text").alias("t"))), 256)
    rows = cut(rows.withColumns({"_same": same, "_task": F.spark_partition_id()}))
    counts = rows.groupBy("_same", "_task").agg(F.count("*").alias("_n"))
    # One row a task and kind of row.
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_same").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_same", "_task", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("_same", "_task").orderBy(F.lit(0)))
    return (
        rows.withColumn("_within", within)
        .join(counts, ["_same", "_task"])
        .select(ROW, "_id", F.concat_ws("/", "_same", F.col("_before") + F.col("_within")).alias("_mark"))
    )


def mixture(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED
) -> DataFrame:
    """``documents`` with ``_size``, ``_source_size``, ``_target`` and ``_copies``."""
    rows = packed(documents).withColumn("_id", field("doc_id").cast("long"))
    known = rows.where("_id is not null").withColumn("_mark", F.lit(""))
    measured = known.unionByName(_marked(rows.where("_id is null"))).withColumns(
        {"_source": field("source"), "_size": word_count(field("text"))}
    )
    sizes = cut(measured.select("_id", "_mark", "_source", "_size"))
    plan = cut(shares(sizes, weights, most))
    n = plan.count()
    plan = small(plan, n)

    rank = F.col("_rank") / (1 + F.col("_rank"))
    ranked = _same_source(sizes, plan).where("_fraction > 0").withColumn("_rank", pareto_rank(seed))
    ranked = ranked.select("_source", "_id", "_mark", "_size", "_rank", (rank * BINS).alias("_at"), F.col("_left"))

    def bin_stop(rows: DataFrame, depth: int) -> DataFrame:
        binned = rows.groupBy("_source", F.floor("_at").alias("_bin")).agg(F.sum("_size").alias("_size"), F.first("_left").alias("_left"))
        stop = _stops(binned, ["_bin"], "_left").select("_source", F.col("_bin").alias(f"_bin{depth}"), (F.col("_left") - F.col("_before")).alias(f"_left{depth}"))
        return small(cut(stop), n)

    first = bin_stop(ranked, 1)
    inner = (
        _same_source(ranked, first)
        .where(F.floor("_at") == F.col("_bin1"))
        .select("_source", "_id", "_mark", "_size", "_rank", ((F.col("_at") - F.col("_bin1")) * BINS).alias("_at"), F.col("_left1").alias("_left"))
    )
    second = bin_stop(inner, 2)
    last = (
        _same_source(inner.drop("_left"), second).where(F.floor("_at") == F.col("_bin2")).groupBy("_source", "_rank", "_id", "_mark")
        .agg(F.sum("_size").alias("_size"), F.first("_left2").alias("_left"))
    )
    stop = _stops(last, ["_rank", "_id", "_mark"], "_left").select(
        "_source",
        F.struct("_rank", F.coalesce("_id", F.lit(-(1 << 63))).alias("_id"), "_mark").alias("_stop"),
        (F.col("_sum") - F.col("_left") <= F.col("_left") - F.col("_before")).alias("_with"),
    )
    stop = small(cut(stop), n)

    judged = _same_source(_same_source(measured, plan), stop, "left").withColumn("_rank", F.when(F.col("_fraction") > 0, pareto_rank(seed)))
    key = F.struct("_rank", F.coalesce("_id", F.lit(-(1 << 63))).alias("_id"), "_mark")
    more = F.when(
        (F.col("_fraction") > 0) & F.col("_stop").isNotNull(),
        ((key < F.col("_stop")) | ((key == F.col("_stop")) & F.col("_with"))).cast("long"),
    ).otherwise(F.lit(0))
    # The id decides between equal ranks, a null id first, then the mark.
    return judged.withColumn("_copies", F.col("_whole") + more).select(
        *fields(documents, "_size", "_source_size", "_target", "_copies"), "_size", "_source_size", "_target", "_copies"
    )


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    whole = packed(documents).select(ROW, *(field(c).alias(c) for c in ("doc_id", "source", "text")))
    out = mixture(whole, **options).where("_copies > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*fields(documents))

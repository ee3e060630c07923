"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

A document leaks an item if one of its windows of the item's length (the whole document, if
shorter) has a weighted shingle similarity of ``percent`` % or more: sum of the lesser over sum
of the greater multiplicity of each shingle.  Shingles take five words; an item with fewer words is
one shingle, as are its windows.

Only windows that hold enough of an item's shingles can be that similar, so windows are set at the
places where a document repeats one: sliding a window to the first repeated shingle in it never
lowers the similarity.  Windows and items meet on blocks of their SimHash, radius + 1 of them,
so that no fingerprint within the radius is missed; the Hamming distance and then the multiplicities
themselves decide.  A window or item that repeats a shingle has a SimHash of few, heavy votes, which flip together; such
pairs skip the SimHash and go to the multiplicities at once.  All of it is DataFrame expressions.

The items are broadcast below a checked number of shingles and merged by sort beyond it.
Null or blank texts match nothing; rows with a null id are not reported; rows that repeat an
id are one document (the best window counts); equal items are reported each.  Extra columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.sources.staging import build_side, cut

WIDTH = 5
PERCENT = 75
BITS = 64
# At the least similarity fingerprints differ in about 11 bits (deviation 3).
RADIUS = 26

BLANK = " \t\n\x0b\x0c\r"


def word_list(text: str) -> Column:
    """Lower-case words of a text; empty for null or blank."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANK))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def shingles(words: str, width: int) -> Column:
    """Hashes of each run of ``width`` words, in order."""
    return F.when(
        F.size(words) >= width,
        F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)), lambda i: F.xxhash64(F.slice(words, i, width))),
    ).otherwise(F.array().cast("array<bigint>"))


def simhash(values: str) -> Column:
    """64-bit SimHash: each bit has the sign of the sum of its votes; repeated shingles vote again."""

    def vote(bit: Column) -> Column:
        total = F.aggregate(
            values, F.lit(0), lambda acc, x: acc + F.call_function("getbit", x, bit).cast("int") * 2 - 1
        )
        return F.when(total >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(
        F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), vote), F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x)
    )


def distinct_values(values: str) -> Column:
    return F.size(F.array_distinct(values)) == F.size(values)


def hamming_blocks(fingerprint: str, radius: int) -> Column:
    """``radius + 1`` (block, value) pairs that cover all bits."""
    n = radius + 1
    edges = [BITS * k // n for k in range(n + 1)]
    return F.array(
        *(
            F.struct(
                F.lit(k).alias("block"),
                F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("value"),
            )
            for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False))
        )
    )


def shared_weight(a: str, b: str) -> Column:
    """Sum of the lesser multiplicity of each shingle."""
    return F.aggregate(
        F.array_intersect(a, b),
        F.lit(0),
        lambda acc, x: acc + F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))),
    )


def _of_width(docs: DataFrame, items: DataFrame, width: int, percent: int, radius: int) -> DataFrame:
    entries = items.select("item_id", "total", F.explode(F.array_distinct("item_shingles")).alias("shingle"))
    n = entries.count()
    places = docs.select("doc_id", F.posexplode(shingles("words", width)).alias("at", "shingle"))
    met = (
        places.join(build_side(entries, n), "shingle")
        .groupBy("doc_id", "item_id")
        .agg(F.sort_array(F.collect_list("at")).alias("places"), F.first("total").alias("total"))
        .where(100 * F.size("places") >= percent * F.col("total"))
        .select("doc_id", "item_id", "places")
    )
    met = cut(met)
    ids = met.select("doc_id").distinct()
    wanted = docs.join(build_side(ids, ids.count()), "doc_id").select(
        "doc_id", F.size("words").alias("n"), shingles("words", width).alias("doc_shingles")
    )
    last = F.greatest(F.col("n") - F.col("n_words"), F.lit(0))
    # Places are in order, so a window that starts at one holds enough if the place `need - 1` further on is in it.
    need = F.ceil(F.col("total") * percent / 100).cast("int")
    own = F.filter(
        F.transform("places", lambda p, i: F.when((p <= last) & (F.get("places", i + need - 1) < p + F.col("total")), p)),
        lambda s: s.isNotNull(),
    )
    beyond = (F.get("places", F.size("places") - 1) > last) & (F.get("places", F.size("places") - need) >= last)
    held = F.array_distinct(F.concat(own, F.when(beyond, F.array(last)).otherwise(F.array().cast("array<int>"))))
    windows = (
        wanted.join(met, "doc_id")
        .join(items.select("item_id", "total", "n_words", "item_plain"), "item_id")
        .select("doc_id", "item_id", "item_plain", F.explode(
            F.transform(held, lambda s: F.struct(s.alias("start"), F.slice("doc_shingles", s + 1, F.col("total")).alias("window")))
        ).alias("w"))
        .select("doc_id", "item_id", "w.start", "w.window", (F.col("item_plain") & distinct_values("window")).alias("plain"))
        .withColumn("print", F.when(F.col("plain"), simhash("window")))
    )
    windows = cut(windows)
    printed = items.select("item_id", "item_print", F.explode(hamming_blocks("item_print", radius)).alias("key"))
    near = (
        windows.where("plain").select("doc_id", "item_id", "start", "print", F.explode(hamming_blocks("print", radius)).alias("key"))
        .join(printed, ["item_id", "key"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select("doc_id", "item_id", "start")
        .distinct()
    )
    common = F.when(F.col("plain"), F.size(F.array_intersect("window", "item_shingles"))).otherwise(shared_weight("window", "item_shingles"))
    size = F.size("window") + F.size("item_shingles")
    candidates = windows.where("plain").join(near, ["doc_id", "item_id", "start"], "left_semi").unionByName(windows.where("not plain"))
    return (
        candidates
        .join(items.select("item_id", "item_shingles"), "item_id")
        .withColumn("common", common)
        .where((100 + percent) * F.col("common") >= percent * size)
        .select("doc_id", "item_id", "start", (F.col("common") / (size - F.col("common"))).alias("similarity"))
    )


def leaks(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, item_id, similarity, start)``: the best window of each leaked pair, the first of equals."""
    docs = documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), word_list("text").alias("words"))
    texts = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), word_list("text").alias("item_words"))
    texts = cut(texts.where(F.size("item_words") > 0).withColumn("n_words", F.size("item_words")))
    found = []
    for (w,) in texts.select(F.least("n_words", F.lit(width))).distinct().collect():  # at most `width` values
        mine = texts.where(F.least("n_words", F.lit(width)) == w).withColumn("item_shingles", shingles("item_words", w))
        mine = cut(
            mine.select("item_id", "n_words", F.size("item_shingles").alias("total"), "item_shingles", simhash("item_shingles").alias("item_print"), distinct_values("item_shingles").alias("item_plain"))
        )
        found.append(_of_width(docs, mine, w, percent, radius))
    if not found:
        return documents.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, start int")
    best = F.max_by(F.struct("similarity", "start"), F.struct("similarity", -F.col("start")))
    return (
        reduce(DataFrame.union, found)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.similarity", "best.start")
    )


def without_leaks(documents: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The documents that leak no item; rows with a null id stay."""
    return documents.join(leaks(documents, benchmark, **options).select("doc_id").distinct(), "doc_id", "left_anti")

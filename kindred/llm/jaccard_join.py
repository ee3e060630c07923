"""N-gram Jaccard self-join by parity sketches.

Every element of a document's shingle set toggles one place of a wide bit vector, so the
Hamming distance of two vectors never exceeds the symmetric difference of the sets.  Two
sets of sizes a and b with similarity p % or more differ in at most
``(100-p)(a+b)/(100+p)`` elements.  Per size band the vector is cut into more parts than
that; a part is never stored, but named by the XOR of its elements' hashes.  Pairs within
the bound must agree on a part among the first D+1 of either document in any order that all
documents share (pigeonhole); the order takes parts without elements, and parts made of
shingles that a sample shows to be common, last.  The order decides the cost, not the result.

Documents that share a part meet in stars first: each is compared with the least document of
the part, inside a task's batch and then between tasks, and with the document that has most
links so far.  Narrow sketches (two bits an element, and for a first look 1,024 bits, or 4,096 too where sets
are large) reject most pairs; the rest are verified on their whole sets.  Parts whose documents are then still in
different components are joined between those components, the first look being part of the
join; of parts that the same documents share, one is joined.  Parts of many documents are not joined
yet: their documents take part in another round in which these parts come last in the order, and only
in the last round is every part joined.  So no link between different components is lost.

The first look tells unrelated sets apart that have up to about 6,000 elements; larger ones pass it, and are
rejected by the sketch.

Null, empty or blank text: an empty set, linked with nothing.  Null ids: the row is
returned with a null component.  Rows that repeat an id are one document, linked by any of
its texts; each is returned.  Equal sets are one class before the join.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.llm import words as W
from kindred.operators.components import components
from kindred.sources.staging import cut, small

PERCENT = 75
WIDTH = 5
# Documents (about) whose shingles show what is common, and common shingles remembered at most.
# Both bound the driver's share; they change the order of the parts only.
SAMPLE_DOCS = 10_000
COMMON_SHINGLES = 100_000
COMMON_FROM = 3
LEAST_PARTS_LOG = 6
# Rounds at most, and documents from which a part waits for the next round.
ROUNDS = 2
WAITS_FROM = 24
# Parts that wait are remembered as places of a bit map of this size; parts that meet there by chance wait too.
PLACES = 1 << 22
# Parts from which a task sends on the stars of the texts it holds.
PARTS_AT_ONCE = 1 << 18
LOOK_BITS = 1024
LOOK = tuple(f"look_{k}" for k in range(LOOK_BITS // 64))
# Sets from this size on have a wide look too.
WIDE_FROM = 1024
WIDE_BITS = 4096

PROFILE = (
    "doc_id long, n_shingles long, fp_a long, fp_b long, sketch array<long>, "
    + ", ".join(f"{c} long" for c in LOOK)
    + ", wide array<long>, sampled array<long>"
)


def most_apart(a, b, percent: int = PERCENT):
    """Largest symmetric difference of sets of sizes a and b that are similar enough."""
    return (100 - percent) * (a + b) // (100 + percent)


def _sets(texts: W.Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    return W.distinct_within(*W.shingle_hashes(*W.word_hashes(texts), width))


def _level(sizes: np.ndarray) -> np.ndarray:
    return np.frexp(np.maximum(sizes, 1).astype(float))[1] - 1


def _starts(groups: np.ndarray) -> np.ndarray:
    """First row of each run."""
    return np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.zeros(0, np.int64)


def _sketches(doc: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity sketches as 64-bit words, and the number of words before each document's."""
    bits = np.where(sizes > 0, np.maximum(64, 2 << _level(sizes)), 0).astype(np.int64)
    before = np.r_[0, np.cumsum(bits)]
    place = before[doc] + (values & (bits[doc] - 1).astype(W.U64)).astype(np.int64)
    odd = (np.bincount(place, minlength=before[-1]) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64), before // 64


def _looks(doc: np.ndarray, values: np.ndarray, n: int, bits: int = LOOK_BITS) -> np.ndarray:
    """Parity sketches of ``bits`` bits, one row a document."""
    place = doc * bits + (values & W.U64(bits - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=bits * n) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(n, bits // 64)


def _wide_looks(doc: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """Wide looks of large sets; others have an empty one."""
    large = sizes >= WIDE_FROM
    own = large[doc]
    wide = _looks((np.cumsum(large) - 1)[doc[own]], values[own], int(large.sum()), WIDE_BITS)
    ends = np.r_[0, np.cumsum(np.where(large, WIDE_BITS // 64, 0))]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(wide.reshape(-1)))


def profile(docs: DataFrame, width: int, one_in: int) -> DataFrame:
    """One row a document: set size, 128-bit fingerprint of the set, sketch; a sample's sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in W.slices(batch, "text"):
                doc, values = _sets(texts, width)
                sizes = np.bincount(doc, minlength=len(texts))
                at = _starts(doc)
                fp = np.zeros((2, len(texts)), W.U64)
                if len(at):
                    fp[0, doc[at]] = np.add.reduceat(values, at)
                    fp[1, doc[at]] = np.bitwise_xor.reduceat(W.mix(values ^ W.U64(W.BASE)), at)
                sketch, before = _sketches(doc, values, sizes)
                look = _looks(doc, values, len(texts))
                taken = (W.mix(fp[0] ^ fp[1]) % W.U64(one_in)) == 0
                kept = values[taken[doc]]
                ends = np.r_[0, np.cumsum(np.where(taken, sizes, 0))]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(sizes.astype(np.int64)),
                        W.signed(fp[0]),
                        W.signed(fp[1]),
                        pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(sketch)),
                        *(pa.array(np.ascontiguousarray(look[:, k])) for k in range(len(LOOK))),
                        _wide_looks(doc, values, sizes),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), W.signed(kept)),
                    ],
                    names=["doc_id", "n_shingles", "fp_a", "fp_b", "sketch", *LOOK, "wide", "sampled"],
                )

    return docs.mapInArrow(run, PROFILE)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, shingles)``: the whole set of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in W.slices(batch, "text"):
                doc, values = _sets(texts, width)
                ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(texts)))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), W.signed(values))],
                    names=["doc_id", "shingles"],
                )

    return docs.mapInArrow(run, "doc_id long, shingles array<long>")


def _part_names(
    doc: np.ndarray, values: np.ndarray, sizes: np.ndarray, common: np.ndarray, waiting: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(document, part name)``: the parts by which each document is looked up.

    A pair is looked up in the band of its smaller set.  A document is there as the smaller
    or larger one in its own band, and as the larger one in the band below if a partner fits.
    """
    level = _level(sizes)
    own = np.maximum(
        most_apart(sizes, 100 * sizes // percent, percent), most_apart(sizes, sizes, percent)
    )
    band = np.left_shift(1, level)
    below = np.where(
        (sizes > 0) & (level > 0) & ((percent * sizes + 99) // 100 <= band - 1),
        most_apart(sizes, band - 1, percent) + 1,
        0,
    )
    is_common = np.zeros(len(values), bool)
    if len(common):
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        is_common = common[at] == values
    docs, names = [], []
    for levels, wanted in ((level, np.where(sizes > 0, own + 1, 0)), (level - 1, below)):
        use = wanted[doc] > 0
        d, v, c = doc[use], values[use], is_common[use]
        if not len(d):
            continue
        log = np.maximum(LEAST_PARTS_LOG, levels).astype(W.U64)
        part = v >> (W.U64(64) - log[d])  # the rows are in order of value, so parts are runs
        at = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (part[1:] != part[:-1])])
        d, part = d[at], part[at]
        band_part = W.mix(part + (levels[d].astype(W.U64) << W.U64(56)) + W.U64(W.BASE))
        name = W.mix(np.bitwise_xor.reduceat(v, at) ^ band_part)
        late = np.logical_and.reduceat(c, at)
        if len(waiting):
            late |= waiting[(name & W.U64(PLACES - 1)).astype(np.int64)]
        order = W.sort_within(d, late, name)
        d, name = d[order], name[order]
        first = _starts(d)
        rank = np.arange(len(d)) - np.repeat(first, np.diff(np.r_[first, len(d)]))
        take = rank < wanted[d]
        docs.append(d[take])
        names.append(name[take])
        filled = np.bincount(d, minlength=len(sizes))
        for i in np.flatnonzero(filled < wanted):  # parts without elements come last, by number
            have = part[_range(d, i)]
            free = np.setdiff1d(np.arange(1 << int(log[i])), have.astype(np.int64))[: wanted[i] - filled[i]]
            docs.append(np.full(len(free), i))
            names.append(W.mix(W.mix(free.astype(W.U64) + (W.U64(levels[i]) << W.U64(56)) + W.U64(W.BASE)) ^ W.U64(1)))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, W.U64)
    return np.concatenate(docs), np.concatenate(names)


def _range(doc: np.ndarray, i: int) -> slice:
    return slice(int(np.searchsorted(doc, i)), int(np.searchsorted(doc, i, side="right")))


def _stars(parts: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
    """``(part, doc_id, rep)``: the least document of each part, and the others with it as ``rep``."""
    part, doc_id = np.concatenate(parts), np.concatenate(ids)
    order = np.lexsort((doc_id, part))
    part, doc_id = part[order], doc_id[order]
    first = _starts(part)
    rep = np.repeat(doc_id[first], np.diff(np.r_[first, len(part)]))
    lead = np.zeros(len(part), bool)
    lead[first] = True
    keep = lead | (rep != doc_id)
    return pa.RecordBatch.from_arrays(
        [pa.array(part[keep]), pa.array(doc_id[keep]), pa.array(rep[keep], mask=lead[keep])],
        names=["part", "doc_id", "rep"],
    )


def part_stars(docs: DataFrame, common: np.ndarray, waiting: np.ndarray, width: int, percent: int) -> DataFrame:
    """``(part, doc_id, rep)``: documents and the least document that shares the part."""
    shared = docs.sparkSession.sparkContext.broadcast((common, waiting))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, ids, held = [], [], 0
            for rows, texts in W.slices(batch, "text"):
                doc, values = _sets(texts, width)
                sizes = np.bincount(doc, minlength=len(texts))
                doc, name = _part_names(doc, values, sizes, *shared.value, percent)
                parts.append(name.view(np.int64))
                ids.append(rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[doc])
                held += len(name)
                if held >= PARTS_AT_ONCE:
                    yield _stars(parts, ids)
                    parts, ids, held = [], [], 0
            if parts:
                yield _stars(parts, ids)

    met = docs.where("doc_id is not null").mapInArrow(run, "part long, doc_id long, rep long")
    # The texts held at once send one row for each part to that part's task; rows with a star of their own are dealt by document.
    place = Window.partitionBy("part", F.when(F.col("rep").isNotNull(), F.col("doc_id"))).orderBy("doc_id")
    return met.select(
        "part", "doc_id", F.coalesce("rep", F.first("doc_id").over(place.rowsBetween(Window.unboundedPreceding, 0))).alias("rep")
    ).where("doc_id <> rep")


def _hamming(a: str, b: str) -> Column:
    """Hamming distance of two sketches; the longer one is folded to the other's length."""

    def folded(x: str, y: str) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.when(
            F.size(x) > F.size(y),
            F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q)),
        ).otherwise(F.col(x))

    bits = F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(bits, F.lit(0), lambda total, x: total + x)


def _close(pairs: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose sizes and sketches allow a link, with both sizes."""
    bound = F.floor((F.col("n_a") + F.col("n_b")) * (100 - percent) / (100 + percent))
    sides = [leaders.select(F.col("leader").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"s_{s}")) for s in "ab"]
    sized = (
        pairs.join(sides[0], "a")
        .join(sides[1], "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    )
    return sized.where(_hamming("s_a", "s_b") <= bound).select("a", "b", "n_a", "n_b")


def _links(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    ids = cut(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    n = ids.count()
    if n == 0:
        return pairs.select("a", "b")
    wanted = docs.join(small(ids, n), "doc_id", "left_semi")
    sets = cut(shingle_sets(wanted, width))
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b"
    )
    same, sizes = F.size(F.array_intersect("set_a", "set_b")), F.size("set_a") + F.size("set_b")
    return both.where((100 + percent) * same >= percent * sizes).select("a", "b").distinct()


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_duplicates(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    one_in = max(1, docs.count() // SAMPLE_DOCS)
    known = cut(profile(docs, width, one_in))
    full = known.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("n_shingles", "fp_a", "fp_b").agg(F.min("doc_id").alias("leader"))
    member = cut(known.drop("sampled").join(classes, ["n_shingles", "fp_a", "fp_b"], "left"))
    # A class's own row; an id with several texts may lead several classes.
    leaders = cut(
        member.where("doc_id = leader")
        .dropDuplicates(["leader", "n_shingles", "fp_a", "fp_b"])
        .select("leader", F.col("n_shingles").alias("n"), "sketch", *LOOK, "wide")
    )
    renamed = member.where("doc_id <> leader").groupBy("doc_id").agg(F.min("leader").alias("leader"))
    common = _common(known)

    def led(df: DataFrame, column: str, name: str) -> DataFrame:
        """Replace copies by the class's leader."""
        to = renamed.select(F.col("doc_id").alias(column), F.col("leader").alias("_leader"))
        return df.join(to, column, "left").withColumn(name, F.coalesce("_leader", column)).drop("_leader")

    # Classes that an id is in by several texts are linked.
    tried = None
    several = member.where("doc_id is not null and leader is not null").groupBy("doc_id").agg(F.min("leader").alias("a"), F.max("leader").alias("b"))
    several = several.where("a <> b").select("doc_id", "a")
    links = fresh = cut(member.join(several, "doc_id").where("leader <> a").select("a", F.col("leader").alias("b")).distinct())
    found = None

    def test(pairs: DataFrame) -> None:
        """Verify the pairs not yet tried, and add their links."""
        nonlocal tried, links, fresh
        pairs = pairs.distinct()
        close = cut(_close(pairs if tried is None else pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti"), leaders, percent))
        new = cut(_links(close, docs, width, percent))
        tried = close if tried is None else tried.union(close)
        links, fresh = links.union(new), new if fresh is None else fresh.union(new)

    def merge() -> DataFrame:
        """Components after the links found since the last call."""
        nonlocal found, fresh
        if fresh is not None:
            found, fresh = cut(_merged(found, fresh)), None
        return found

    waiting, taking_part = np.zeros(0, bool), docs
    for turn in range(1, ROUNDS + 1):
        stars = cut(part_stars(taking_part, common, waiting, width, percent))
        met = led(led(stars.select("doc_id", "rep").distinct(), "doc_id", "x"), "rep", "y").where("x <> y")
        test(met.select(*_ordered("x", "y")))
        seats = led(stars.select("part", "doc_id").union(stars.select("part", "rep")).distinct(), "doc_id", "leader")
        seats = cut(_apart(seats.select("part", "leader").distinct(), merge()))
        if seats.isEmpty():
            break
        # The document with most links stands for each part.
        degree = links.select(F.col("a").alias("leader")).union(links.select("b")).groupBy("leader").agg(F.count("*").alias("degree"))
        hubs = seats.join(degree, "leader").groupBy("part").agg(F.max(F.struct("degree", "leader"))["leader"].alias("hub"))
        test(seats.join(hubs, "part").where("leader <> hub").select(*_ordered("leader", "hub")))
        seats = cut(_apart(seats.select("part", "leader"), merge()))
        if turn == ROUNDS:
            test(_across(seats, leaders, percent))
            break
        size = seats.groupBy("part").agg(F.count("*").alias("size"))
        late = cut(size.where(F.col("size") >= WAITS_FROM).select("part"))
        test(_across(seats.join(late, "part", "left_anti"), leaders, percent))
        if late.isEmpty():
            break
        places = late.select(F.col("part").bitwiseAND(F.lit(PLACES - 1)).alias("place")).distinct()
        waiting = waiting if len(waiting) else np.zeros(PLACES, bool)
        waiting[[r[0] for r in places.collect()]] = True  # at most PLACES numbers
        ids = cut(seats.join(late, "part", "left_semi").select(F.col("leader").alias("doc_id")).distinct())
        taking_part = docs.join(small(ids, ids.count()), "doc_id", "left_semi")
    merge()

    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "leader", "doc_id"))
    return member.select("doc_id", "n_shingles", "leader").join(found, "leader", "left").select("doc_id", "n_shingles", component.alias("component_id"))


def _common(known: DataFrame) -> np.ndarray:
    """Shingles that several documents of the sample hold, in order."""
    counted = known.select(F.explode("sampled").alias("shingle")).groupBy("shingle").count()
    most = counted.where(F.col("count") >= COMMON_FROM).orderBy(F.desc("count"), "shingle").limit(COMMON_SHINGLES)
    return np.sort(np.array([r[0] for r in most.collect()], np.int64).view(W.U64))


def _apart(seats: DataFrame, found: DataFrame) -> DataFrame:
    """``(part, leader, component)`` of the parts whose documents are in several components."""
    seats = seats.join(found, "leader", "left").select("part", "leader", F.coalesce("component", "leader").alias("component"))
    apart = seats.groupBy("part").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return seats.join(apart.select("part"), "part", "left_semi")


def _across(seats: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a part, are in different components, and look close enough."""
    shape = seats.groupBy("part").agg(
        F.count("*").alias("size"),
        F.min("leader").alias("low"),
        F.max("leader").alias("high"),
        F.bit_xor("leader").alias("odd"),
        F.bit_xor(F.xxhash64("leader")).alias("h"),
        F.bit_xor(F.xxhash64("leader", F.lit(1))).alias("g"),
    )
    shape = cut(shape)
    # Two or three documents need no join.
    middle = F.col("odd").bitwiseXOR(F.col("low")).bitwiseXOR(F.col("high"))
    three = F.array(*(F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in (("low", "high"), ("low", "mid"), ("mid", "high"))))
    few = shape.where("size <= 3").select("low", "high", middle.alias("mid"), "size")
    few = few.distinct().select(F.inline(F.when(F.col("size") == 3, three).otherwise(F.slice(three, 1, 1))))
    # Of parts that the same documents share one is enough.
    one = shape.where("size > 3").groupBy("size", "h", "g").agg(F.min("part").alias("part")).select("part")
    rows = seats.join(one, "part", "left_semi").join(leaders.select("leader", "n", *LOOK, "wide"), "leader")
    bound = (100 - percent) * (F.col("x.n") + F.col("y.n"))
    apart = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in LOOK), F.lit(0))
    wide = F.aggregate(F.zip_with("x.wide", "y.wide", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, c: total + c)
    joined = (
        rows.alias("x")
        .join(
            rows.alias("y"),
            (F.col("x.part") == F.col("y.part"))
            & (F.col("x.leader") < F.col("y.leader"))
            & (F.col("x.component") != F.col("y.component"))
            & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
            & (apart * (100 + percent) <= bound)
            & ((F.size("x.wide") != F.size("y.wide")) | (wide * (100 + percent) <= bound)),
        )
        .select(F.col("x.leader").alias("a"), F.col("y.leader").alias("b"))
    )
    return few.select("a", "b").union(joined)


def _merged(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """``(leader, component)`` of documents that have a link.

    ``found`` holds those of earlier links: only the components that new links join are contracted.
    """
    if found is None:
        return components(None, links).withColumnRenamed("pid", "leader")
    for side in "ab":
        to = found.select(F.col("leader").alias(side), F.col("component").alias("_to"))
        links = links.join(to, side, "left").withColumn(side, F.coalesce("_to", side)).drop("_to")
    joined = components(None, links)
    moved = found.join(joined.select(F.col("pid").alias("component"), F.col("component").alias("_to")), "component", "left")
    # A joined node that is not the least of a component had no link before.
    new = joined.withColumnRenamed("pid", "leader").join(found.select("leader"), "leader", "left_anti")
    return moved.select("leader", F.coalesce("_to", "component").alias("component")).union(new.select("leader", "component"))


def one_of_each(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents without near duplicates: the one with the least id of each component stays.

    Rows with an empty set or a null id all stay.  Rows that repeat the id of a document that
    stays do so too.
    """
    told = near_duplicates(documents, width, percent)
    gone = told.where("n_shingles > 0 and component_id <> doc_id").select(F.col("doc_id")).distinct()
    return documents.join(gone, "doc_id", "left_anti")

"""Line dedup by a log-template tree.

A line comes to a leaf by fixed steps: its number of tokens, then its first ``DEPTH`` tokens, those with a digit
read as ``<*>``.  Within its leaf every line has one template: its places whose tokens the most documents of the leaf have
there, as many as make ``CONSTANT_PERCENT`` % of its tokens and of its tokens after the lead (more where counts are
equal), stay; its other places are variable fields, ``<*>``.  A line without that many tokens that recur has none.  A
template found in enough documents recurs, and so does a line found unchanged in enough; these lines are dropped.

Templates of one leaf can hide each other, so the tree grows in rounds: the lines left in leaves where something new recurred
are read again, counting themselves and, at their constant places only, the templates that recur.  Such a template takes in
lines that come to it later, however few.  Rounds end when nothing new recurs.  A line being one template's, all
work is linear in lines and their tokens.

Enough are ``LEAST_DOCUMENTS`` documents, or ``LEAST_LONG`` for lines of ``LONG_TOKENS`` tokens or more, which seldom recur by
chance; what recurs in fewer stays.  Leaves in too few documents cannot hold such a template; only lines of the others are
taken apart.  Counts are added up before they move, so a line that a third of all documents hold sends one row a task.

Lines end at ``\\n``; tokens are words between ASCII white space; blank lines are kept and never counted.  Null texts stay
null; rows that repeat an id count as one document, each keeping its own lines; rows with a null id are counted as one
document.  A table without recurring lines is returned as it is.  All columns are kept, but for those named like a result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.columns import field, others, packed
from kindred.sources.staging import build_side, cut

DEPTH = 3
CONSTANT_PERCENT = 50
LEAST_DOCUMENTS = 8
LEAST_LONG = 3
LONG_TOKENS = 20
ANY = "<*>"
BLANK = " \t\x0b\x0c\r"


def tokens(line: Column) -> Column:
    bare = F.btrim(line, F.lit(BLANK))
    uneven = reduce(Column.__or__, (F.contains(bare, F.lit(b)) for b in ("  ", *BLANK[1:])))
    # Splitting at one character needs no regular expression.
    return F.when(uneven, F.split(bare, "[\\x20\\x09-\\x0D]+")).otherwise(F.split(bare, " "))


def masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), ANY).otherwise(token)


def leaf(line_tokens: Column, depth: int) -> Column:
    """Hash of the steps to a leaf."""
    lead = F.transform(F.slice(line_tokens, 1, depth), masked)
    return F.xxhash64(F.size(line_tokens), lead)


def _lines(documents: DataFrame, depth: int, least: int, least_long: int) -> DataFrame:
    """``(doc_id, line, leaf, bound)`` of each line with a token; ``bound``: documents that are enough in its leaf."""
    lines = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.where(F.btrim("line", F.lit(BLANK)) != "").withColumn("_tokens", tokens(F.col("line")))
    bound = F.when(F.size("_tokens") >= LONG_TOKENS, least_long).otherwise(least)
    return lines.select("doc_id", "line", leaf(F.col("_tokens"), depth).alias("leaf"), bound.alias("bound"))


def recurring_lines(
    documents: DataFrame,
    depth: int = DEPTH,
    percent: int = CONSTANT_PERCENT,
    least: int = LEAST_DOCUMENTS,
    least_long: int = LEAST_LONG,
) -> DataFrame:
    """``(line_id, template, documents)`` of every distinct line to drop, by the hash of its bytes.

    ``documents``: those whose lines had the template in the round in which the line came to it.
    """
    every = _lines(documents, depth, least, least_long)
    per_line = cut(every.select("leaf", "bound", "doc_id", F.xxhash64("line").alias("line_id")).distinct())
    leaves = per_line.select("leaf", "bound", "doc_id").distinct().groupBy("leaf", "bound").agg(F.count("*").alias("n"))
    leaves = cut(leaves.where(F.col("n") >= F.col("bound")).select("leaf"))
    n = leaves.count()
    # Lines of leaves that recur, and the number of documents that hold each.
    per_line = cut(per_line.join(build_side(leaves, n), "leaf", "left_semi").select("leaf", "bound", "doc_id", "line_id"))
    held = per_line.groupBy("leaf", "bound", "line_id").agg(F.count("*").alias("docs"))
    texts = (
        every.join(build_side(leaves, n), "leaf", "left_semi")
        .groupBy("leaf", F.xxhash64("line").alias("line_id"))
        .agg(F.first("line").alias("line"))
    )
    lines = cut(
        texts.join(held, ["leaf", "line_id"])
        .withColumn("tokens", tokens(F.col("line")))
        .select(
            "leaf", "bound", "line_id", "docs",
            F.transform(F.slice("tokens", 1, depth), masked).alias("lead"),
            F.slice("tokens", F.lit(depth + 1), F.size("tokens")).alias("tail"),
        )
    )
    exact = F.col("docs") >= F.col("bound")
    whole = lines.where(exact).select("line_id", F.array_join(F.concat("lead", "tail"), " ").alias("template"), F.col("docs").alias("documents"))
    found: DataFrame | None = None
    dropped, rounds = [whole], 0
    while True:
        rounds += 1
        shaped = cut(_templates(lines, found, percent))
        templates = (
            per_line.join(build_side(shaped.select("line_id", "template_id"), shaped.count()), "line_id")
            .groupBy("template_id", "doc_id", "bound").agg(F.lit(1).alias("one"))
            .groupBy("template_id", "bound").agg(F.count("*").alias("documents"))
        )
        if found is not None:
            templates = templates.join(found.select("template_id", F.lit(True).alias("old")), "template_id", "left")
        else:
            templates = templates.withColumn("old", F.lit(None).cast("boolean"))
        templates = cut(templates.where(F.col("old") | (F.col("documents") >= F.col("bound"))))
        n = templates.count()
        if not n:
            break
        gone = cut(shaped.join(build_side(templates.select("template_id", "documents"), n), "template_id"))
        dropped.append(gone.select("line_id", _rendered().alias("template"), "documents"))
        fresh = gone.join(build_side(templates.where("old is null").select("template_id"), n), "template_id", "left_semi")
        fresh = fresh.groupBy("template_id").agg(F.first("leaf").alias("leaf"), F.first("fixed").alias("fixed"), F.first("documents").alias("docs"))
        found = cut(fresh if found is None else found.unionByName(fresh))
        changed = gone.select("leaf").distinct()
        left = lines.where(~exact) if rounds == 1 else lines
        lines = cut(
            left.join(build_side(changed, changed.count()), "leaf", "left_semi")
            .join(build_side(gone.select("line_id"), gone.count()), "line_id", "left_anti")
            .select(*lines.columns)
        )
        if lines.isEmpty():
            break
    return reduce(DataFrame.unionByName, dropped).dropDuplicates(["line_id"])


def _places(tail: str) -> Column:
    return F.transform(tail, lambda token, place: F.struct(place.alias("place"), token.alias("token")))


def _templates(lines: DataFrame, found: DataFrame | None, percent: int) -> DataFrame:
    """``(line_id, leaf, lead, n, fixed, template_id)`` of each line with a template; ``fixed``: tokens after the lead that stay."""
    fields = lines.select("leaf", "bound", "line_id", "lead", F.size("tail").alias("n"), "docs", F.explode(_places("tail")).alias("at"))
    counted = fields.select("leaf", "at", "docs", "bound")
    if found is not None:
        known = found.select("leaf", F.explode("fixed").alias("at"), "docs", F.lit(0).alias("bound"))
        counted = counted.union(known.join(lines.select("leaf").distinct(), "leaf", "left_semi").select(*counted.columns))
    counts = counted.groupBy("leaf", "at").agg(F.sum("docs").alias("n_at"), F.max("bound").alias("bound"))
    counts = cut(counts.where(F.col("n_at") >= F.col("bound")).select("leaf", "at", "n_at"))
    constant_lead = F.size(F.filter("lead", lambda token: token != ANY))
    needed = F.greatest(
        F.ceil(F.col("n") * percent / 100), F.ceil((F.size("lead") + F.col("n")) * percent / 100) - constant_lead
    ).cast("int")
    common = (
        fields.join(build_side(counts, counts.count()), ["leaf", "at"])
        .groupBy("leaf", "line_id")
        .agg(F.first("lead").alias("lead"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "n_at"))).alias("common"))
        .withColumn("needed", needed)
        .where(F.size("common") >= F.col("needed"))
    )

    def stay(least: Column) -> Column:
        return F.transform(F.filter("common", lambda c: c["n_at"] >= least), lambda c: c["at"])

    least = F.get(F.sort_array("common.n_at", asc=False), F.col("needed") - 1)
    # Bound as a variable: written into the filter, it would be sorted anew for every place.
    fixed = F.get(F.transform(F.array(least), stay), 0)
    some = common.select("line_id", "leaf", "lead", "n", fixed.alias("fixed"))
    # Lines that end with the lead.
    bare = lines.where(F.size("tail") == 0).where(100 * constant_lead >= percent * F.size("lead"))
    bare = bare.select("line_id", "leaf", "lead", F.lit(0).alias("n"), F.array().cast(some.schema["fixed"].dataType).alias("fixed"))
    return some.union(bare).withColumn("template_id", F.xxhash64("leaf", "fixed"))


def _rendered() -> Column:
    """The template as text."""

    def piece(f: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("fixed", i - 1)["place"]).otherwise(-1)
        return F.concat(F.repeat(F.lit(ANY + " "), f["place"] - before - 1), f["token"])

    last = F.coalesce(F.get("fixed", F.size("fixed") - 1)["place"], F.lit(-1))
    rest = F.when(F.col("n") - last > 1, F.array(F.rtrim(F.repeat(F.lit(ANY + " "), F.col("n") - last - 1))))
    return F.array_join(F.concat("lead", F.transform("fixed", piece), F.coalesce(rest, F.array().cast("array<string>"))), " ")


def without_recurring_lines(documents: DataFrame, **options: int) -> DataFrame:
    """``documents`` with ``text`` less the recurring lines, and ``_lines`` and ``_dropped`` counts."""
    drop = cut(recurring_lines(documents, **options).select("line_id"))
    n = drop.count()
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "text")
    lines = documents.select(key.alias("_key"), F.explode(F.array_distinct(F.split("text", "\n"))).alias("_line"))
    gone = (
        lines.withColumn("line_id", F.xxhash64("_line"))
        .join(build_side(drop, n), "line_id", "left_semi")
        .groupBy("_key")
        .agg(F.collect_set("line_id").alias("_gone"))
    )
    rows = packed(documents).withColumn("_key", F.xxhash64(F.coalesce(field("doc_id").cast("long"), F.lit(0)), field("text")))
    # As many documents may hold recurring lines as there are, so this side is never broadcast.
    rows = rows.join(gone.hint("merge"), "_key", "left").withColumn("_split", F.split(field("text"), "\n"))
    kept = F.when(F.col("_gone").isNull(), F.col("_split")).otherwise(
        F.filter("_split", lambda line: ~F.array_contains("_gone", F.xxhash64(line)))
    )
    rows = rows.withColumn("_kept", kept)
    text = F.when(F.col("_gone").isNull(), field("text")).otherwise(F.array_join("_kept", "\n"))
    return rows.select(
        *[text.alias(c) if c.lower() == "text" else field(c).alias(c) for c in others(documents, "_lines", "_dropped")],
        F.coalesce(F.size("_split"), F.lit(0)).alias("_lines"),
        F.coalesce(F.size("_split") - F.size("_kept"), F.lit(0)).alias("_dropped"),
    )

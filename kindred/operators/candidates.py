"""First candidate generator: items that share phrases with the first item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.fixed import CANDIDATE_LIMIT, CANDIDATE_OVERLAP
from kindred.functions.text import last_paragraph, paragraph_tokens
from kindred.operators.overlap import shared_phrases


def candidates(
    related: DataFrame, *, more_than: int = CANDIDATE_OVERLAP, limit: int = CANDIDATE_LIMIT
) -> DataFrame:
    """Distinct ``(name, paragraph, overlap)`` in row order, the first item included.

    ``related(item_id, ord, name, text)``.  Overlap counts shared phrases of the
    last paragraphs.  Repeats are recognised by a digest of the paragraph, so
    only the rows that are returned carry their text through the shuffle.
    """
    words = related.select("item_id", paragraph_tokens("text").alias("tokens"))
    first_id = related.select(F.min_by("item_id", "ord")).scalar()
    first = words.where(F.col("item_id") == first_id).withColumnRenamed("item_id", "anchor_id")
    shared = shared_phrases(first, words).where(F.col("shared") > more_than)

    paragraph = last_paragraph("text")
    keyed = related.select("item_id", "ord", "name", F.sha2(paragraph, 256).alias("digest"))
    chosen = (
        keyed.join(shared, "item_id")
        .groupBy("name", "digest", F.col("shared").alias("overlap"))
        .agg(F.min("ord").alias("ord"))
        .orderBy("ord")
        .limit(limit)
    )
    texts = related.select("ord", paragraph.alias("paragraph"))
    return (
        texts.join(F.broadcast(chosen), "ord")  # at most ``limit`` rows
        .select("ord", "name", "paragraph", "overlap")
        .orderBy("ord")
    )

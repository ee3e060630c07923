"""A corpus from raw documents: each stage reads what the one before it kept, as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import decontaminate, jaccard_join, mixing, rans_tokens, toxicity_fm
from kindred.llm.columns import unused
from kindred.llm.queries import read, tokenizer_path
from kindred.sources.staging import cut, staged_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine rejects go.

    Null and empty texts have the base rate and stay unless most labelled rows are toxic; repeated rows go or stay alike.
    An empty table, or one without labels of both kinds, keeps all.  Extra columns stay, whatever their names.
    """
    score = unused(docs, "_score")
    return toxicity_fm.toxicity(docs, read(spark, sf_dir, "labels"), column=score).where(F.col(score) < 0.5).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: its least id.

    Null and blank texts are alike to nothing and stay.  An empty table stays empty.  Extra columns stay.
    """
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go.

    Null and blank texts leak nothing, rows with a null id stay, rows that repeat an id go together.  An empty table or
    benchmark changes nothing.  Extra columns stay.
    """
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null texts have no words and count nothing; null sources are a source; rows that repeat id, source and size are taken
    alike, rows without an id one by one.  An empty table stays empty.  Extra columns stay.
    """
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written as token blocks; what the read-back finds of each.

    Null and empty texts are an end id; rows that repeat an id follow each other.  An empty table gives no row.  Extra
    columns are left out.
    """
    path = staged_path(spark, "tokens")
    rans_tokens.write_tokens(docs, path, tokenizer_path())
    return rans_tokens.read_tokens(spark, path, with_ids=False)


STAGES = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("tokens", tokens),
]

# The machine's fit, the random draws and the block code cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

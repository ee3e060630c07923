from pyspark.sql import functions as F

from kindred.functions.labels import decode_all, feature_labels, is_legendary, label_set
from kindred.functions.noise import gaussian, uniform_int
from kindred.functions.text import (
    display_text,
    last_paragraph,
    matches,
    paragraph_tokens,
    phrase_count,
    phrases,
    tokens,
)


def values(spark, rows, expression, schema="c string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r.v for r in df.select(expression.alias("v")).collect()]


def test_tokens(spark):
    texts = ["A\\nb: c", " a  b . ", ".", " x\ty ", "", "Draw, a CARD.\n"]
    assert values(spark, texts, tokens("c")) == [
        ["a", "b", "c"], ["a", "", "b", ""], [""], ["x\ty"], [""], ["draw", "a", "card"],
    ]


def test_phrases(spark):
    listed = values(spark, ["a b c", "a a", "."], phrases(tokens("c")))
    assert listed == [["a", "a b", "a b c", "b", "b c", "c"], ["a", "a a", "a"], [""]]
    assert values(spark, ["a b c", "."], phrase_count(tokens("c"))) == [6, 1]


def test_last_paragraph(spark):
    assert values(spark, ["x\\ny\\nZ, q.", "one"], last_paragraph("c")) == ["Z, q.", "one"]
    assert values(spark, ["x\\ny\\nZ, q."], phrases(paragraph_tokens("c"))) == [["Z,", "Z, q.", "q."]]


def test_display_and_matches(spark):
    assert values(spark, ["a\\nb"], display_text("c")) == ["a- b"]
    texts = ["paper, x", None, "PAPER", "p.per"]
    assert values(spark, texts, matches("c", "paper")) == [True, False, False, False]
    assert values(spark, texts, matches("c", "p.per")) == [False, False, False, True]
    assert values(spark, texts, matches("c", "p.per", regex=True, ignore_case=True)) == [True, False, True, True]


def test_labels(spark):
    texts = ["W, U", "U,U", None, ""]
    assert values(spark, texts, label_set("c")) == [["W", "U"], ["U"], [], [""]]
    assert values(spark, texts, feature_labels("c")) == [["W", "U"], ["U", "U"], [""], [""]]
    assert values(spark, ["W, Q"], decode_all(label_set("c"))) == [["White", "Q"]]
    assert values(spark, ["Legendary, Snow", None, "Basic"], is_legendary("c")) == [True, False, False]


def test_draws_follow_the_key_not_the_partition(spark):
    ids = spark.range(2000)
    draw = ids.select("id", uniform_int(F.lit(3), F.lit(9), 1, F.col("id")).alias("u"), gaussian(1, F.col("id")).alias("g"))
    again = ids.repartition(7).select("id", uniform_int(F.lit(3), F.lit(9), 1, F.col("id")).alias("u"), gaussian(1, F.col("id")).alias("g"))
    assert draw.exceptAll(again).isEmpty()
    low, high, mean, std = draw.agg(F.min("u"), F.max("u"), F.avg("g"), F.stddev("g")).first()
    assert (low, high) == (3, 8) and abs(mean) < 0.1 and abs(std - 1) < 0.1
    same = ids.limit(1).select(uniform_int(F.lit(4), F.lit(4), 1, F.col("id")).alias("u"))
    assert same.first().u == 4

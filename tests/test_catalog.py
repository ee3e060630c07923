import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string as parse

from kindred.functions.labels import feature_labels, label_set
from kindred.operators import clean, labelsets, lookup, profile
from kindred.plans.extract import extract_to_csv
from kindred.sources import dictionary, tables
from kindred.sources.jdbc import jdbc_options
from kindred.streaming.rows import clean_arrivals, predict_arrivals

COLUMNS = ("name", "availability", "types", "text", "edhrecRank")
SCHEMA = "ord long, name string, availability string, types string, text string, edhrecRank double"


def test_cleaning_order(spark):
    items = spark.createDataFrame(
        [
            (0, "n", "paper", "Creature", "x", 1.0),
            (1, "n", "paper", "Creature", None, 2.0),     # the last of n has no text: n is gone
            (2, "m", "mtgo", "Creature", "x", 3.0),
            (3, "o", "paper, mtgo", "Land", "x", 50.0),
            (4, "p", "paper", "Creature", "x", 5.0),
            (5, "q", "paper", "Artifact", "x", None),
            (6, "r", "paper", None, "x", 9.0),
            (7, "s", None, "Creature", "x", 4.0),
        ],
        SCHEMA,
    )
    kept = clean.clean_items(items, columns=COLUMNS).orderBy("ord").collect()
    assert [(r.name, r.edhrecRank) for r in kept] == [("p", 5.0), ("q", 9.0), ("r", 9.0)]


def test_cohorts_match_inside_codes(spark):
    items = spark.createDataFrame([("DSK",), ("PDSK",), ("ABC",), (None,)], "setCode string")
    current, upcoming = clean.split_cohorts(items)
    assert current.count() == 2 and upcoming.count() == 2


def test_typed_fill(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None)],
        "text string, isReserved boolean, edhrecRank double, toughness string, colors string",
    )
    row = clean.typed_fill(df, flags=("isReserved",), numbers=("edhrecRank",), lists=("colors",)).first()
    assert tuple(row) == ("", False, -1.0, "-1", [])


def labelled(spark):
    rows = [(1, "anchor", "U, B"), (2, "u", "U"), (3, "b", "B"), (4, "bu", "B, U"), (5, "none", None), (6, "w", "W"), (7, "uw", "U, W")]
    items = spark.createDataFrame(rows, "ord long, name string, colorIdentity string")
    return items.withColumn("labels", label_set("colorIdentity"))


def test_label_subset(spark):
    items = labelled(spark)
    names = lambda anchor: {r.name for r in labelsets.legal_items(items, anchor).collect()}
    assert names("anchor") == {"anchor", "u", "b", "bu", "none"}
    assert names("none") == {"none"}
    assert names("unknown") == set()


def test_cosine(spark):
    rows = [(1, ["a", "b"]), (2, ["b", "c"]), (3, []), (4, ["a", "b"])]
    items = spark.createDataFrame(rows, "item_id long, features array<string>")
    near = {r.item_id: r.similarity for r in labelsets.nearest(items, 1).collect()}
    assert near == {2: 0.5, 3: 0.0, 4: 1.0}
    assert labelsets.nearest(items, 99).count() == 0


def test_multi_hot(spark):
    rows = [(1, None, "Flying, Haste", "Legendary"), (2, "W", None, None)]
    items = spark.createDataFrame(rows, "item_id long, colorIdentity string, keywords string, supertypes string")
    featured = labelsets.item_features(items)
    words = labelsets.vocabulary(featured)
    assert words == ["color:", "color:White", "flag:legendary", "kw:", "kw:Flying", "kw:Haste"]
    vectors = {r.item_id: list(r.vector.toArray()) for r in labelsets.multi_hot(featured, words).collect()}
    assert vectors == {1: [1, 0, 1, 0, 1, 1], 2: [0, 1, 0, 1, 0, 0]}


def test_lookups(spark):
    items = spark.createDataFrame(
        [(i, f"Red Ogre {i}", "Creature", "1R", "a\\nb", 1.0, "S") for i in range(12)]
        + [(12, "red rock", "Artifact", None, "x", 2.0, "S"), (13, "a.b", "Creature", None, "x", 2.0, "S")],
        "ord long, name string, types string, manaCost string, text string, edhrecRank double, setCode string",
    )
    assert [r.ord for r in lookup.search_names(items, "red").collect()] == list(range(10))
    assert lookup.search_names(items, "a.b").count() == 1
    assert lookup.item_card(items, "Red Ogre 3").first().cardtext == "a- b"
    assert lookup.item_card(items, "nobody").count() == 0
    assert {tuple(r) for r in lookup.cells_equal(items, "S").collect()} == {(i, "setCode") for i in range(14)}
    assert [tuple(r) for r in lookup.columns_always_equal(items, "red rock").collect()] == [("name", 1)]
    assert lookup.has_name(items, "a.b").first().found and not lookup.has_name(items, "zz").first().found


def test_recommendation_card_fills_missing(spark):
    recs = spark.createDataFrame(
        [(1, "n", None, "Creature", "a\\nb", 0.5, 7.0, None)],
        "card_index long, name string, manaCost string, types string, text string, sim_score double, edhrecRank double, edhrecRank_prediction double",
    )
    row = lookup.recommendation_card(recs, "n").first()
    assert (row.manaCost, row.edhrec_predicted, row.edhrec, row.cardtext) == ("manaCost not found", "manaCost not found", "7.0", "a- b")


def test_counts(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b"],), ([],)], "labels array<string>")
    assert [tuple(r) for r in profile.label_counts(df, "labels", top=1).collect()] == [("b", 2)]
    texts = spark.createDataFrame([("a, b",), (None,), ("",), (None,)], "text string")
    counts = profile.label_counts(texts.select(feature_labels("text").alias("labels")), "labels").collect()
    assert sorted(map(tuple, counts)) == [("", 3), ("a", 1), ("b", 1)]


def test_csv_keeps_quotes_breaks_and_blanks(spark, tmp_path):
    rows = [('say "x", y', 'line\none "q"'), (" pad ", None), ("lit\\n", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    path = str(tmp_path / "out")
    tables.write_csv(df, path)
    back = tables.read_csv(spark, path, df.schema)
    # An empty field is null, whether quoted or not.
    expected = [(a, b or None) for a, b in rows]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(expected, key=str)


def test_csv_without_breaks_can_be_split(spark, tmp_path):
    rows = [(i, f'say "{i}", x') for i in range(50)]
    df = spark.createDataFrame(rows, "ord long, text string")
    tables.write_csv(df, str(tmp_path / "c"))
    got = tables.read_csv(spark, str(tmp_path / "c"), df.schema, multi_line=False)
    assert sorted(map(tuple, got.collect())) == rows


def test_na_tokens_are_opt_in(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\nNone,1\nx,\n")
    schema = "a string, b string"
    plain = tables.read_csv(spark, str(tmp_path / "t.csv"), parse(schema)).collect()
    assert [tuple(r) for r in plain] == [("None", "1"), ("x", None)]
    nulled = tables.read_csv(spark, str(tmp_path / "t.csv"), parse(schema), na_tokens=["None"]).collect()
    assert nulled[0].a is None


def test_row_order_over_several_files(spark, tmp_path):
    for name, rows in (("b.csv", ["3", "4"]), ("a.csv", ["0", "1", "2"]), ("c.csv", ["5"])):
        (tmp_path / name).write_text("v\n" + "\n".join(rows) + "\n")
    df = tables.with_row_order(tables.read_csv(spark, str(tmp_path), parse("v long")))
    assert {(r.v, r.ord) for r in df.collect()} == {(i, i) for i in range(6)}


@pytest.mark.parametrize("multi_line", [False, True])
def test_row_order_of_split_files(spark, tmp_path, multi_line):
    sizes, value = {"a": 700, "b": 1, "c": 0, "d": 400}, 0
    for name, n in sizes.items():
        rows = [str(value + i) + "," + "x" * ((value + i) % 37) for i in range(n)]
        (tmp_path / f"{name}.csv").write_text("\n".join(["v,pad", *rows]) + "\n")
        value += n
    was = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        scan = tables.read_csv(spark, str(tmp_path), parse("v long, pad string"), multi_line=multi_line)
        splits = scan.select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
        got = tables.with_row_order(scan).select("v", "ord").collect()
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
    assert splits == 3 if multi_line else splits > 8
    assert sorted(map(tuple, got)) == [(i, i) for i in range(value)]
    empty = tables.with_row_order(tables.read_csv(spark, str(tmp_path / "c.csv"), parse("v long, pad string")))
    assert empty.count() == 0 and empty.columns == ["v", "pad", "ord"]


def test_dictionary(spark, tmp_path):
    content = {"meta": {"date": "d", "version": "v"}, "data": {"abilityWords": ["A", "B"], "keywordAbilities": ["C"], "keywordActions": []}}
    path = tmp_path / "k.json"
    path.write_text(json.dumps(content, indent=1))
    words = dictionary.read_dictionary(spark, str(path))
    assert {tuple(r) for r in words.collect()} == {("abilityWords", "A"), ("abilityWords", "B"), ("keywordAbilities", "C")}
    assert {tuple(r) for r in dictionary.category_counts(words).collect()} == {("abilityWords", 2), ("keywordAbilities", 1)}


def test_jdbc_options_take_credentials_from_the_environment(monkeypatch):
    monkeypatch.setenv("KINDRED_JDBC_USER", "u")
    monkeypatch.delenv("KINDRED_JDBC_PASSWORD", raising=False)
    options = jdbc_options("jdbc:x", "cards", partition_column="id", bounds=(0, 9), partitions=3)
    assert options["dbtable"] == "(SELECT name, colorIdentity, keywords, supertypes, id FROM cards) extract"
    assert options["user"] == "u" and "password" not in options and options["numPartitions"] == "3"


def test_row_operators_run_on_a_stream(spark, tmp_path):
    source = spark.createDataFrame(
        [("paper", "Creature", "A b.", "W, U", 2.0), ("mtgo", "Creature", "x", None, 1.0), ("paper", "Land", "x", None, 1.0)],
        "availability string, types string, text string, colorIdentity string, sim_score double",
    )
    path = str(tmp_path / "in")
    source.write.parquet(path)
    stream = spark.readStream.schema(source.schema).parquet(path)
    query = (
        predict_arrivals(clean_arrivals(stream), 3.0, 1.0)
        .writeStream.format("memory").queryName("arrivals").trigger(availableNow=True).start()
    )
    query.awaitTermination(60)
    rows = spark.table("arrivals").collect()
    assert [(r.tokens, r.labels, r.prediction) for r in rows] == [(["a", "b"], ["W", "U"], 7.0)]


def test_extract_that_cannot_read_says_so(spark, tmp_path, caplog):
    """No driver takes the address: nothing is connected to, nothing is written."""
    target = tmp_path / "out"
    assert extract_to_csv(spark, "jdbc:unknown:nowhere", "cards", str(target)) is False
    assert not target.exists()
    assert "extract of cards failed" in caplog.text

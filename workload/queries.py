"""Registered queries: each operator on the given tables, read whole.

The given tables stand in for an item catalog; the mapping is stated at each
query.  Doubles are rounded where their last digits depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.labels import decode_all, feature_labels, label_set
from kindred.functions.noise import gaussian, uniform_int
from kindred.functions.text import (
    display_text,
    paragraph_tokens,
    phrases,
    tokens,
)
from kindred.operators import (
    clean,
    features,
    labelsets,
    lookup,
    overlap,
    profile,
    rank_clusters,
    regression,
    rules,
)
from kindred.operators.candidates import candidates as find_candidates
from kindred.operators.dbscan import dbscan as run_dbscan
from kindred.operators.silhouette import silhouette as score_silhouette
from kindred.operators.ward import ward as run_ward
from kindred.plans import feature_report, related, upcoming
from kindred.sources import dictionary, staging, tables

ANCHOR = "doc-1"
COHORT = "src1"
MARK = "\\n"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return staging.spread(tables.read_table(spark, f"{sf_dir}/{name}.parquet", *columns))


# --- stand-in catalogs -------------------------------------------------------


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as items; the name repeats, some texts and ranks are missing."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ord"),
        F.concat_ws("-", "p_name", "p_size").alias("name"),
        F.col("p_brand").alias("availability"),
        F.col("p_type").alias("types"),
        F.when(F.col("p_size") != 13, F.concat_ws(MARK, "p_name", "p_brand", "p_type")).alias("text"),
        F.when(F.col("p_size") > 5, F.col("p_retailprice")).alias("edhrecRank"),
        F.col("p_brand").alias("setCode"),
        F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("string")).alias("manaCost"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as items; labels are the return flags of their lines."""
    flags = (
        table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag")
        .groupBy(F.col("l_orderkey").alias("item_id"))
        .agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ", ").alias("colorIdentity"))
    )
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus").select(
        F.col("o_orderkey").alias("item_id"),
        F.col("o_orderkey").alias("ord"),
        F.concat(F.lit("order-"), F.col("o_orderkey")).alias("name"),
        F.col("o_orderpriority").alias("keywords"),
        F.when(F.col("o_orderstatus") == "F", "Legendary").when(F.col("o_orderstatus") == "O", "Basic").alias("supertypes"),
    )
    return orders.join(flags, "item_id", "left")


def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items; language is the label, length the rank, source the cohort."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("item_id"),
        F.col("doc_id").alias("ord"),
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("name"),
        "text",
        label_set("lang").alias("labels"),
        F.col("n_chars").cast("double").alias("rank"),
        F.col("source").alias("setCode"),
        F.when(F.col("lang") != "fr", F.col("lang")).alias("manaCost"),
        F.col("lang").alias("types"),
    )


def marked(text: str) -> Column:
    """The tables hold real line breaks; items hold the two-character mark."""
    return F.replace(F.col(text), F.lit("\n"), F.lit(MARK))


def line_key() -> Column:
    return F.concat_ws(":", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    ).withColumn("key", line_key())


def deck(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = document_items(spark, sf_dir)
    return related.anchor_set(items, ANCHOR), items


# --- counts, cleaning, lookups ----------------------------------------------


def label_counts_top(spark, sf_dir):
    items = order_items(spark, sf_dir).withColumn("labels", feature_labels("colorIdentity"))
    return profile.label_counts(items, "labels", top=10)


def label_counts_all(spark, sf_dir):
    items = order_items(spark, sf_dir).withColumn("labels", decode_all(feature_labels("colorIdentity")))
    return profile.label_counts(items, "labels")


def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "part", "p_type"), "p_type")


def dedup_keep_last(spark, sf_dir):
    return clean.keep_last(table(spark, sf_dir, "part"), "p_name", "p_partkey")


def clean_chain(spark, sf_dir):
    columns = ("name", "availability", "types", "text", "edhrecRank", "setCode", "manaCost")
    return clean.clean_items(
        part_items(spark, sf_dir), availability="Brand#1", dropped_type="PROMO", columns=columns
    )


def typed_fill(spark, sf_dir):
    customers = table(spark, sf_dir, "customer", "c_custkey")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey",
        F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"),
        F.col("o_orderpriority").alias("text"),
        (F.col("o_orderstatus") == "F").alias("isReserved"),
        F.col("o_totalprice").alias("edhrecRank"),
        F.col("o_orderstatus").alias("toughness"),
        F.concat_ws(", ", "o_orderstatus", "o_orderpriority").alias("_list"),
    )
    listed = joined.withColumn("colors", F.when(F.col("_list") != "", F.col("_list"))).drop("_list")
    filled = clean.typed_fill(
        listed, flags=("isReserved",), numbers=("edhrecRank",), lists=("colors",)
    )
    return filled.withColumn("colors", F.array_join("colors", "|"))


def drop_unranked(spark, sf_dir):
    items = part_items(spark, sf_dir).select("ord", F.coalesce("edhrecRank", F.lit(-1.0)).alias("edhrecRank"))
    return clean.drop_unranked(items)


def cohort_split(spark, sf_dir):
    items = document_items(spark, sf_dir).select("item_id", "setCode")
    current, coming = clean.split_cohorts(items, COHORT)
    return current.withColumn("cohort", F.lit("current")).unionByName(
        coming.withColumn("cohort", F.lit("upcoming"))
    )


def label_subset(spark, sf_dir):
    items = order_items(spark, sf_dir).withColumn("labels", label_set("colorIdentity"))
    legal = labelsets.legal_items(items, "order-0")
    return legal.select("item_id", F.array_join("labels", ", ").alias("labels"))


def name_search(spark, sf_dir):
    return lookup.search_names(part_items(spark, sf_dir), "RING", type_term="economy")


def name_search_regex(spark, sf_dir):
    return lookup.search_names(part_items(spark, sf_dir), "^red .*-1[0-9]$", type_term="STANDARD|promo", regex=True)


def point_lookup(spark, sf_dir):
    return lookup.item_card(part_items(spark, sf_dir), "small ring-11")


def any_cell_search(spark, sf_dir):
    items = part_items(spark, sf_dir)
    return lookup.cells_equal(items, "Brand#17")


def any_cell_columns(spark, sf_dir):
    return lookup.columns_always_equal(part_items(spark, sf_dir), "Brand#17")


def exists(spark, sf_dir):
    items = part_items(spark, sf_dir)
    return lookup.has_name(items, "small ring-11").withColumn("name", F.lit("small ring-11")).unionByName(
        lookup.has_name(items, "no such name").withColumn("name", F.lit("no such name"))
    )


def table_profile(spark, sf_dir):
    return profile.profile(part_items(spark, sf_dir))


def head_tail(spark, sf_dir):
    items = part_items(spark, sf_dir).select("ord", "name")
    return profile.head(items).withColumn("part", F.lit("head")).unionByName(
        profile.tail(items).withColumn("part", F.lit("tail"))
    )


def distinct_values(spark, sf_dir):
    return profile.distinct_values(table(spark, sf_dir, "part", "p_brand"), "p_brand")


def display(spark, sf_dir):
    texts = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return texts.select("conv_id", "turn", display_text(marked("text")).alias("cardtext"))


# --- labels and vectors ------------------------------------------------------


def multi_hot_rows(spark, sf_dir):
    return labelsets.feature_rows(labelsets.item_features(order_items(spark, sf_dir)))


def cosine_topn(spark, sf_dir):
    items = labelsets.item_features(order_items(spark, sf_dir))
    return labelsets.nearest(items, 3).select("item_id", F.round("similarity", 9).alias("similarity"))


def cosine_topn_vectors(spark, sf_dir):
    items = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    near = labelsets.nearest(
        items, 0, column="embedding", key="vec_id", measure=labelsets.vector_cosine
    )
    return near.select("vec_id", F.round("similarity", 6).alias("similarity"))


# --- phrases -----------------------------------------------------------------


def phrase_list(spark, sf_dir):
    texts = table(spark, sf_dir, "benchmark", "item_id", "text")
    listed = texts.select("item_id", F.explode(phrases(tokens("text"))).alias("phrase"))
    return listed.groupBy("item_id", "phrase").agg(F.count("*").alias("n"))


def last_paragraph_phrases(spark, sf_dir):
    texts = table(spark, sf_dir, "benchmark", "item_id", "text")
    listed = texts.select("item_id", F.explode(phrases(paragraph_tokens(marked("text")))).alias("phrase"))
    return listed.groupBy("item_id", "phrase").agg(F.count("*").alias("n"))


def phrase_overlap(spark, sf_dir):
    anchors = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("anchor_id"), tokens("text").alias("tokens")
    )
    return overlap.similarity(anchors, related.item_words(document_items(spark, sf_dir)))


def candidates(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.struct("conv_id", "turn").alias("item_id"),
        F.struct("conv_id", "turn").alias("ord"),
        F.col("role").alias("name"),
        marked("text").alias("text"),
    )
    return find_candidates(turns).select("ord.conv_id", "ord.turn", "name", "paragraph", "overlap")


# --- rank clusters -----------------------------------------------------------


def _clustered_parts(spark, sf_dir):
    parts = table(spark, sf_dir, "part", "p_partkey", "p_retailprice").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_partkey").alias("ord"),
        F.col("p_retailprice").alias("rank"),
    )
    return rank_clusters.assign_clusters(parts)


def bucket_edges(spark, sf_dir):
    prices = table(spark, sf_dir, "lineitem", "l_extendedprice")
    edges = rank_clusters.bucket_edges(prices, 6, "l_extendedprice")
    return spark.createDataFrame(
        [(i, low, high) for i, (low, high) in enumerate(edges)], "bucket int, low double, high double"
    )


def rank_kmeans(spark, sf_dir):
    return _clustered_parts(spark, sf_dir).select(
        "item_id", "cluster_pos", F.round("centroid", 6).alias("centroid")
    )


def cluster_sse(spark, sf_dir):
    sse = rank_clusters.cluster_sse(_clustered_parts(spark, sf_dir))
    return sse.select(
        "cluster_pos", "n", F.round("centroid", 6).alias("centroid"),
        F.round("sse", 2).alias("sse"), F.round("sse_minus_mean", 2).alias("sse_minus_mean"),
    )


def cluster_boundary(spark, sf_dir):
    edges = rank_clusters.cluster_boundaries(_clustered_parts(spark, sf_dir))
    return edges.select(
        "cluster_pos", F.round("dist_own", 6).alias("dist_own"), F.round("dist_next", 6).alias("dist_next")
    )


def cluster_counts(spark, sf_dir):
    items = document_items(spark, sf_dir)
    members = related.ranked_members(items, ANCHOR)
    return members.groupBy("cluster_pos").agg(F.count("*").alias("n"))


# --- item sets, rules, recommendations --------------------------------------


def greedy_set(spark, sf_dir):
    picked, _ = deck(spark, sf_dir)
    return rules.pair_rules(picked).select("anchor_id", "deck_pos", "scorer_id", "item_id", "sim", "rank")


def _rounded(triples: DataFrame) -> DataFrame:
    return triples.withColumns(
        {"support": F.round("support", 9), "confidence": F.round("confidence", 9)}
    )


def triple_rules(spark, sf_dir):
    picked, items = deck(spark, sf_dir)
    return _rounded(rules.triple_rules(picked, related.item_words(items)))


def triple_rules_last(spark, sf_dir):
    picked, items = deck(spark, sf_dir)
    return _rounded(rules.triple_rules(picked, related.item_words(items), term="last"))


def triple_rules_mean(spark, sf_dir):
    picked, items = deck(spark, sf_dir)
    return _rounded(rules.triple_rules_mean(picked, related.item_words(items)))


def triple_rules_mean_last(spark, sf_dir):
    picked, items = deck(spark, sf_dir)
    return _rounded(rules.triple_rules_mean(picked, related.item_words(items), term="last"))


def top_rules(spark, sf_dir):
    picked, items = deck(spark, sf_dir)
    return _rounded(rules.top_rules(rules.triple_rules(picked, related.item_words(items)), items))


def _related(spark, sf_dir):
    picked, items = deck(spark, sf_dir)
    current, coming = clean.split_cohorts(items, COHORT)
    return related.related_items(picked, current), items, coming


def related_items(spark, sf_dir):
    found, _, _ = _related(spark, sf_dir)
    return found.select("item_id", "name", "text", "rank", "setCode", "sim_score")


def related_items_many(spark, sf_dir):
    """Related parts of the first part of every brand, in one run."""
    labels = F.concat_ws(", ", "p_type", F.when(F.col("p_size") % 2 == 0, "EVEN"))
    items = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_partkey").alias("ord"),
        F.concat_ws(MARK, "p_name", "p_brand", "p_type").alias("text"),
        label_set(labels).alias("labels"),
        F.col("p_retailprice").alias("rank"),
        F.col("p_brand").alias("setCode"),
    )
    anchors = items.groupBy("setCode").agg(F.min("item_id").alias("anchor_id"))
    current, _ = clean.split_cohorts(items, "Brand#2")
    found = related.related_items(related.anchor_sets(items, anchors), current)
    return found.select("anchor_id", "item_id", "deck_pos", "rank", "setCode", F.round("sim_score", 9).alias("sim_score"))


def related_names(spark, sf_dir):
    return upcoming.names(_related(spark, sf_dir)[0])


def upcoming_recs(spark, sf_dir):
    found, items, coming = _related(spark, sf_dir)
    recs = upcoming.upcoming_recommendations(items, coming, found, ANCHOR)
    return recs.withColumn("edhrecRank_prediction", F.round("edhrecRank_prediction", 3))


def recommendation_lookup(spark, sf_dir):
    """The first recommendation as it is displayed: values and gaps are strings."""
    recs = staging.cut(upcoming_recs(spark, sf_dir))
    first = recs.orderBy(F.col("sim_score").desc(), "card_index").select("name").first()
    return lookup.recommendation_card(recs, first["name"] if first else "")


# --- features and clustering -------------------------------------------------


def standardise(spark, sf_dir):
    parts = table(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    scaled = features.standardise(parts, ["p_size", "p_retailprice"])
    return scaled.select(
        "p_partkey", F.round("p_size", 9).alias("p_size"), F.round("p_retailprice", 9).alias("p_retailprice")
    )


def _featured_orders(spark, sf_dir):
    return labelsets.item_features(order_items(spark, sf_dir)).select("item_id", "ord", "features")


def dbscan(spark, sf_dir):
    """Standardised multi-hot labels of orders."""
    items = _featured_orders(spark, sf_dir)
    points = features.standardised_label_points(items)
    found = run_dbscan(points).join(points.select("pid", "features"), "pid")
    return items.join(found, "features").select("item_id", "cluster")


def dbscan_points(spark, sf_dir):
    """Two numeric columns, standardised."""
    scaled = features.standardise(
        table(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"]
    ).withColumn("vector", F.array("p_size", "p_retailprice"))
    points = features.distinct_points(scaled, order="p_partkey")
    found = run_dbscan(points, eps=0.1).join(points.select("pid", "vector"), "pid")
    return scaled.join(found, "vector").select("p_partkey", "cluster")


def _embedding_points(spark, sf_dir):
    items = table(spark, sf_dir, "embeddings").withColumn("vector", F.col("embedding").cast("array<double>"))
    return items, features.distinct_points(items, order="vec_id")


def kmeans(spark, sf_dir):
    _, points = _embedding_points(spark, sf_dir)
    placed = features.kmeans(points, weight="weight")
    return placed.select(F.col("pid").alias("vec_id"), "cluster")


def kmeans_fixpoint(spark, sf_dir):
    """K-Means run until no mean moves: no point is then nearer to another mean."""
    _, points = _embedding_points(spark, sf_dir)
    return features.misplaced(features.kmeans(points, weight="weight", rounds=500, tolerance=0.0))


def ward(spark, sf_dir):
    """Standardised multi-hot labels of orders."""
    items = _featured_orders(spark, sf_dir)
    points = staging.cut(features.standardised_label_points(items))
    found = run_ward(points).join(points.select("pid", "features"), "pid")
    return items.join(found, "features").select("item_id", "cluster")


def silhouette(spark, sf_dir):
    items, _ = _embedding_points(spark, sf_dir)
    points = items.groupBy("vector", F.col("label").alias("cluster")).agg(
        F.min("vec_id").alias("pid"), F.count("*").alias("weight")
    )
    return score_silhouette(points).select(F.round("silhouette", 7).alias("silhouette"))


def silhouette_squared(spark, sf_dir):
    items, _ = _embedding_points(spark, sf_dir)
    points = items.groupBy("vector", F.col("label").alias("cluster")).agg(
        F.min("vec_id").alias("pid"), F.count("*").alias("weight")
    )
    return score_silhouette(points, metric="squared").select(F.round("silhouette", 7).alias("silhouette"))


def dbscan_sizes(spark, sf_dir):
    """Sizes of the density clusters of orders."""
    return feature_report.cluster_sizes(dbscan(spark, sf_dir), "cluster")


def cluster_scores(spark, sf_dir):
    items = _featured_orders(spark, sf_dir)
    points = features.standardised_label_points(items)
    return feature_report.cluster_scores(feature_report.cluster_points(points))


# --- regression --------------------------------------------------------------


def linreg(spark, sf_dir):
    model = regression.fit(lines(spark, sf_dir), "l_quantity", "l_extendedprice")
    return model.select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


def training_mse(spark, sf_dir):
    error = regression.training_error(lines(spark, sf_dir), "l_quantity", "l_extendedprice")
    return error.select(F.round("mse", 1).alias("mse"), F.round("label_mean", 4).alias("label_mean"))


def kfold_mse(spark, sf_dir):
    error = regression.cross_validate(lines(spark, sf_dir), "l_quantity", "l_extendedprice", "key", 7)
    return error.select(F.round("mean_mse", 1).alias("mean_mse"), F.round("label_mean", 4).alias("label_mean"))


def train_test_split(spark, sf_dir):
    split = regression.split_train_test(lines(spark, sf_dir), "key")
    return split.groupBy("is_test").agg(
        F.count("*").alias("n"), F.sum("l_orderkey").alias("orders"), F.sum("l_quantity").alias("quantity")
    )


def synthetic_score(spark, sf_dir):
    parts = table(spark, sf_dir, "part", "p_partkey", "p_retailprice")
    scored = regression.synthetic_score(parts, "p_retailprice", "p_partkey", seed=7)
    return scored.select("p_partkey", F.round("score", 6).alias("score"))


def random_draws(spark, sf_dir):
    parts = table(spark, sf_dir, "part", "p_partkey", "p_size")
    return parts.select(
        "p_partkey",
        uniform_int(F.lit(0), F.col("p_size"), 3, F.col("p_partkey")).alias("drawn"),
        F.round(gaussian(3, F.col("p_partkey")), 6).alias("normal"),
    )


def _predicted_lines(spark, sf_dir):
    split = regression.split_train_test(lines(spark, sf_dir), "key")
    model = regression.fit(split.where(~F.col("is_test")), "l_quantity", "l_extendedprice")
    return regression.predict(split.where("is_test"), model, "l_quantity")


def prediction_sample(spark, sf_dir):
    shown = regression.prediction_sample(_predicted_lines(spark, sf_dir), "l_extendedprice", "key")
    return shown.withColumn("predicted", F.round("predicted", 4))


def plot_series(spark, sf_dir):
    series = regression.plot_series(
        _predicted_lines(spark, sf_dir), "l_quantity", "l_extendedprice", "prediction"
    )
    return series.withColumn("predicted", F.round("predicted", 4))


# --- sources and sinks -------------------------------------------------------


def csv_roundtrip(spark, sf_dir):
    """Write documents to CSV in the shared folder and read them back."""
    source = table(spark, sf_dir, "documents", "doc_id", "text", "source", "n_chars")
    path = staging.staged_path(spark, "documents-csv")
    tables.write_csv(source, path)
    return tables.read_csv(spark, path, source.schema)


def csv_row_order(spark, sf_dir):
    """Row numbers given at a CSV scan follow the order of the file."""
    source = tables.read_table(spark, f"{sf_dir}/part.parquet", "p_partkey", "p_name")
    path = staging.staged_path(spark, "part-csv")
    tables.write_csv(source, path)
    return tables.with_row_order(tables.read_csv(spark, path, source.schema))


def csv_split_order(spark, sf_dir):
    """Row numbers of order lines over several CSV files that tasks may split."""
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    source = tables.read_table(spark, f"{sf_dir}/lineitem.parquet", *columns)
    path = staging.staged_path(spark, "lineitem-csv")
    tables.write_csv(source.repartitionByRange(*columns).sortWithinPartitions(*columns), path)
    return tables.with_row_order(tables.read_csv(spark, path, source.schema, multi_line=False))


def keyword_dictionary(spark, sf_dir):
    """Nested JSON dictionaries, one per part, to (category, keyword)."""
    categories = ("names", "brands", "types")
    documents = table(spark, sf_dir, "part").select(
        F.struct(F.lit("2024-01-01").alias("date"), F.col("p_partkey").cast("string").alias("version")).alias("meta"),
        F.struct(
            F.split("p_name", " ").alias("names"), F.array("p_brand").alias("brands"), F.array("p_type").alias("types")
        ).alias("data"),
    )
    path = staging.staged_path(spark, "dictionary-json")
    documents.write.json(path)
    return dictionary.read_dictionary(spark, path, categories, one_document_per_file=False)


def keyword_categories(spark, sf_dir):
    return dictionary.category_counts(keyword_dictionary(spark, sf_dir))


REGISTERED: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    label_counts_top, label_counts_all, value_counts, dedup_keep_last, clean_chain, typed_fill,
    drop_unranked, cohort_split, label_subset, name_search, name_search_regex, point_lookup,
    any_cell_search, any_cell_columns, exists, table_profile, head_tail, distinct_values, display,
    multi_hot_rows, cosine_topn, cosine_topn_vectors,
    phrase_list, last_paragraph_phrases, phrase_overlap, candidates,
    bucket_edges, rank_kmeans, cluster_sse, cluster_boundary, cluster_counts,
    greedy_set, triple_rules, triple_rules_last, triple_rules_mean, triple_rules_mean_last, top_rules,
    related_items, related_items_many, related_names, upcoming_recs, recommendation_lookup,
    standardise, dbscan, dbscan_points, dbscan_sizes, kmeans, kmeans_fixpoint, ward,
    silhouette, silhouette_squared, cluster_scores,
    linreg, training_mse, kfold_mse, train_test_split, synthetic_score, random_draws,
    prediction_sample, plot_series,
    csv_roundtrip, csv_row_order, csv_split_order, keyword_dictionary, keyword_categories,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in REGISTERED}

"""Order statistics, rank clusters, regression, features and clustering."""

import random
import struct

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kindred.operators import features, order_stats, pairwise, rank_clusters, regression
from kindred.operators import silhouette as silhouette_module
from kindred.operators import ward as ward_module
from kindred.operators.components import components
from kindred.operators.dbscan import dbscan
from kindred.operators.silhouette import silhouette
from kindred.operators.ward import ward, ward_grouped


def test_values_at_equals_the_sorted_list(spark):
    rng = random.Random(4)
    values = [float(rng.choice([7, 7, 7, rng.randint(0, 500)])) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    at = [0, 1, 500, 1499, 2500, 2999]
    assert order_stats.numeric_values_at(df, "v", at) == [sorted(values)[i] for i in at]
    with pytest.raises(ValueError):
        order_stats.numeric_values_at(df, "v", [3000])
    unique = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    assert order_stats.with_position(unique, "v", "p").where("p <> v").isEmpty()


def test_order_key_keeps_the_order_of_doubles(spark):
    rng = random.Random(6)
    tiny = 5e-324
    values = [0.0, -0.0, tiny, -tiny, 2.0**-1022, -(2.0**-1022), 2.0**-1022 - tiny, 1.0, 1 - 2**-53, 1 + 2**-52, 1.7976931348623157e308, float("inf"), -float("inf")]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)] + [2.0**k for k in range(-1074, 1024)] + [-(2.0**k) * (1 - 2**-53) for k in range(-1000, 1024)]
    values = [v for v in values if v == v]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_stats.order_key(F.col("v")).alias("k")).collect()
    # The format's own bits, sign taken apart, are that order.
    assert all(r.k == (1 if r.v > 0 else -1) * (struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]) for r in rows)
    far = spark.createDataFrame([(float("nan"),), (float("inf"),)], "v double").select(order_stats.order_key(F.col("v")).alias("k")).collect()
    assert far[0].k == far[1].k + 1


def test_numbers_are_found_digit_by_digit(spark, monkeypatch):
    """A million rows whose leading digits agree, in groups, with the bound on rows lowered."""
    monkeypatch.setattr(order_stats, "ROWS_AT_ONCE", 100)
    rows = spark.range(1_000_000).select(
        (F.col("id") % 3).alias("g"), (F.lit(5.0) + F.pmod(F.xxhash64("id"), F.lit(10_007)) / 2.0**40 - F.when(F.col("id") % 97 == 0, 11.0).otherwise(0.0)).alias("x")
    )
    spots = [0, 1, 4_000, 100_000, 333_332]
    got = {(r.g, r.place): r.value for r in order_stats.grouped_values_at(rows, ["g"], "x", lambda n: F.array(*(F.lit(p).cast("long") for p in spots))).collect()}
    for g in range(3):
        own = sorted(r.x for r in rows.where(F.col("g") == g).select("x").collect())
        assert [got[g, i] for i in range(len(spots))] == [own[p] for p in spots]
    assert order_stats.numeric_values_at(rows, "x", [0, 999_999]) == [rows.agg(F.min("x")).first()[0], rows.agg(F.max("x")).first()[0]]


def test_digests_are_found_through_finer_buckets(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "ROWS_AT_ONCE", 3)
    rng = random.Random(6)
    digests = [f"{rng.choice(['abc', 'abd'])}{rng.choice(['000', '001'])}{rng.getrandbits(104):026x}" for _ in range(300)] * 2
    df = spark.createDataFrame([(d,) for d in digests], "d string")
    at = [0, 1, 150, 299, 300, 599]
    assert order_stats.digest_values_at(df, "d", at) == [sorted(digests)[i] for i in at]


def test_rank_clusters_worked_example(spark):
    ranks = [1.0, 2.0, 3.0, 10.0, 11.0, 12.0]
    items = spark.createDataFrame([(i, i, r) for i, r in enumerate(ranks)], "item_id long, ord long, rank double")
    assert rank_clusters.bucket_edges(items, 2) == [(1, 3), (10, 12)]
    assert rank_clusters.pick_seeds(items, 2) == [2, 11]
    clustered = rank_clusters.assign_clusters(items, 2)
    sse = {r.cluster_pos: (r.centroid, r.n, r.sse, r.sse_minus_mean) for r in rank_clusters.cluster_sse(clustered).collect()}
    assert sse == {0: (2, 3, 2, 0), 1: (11, 3, 2, 0)}
    edge = rank_clusters.cluster_boundaries(clustered).collect()
    assert [tuple(r) for r in edge] == [(0, 1.0, 8.0)]
    assert rank_clusters.pick_seeds(items, 2, seeding="random", seed=5) == rank_clusters.pick_seeds(items.repartition(3), 2, seeding="random", seed=5)


def test_rank_clusters_ties_and_flat_buckets(spark):
    items = spark.createDataFrame([(i, i, r) for i, r in enumerate([1.0, 3.0, 5.0, 9.0, 9.0, 9.0])], "item_id long, ord long, rank double")
    assert rank_clusters.pick_seeds(items, 2)[1] == 9  # all ranks of the bucket are equal
    placed = rank_clusters.assign_clusters(items, seeding=[1, 5, 5])
    got = {r["item_id"]: r.cluster_pos for r in placed.collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1, 4: 1, 5: 1}  # the earlier seed wins, the empty one drops out


def test_regression(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (4.0, 9.0)], "x double, y double")
    model = regression.fit(df, "x", "y")
    assert tuple(model.first()) == pytest.approx((2, 1))
    assert {r.prediction for r in regression.predict(df, model, "x").collect()} == {3.0, 5.0, 9.0}
    assert tuple(regression.training_error(df, "x", "y").first()) == pytest.approx((0, 17 / 3), abs=1e-9)
    flat = regression.fit(df.withColumn("x", F.lit(1.0)), "x", "y").first()
    assert flat.slope is None and flat.intercept is None


@pytest.mark.parametrize("n,k", [(62, 5), (7, 3), (60, 6)])
def test_cross_validation_equals_the_loop(spark, n, k):
    import hashlib

    rng = np.random.default_rng(n)
    x, y = rng.normal(size=n) + 1000, rng.normal(size=n) * 5
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, x double, y double")
    order = sorted(range(n), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    size, errors = n // k, []
    for f in range(k):
        held = order[f * size:(f + 1) * size]
        rest = [i for i in order if i not in set(held)]
        b, a = np.polyfit(x[rest] - 1000, y[rest], 1)
        errors.append(np.mean((a + b * (x[held] - 1000) - y[held]) ** 2))
    got = regression.cross_validate(df, "x", "y", "id", k).first()
    assert got.mean_mse == pytest.approx(np.mean(errors)) and got.label_mean == pytest.approx(y.mean())
    sizes = {r.fold: r["count"] for r in regression.assign_folds(df, "id", k).groupBy("fold").count().collect()}
    assert all(sizes[f] == size for f in range(k)) and sizes.get(k, 0) == n - k * size


def test_train_test_split_is_exact_and_stable(spark):
    df = spark.range(203)
    first = regression.split_train_test(df, "id")
    assert first.where("is_test").count() == 51
    assert first.exceptAll(regression.split_train_test(df.repartition(5), "id")).isEmpty()


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, c double")
    rows = features.standardise(df, ["x", "c"]).collect()
    x = np.array([1.0, 2.0, 4.0])
    assert [r.x for r in rows] == pytest.approx(list((x - x.mean()) / x.std())) and {r.c for r in rows} == {0.0}


def point_frame(spark, vectors, weights=None):
    weights = weights or [1] * len(vectors)
    return spark.createDataFrame(
        [(i, [float(c) for c in v], w) for i, (v, w) in enumerate(zip(vectors, weights))],
        "pid long, vector array<double>, weight long",
    )


def test_components(spark):
    nodes = spark.createDataFrame([(i,) for i in range(40)], "pid long")
    chain = [(i, i + 1) for i in range(19)] + [(30, i) for i in range(20, 30)]
    edges = spark.createDataFrame(chain, "a long, b long")
    got = {r.pid: r.component for r in components(nodes, edges).collect()}
    want = {i: 0 for i in range(20)} | {i: 20 for i in range(20, 31)} | {i: i for i in range(31, 40)}
    assert got == want


def brute_dbscan(v, eps, least):
    near = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1)) <= eps
    core, labels, nxt = near.sum(1) >= least, [-1] * len(v), 0
    for i in range(len(v)):
        if not core[i] or labels[i] != -1:
            continue
        labels[i], queue = nxt, [i]
        while queue:
            j = queue.pop(0)
            for m in np.flatnonzero(near[j]):
                if labels[m] == -1:
                    labels[m] = nxt
                    if core[m]:
                        queue.append(m)
        nxt += 1
    return labels


def test_dbscan_equals_expansion_in_row_order(spark):
    v = np.random.default_rng(3).uniform(0, 4, size=(70, 2))
    got = {r.pid: r.cluster for r in dbscan(point_frame(spark, v), eps=0.5, min_samples=4).collect()}
    assert [got[i] for i in range(70)] == brute_dbscan(v, 0.5, 4)


@pytest.mark.parametrize("width,eps", [(1, 0.02), (2, 0.25), (3, 0.6)])
def test_dbscan_with_dense_cells_and_weights(spark, width, eps):
    rng = np.random.default_rng(width)
    v = np.concatenate([rng.uniform(0, 3, size=(60, width)), rng.normal(1, 0.1, size=(60, width))])
    weights = [int(w) for w in rng.integers(1, 3, size=len(v))]
    rows = np.repeat(np.arange(len(v)), weights)
    want = dict(zip(rows.tolist(), brute_dbscan(v[rows], eps, 5)))
    got = {r.pid: r.cluster for r in dbscan(point_frame(spark, v, weights), eps=eps, min_samples=5).collect()}
    assert got == want


def test_dbscan_does_not_compare_points_of_a_dense_cell(spark):
    at = F.array(0.001 + F.col("id") * 1e-9, 0.001 + (F.col("id") * 7919 % 50_000) * 1e-9)
    points = spark.range(50_000).select(F.col("id").alias("pid"), at.alias("vector"), F.lit(1).alias("weight"))
    assert [tuple(r) for r in dbscan(points).groupBy("cluster").count().collect()] == [(0, 50_000)]


def test_dbscan_on_labels_groups_equal_rows(spark):
    rows = [(i, ["a"]) for i in range(5)] + [(i, ["b"]) for i in range(5, 9)]
    items = spark.createDataFrame(rows, "ord long, features array<string>")
    points = features.standardised_label_points(items)
    assert {(r.pid, r.cluster) for r in dbscan(points).collect()} == {(0, 0), (5, -1)}


def brute_ward(v, k):
    groups = {i: [i] for i in range(len(v))}
    while len(groups) > k:
        def cost(a, b):
            x, y = v[groups[a]], v[groups[b]]
            return len(x) * len(y) / (len(x) + len(y)) * ((x.mean(0) - y.mean(0)) ** 2).sum()

        a, b = min(((a, b) for a in groups for b in groups if a < b), key=lambda p: cost(*p))
        groups[a] += groups.pop(b)
    return {i: min(g) for g in groups.values() for i in g}


@pytest.mark.parametrize("block", [1024, 6])
def test_ward_equals_naive_merging(spark, monkeypatch, block):
    monkeypatch.setattr(pairwise, "BLOCK_ROWS", block)
    v = np.random.default_rng(8).normal(size=(14, 2))
    got = {r.pid: r.cluster for r in ward(point_frame(spark, v), 3).collect()}
    assert got == brute_ward(v, 3)


@pytest.mark.parametrize("block", [1024, 7])
def test_ward_keeps_nearest_neighbours(spark, monkeypatch, block):
    """Heights of the whole tree equal those of plain merging; later rounds ask for some of the groups only."""
    asked = []

    def counted(left, n_left, right, n_right, *rest):
        asked.append((n_left, n_right))
        return between_blocks(left, n_left, right, n_right, *rest)

    between_blocks = ward_module.between_blocks
    monkeypatch.setattr(pairwise, "BLOCK_ROWS", block)
    monkeypatch.setattr(ward_module, "between_blocks", counted)
    v = np.random.default_rng(4).normal(size=(24, 3))
    got = sorted(r.height for r in ward_module.merges(point_frame(spark, v), len(v)).collect())
    groups, want = {i: [i] for i in range(len(v))}, []
    while len(groups) > 1:
        cost = {
            (a, b): np.sqrt(2 * len(x) * len(y) / (len(x) + len(y))) * np.linalg.norm(v[x].mean(0) - v[y].mean(0))
            for a, x in groups.items() for b, y in groups.items() if a < b
        }
        a, b = min(cost, key=cost.get)
        want.append(cost[a, b])
        groups[a] += groups.pop(b)
    assert np.allclose(got, sorted(want), atol=1e-8)
    assert asked and sum(a for a, _ in asked) < sum(n for _, n in asked)


def test_ward_grouped_keeps_far_groups_apart(spark):
    v = np.random.default_rng(3).normal(size=(60, 2)) * 0.05 + np.repeat([[0, 0], [9, 9], [0, 9]], 20, axis=0)
    got = {r.pid: r.cluster for r in ward_grouped(point_frame(spark, v), 3, groups=12).collect()}
    assert {frozenset(i for i in got if got[i] == c) for c in set(got.values())} == {frozenset(range(a, a + 20)) for a in (0, 20, 40)}


@pytest.mark.parametrize("block", [1024, 2])
def test_silhouette_counts_copies(spark, monkeypatch, block):
    monkeypatch.setattr(pairwise, "BLOCK_ROWS", block)
    v = np.random.default_rng(5).normal(size=(9, 3))
    weights, labels = [1, 3, 1, 2, 1, 1, 1, 2, 1], [0, 0, 0, 1, 1, 1, -1, -1, 2]
    rows = np.repeat(np.arange(9), weights)
    d = np.sqrt(((v[rows][:, None] - v[rows][None]) ** 2).sum(-1))
    own = np.array(labels)[rows]
    scores = []
    for i in range(len(rows)):
        mates = own == own[i]
        if mates.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][mates].sum() / (mates.sum() - 1)
        b = min(d[i][own == c].mean() for c in set(own) - {own[i]})
        scores.append((b - a) / max(a, b))
    points = point_frame(spark, v, weights)
    named = spark.createDataFrame(list(enumerate(labels)), "pid long, cluster long")
    assert silhouette(points.join(named, "pid")).first().silhouette == pytest.approx(np.mean(scores))


def test_kmeans_separates_groups(spark):
    v = np.concatenate([np.random.default_rng(c).normal(c * 10, 0.1, size=(6, 2)) for c in range(3)])
    placed = features.kmeans(point_frame(spark, v), 3, starts=3).collect()
    groups = {c: {r.pid // 6 for r in placed if r.cluster == c} for c in {r.cluster for r in placed}}
    assert sorted(map(list, groups.values())) == [[0], [1], [2]]


def test_starts_share_their_rounds(spark):
    """Run to the end, several starts find what Spark's best start finds, with one job a round for all of them."""
    v = np.random.default_rng(2).normal(size=(600, 6))
    points = point_frame(spark, v, [1 + i % 3 for i in range(len(v))])
    data = points.withColumn("_v", array_to_vector("vector")).persist()
    sc, known = spark.sparkContext, {}

    def jobs(group, run):
        sc.setJobGroup(group, group)
        known[group] = run()
        sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(group))

    def fits(rounds):
        return [KMeans(k=3, seed=42 + s, featuresCol="_v", maxIter=rounds, tol=0.0).setWeightCol("weight").fit(data) for s in range(5)]

    jobs("whole", lambda: fits(500))
    begun = jobs("begun", lambda: fits(0))
    made = jobs("made", lambda: features.kmeans(points, 3, weight="weight", starts=5, rounds=500, tolerance=0.0))
    data.unpersist()
    rounds = [m.summary.numIter for m in known["whole"]]
    assert made - begun <= max(rounds) + 5 < sum(rounds)
    best = min(known["whole"], key=lambda m: m.summary.trainingCost)

    def groups(placed, column):
        rows = placed.select("pid", column).collect()
        return {frozenset(r.pid for r in rows if r[column] == c) for c in {r[column] for r in rows}}

    assert groups(known["made"], "cluster") == groups(best.transform(data), "prediction")


def test_misplaced_points_are_counted(spark):
    rows = [(i, [float(x)], 1, c) for i, (x, c) in enumerate([(0, 0), (1, 0), (9, 0), (10, 1), (11, 1)])]
    placed = spark.createDataFrame(rows, "pid long, vector array<double>, weight long, cluster int")
    assert tuple(features.misplaced(placed).first()) == (5, 2, 1)  # 9 lies nearer to 10.5 than to 10/3
    fitted = features.kmeans(placed.drop("cluster"), 2, weight="weight", rounds=100, tolerance=0.0)
    assert tuple(features.misplaced(fitted).first()) == (5, 2, 0)


@pytest.mark.parametrize("size, columns", [(32 << 20, 1024), (96, 3), (400, 2), (24, 1)])
def test_silhouette_of_runs_equals_the_plain_one(spark, monkeypatch, size, columns):
    """Runs that cut clusters, hold one, or many; each point is sent to a bounded number of tasks."""
    monkeypatch.setattr(silhouette_module, "RUN_BYTES", size)
    monkeypatch.setattr(silhouette_module, "TILE_COLUMNS", columns)
    monkeypatch.setattr(pairwise, "by_blocks", None)  # blocks that meet in pairs copy every point once a block
    rng = np.random.default_rng(11)
    v, weights = rng.normal(size=(25, 3)), rng.integers(1, 4, 25).tolist()
    labels = [-1, 0, 0, 1, 1, 1, 2, 3, 3, *[4] * 9, 5, *[7] * 6]
    rows = np.repeat(np.arange(25), weights)
    d, own, scores = np.sqrt(((v[rows][:, None] - v[rows][None]) ** 2).sum(-1)), np.array(labels)[rows], []
    for i in range(len(rows)):
        mates = own == own[i]
        a = d[i][mates].sum() / max(mates.sum() - 1, 1)
        b = min(d[i][own == c].mean() for c in set(own) - {own[i]})
        scores.append((b - a) / max(a, b) if mates.sum() > 1 else 0.0)
    named = spark.createDataFrame(list(enumerate(labels)), "pid long, cluster long")
    points = point_frame(spark, v, weights).join(named, "pid")
    assert silhouette(points).first().silhouette == pytest.approx(np.mean(scores), abs=1e-9)


def test_silhouette_of_one_cluster_and_of_nothing(spark):
    points = point_frame(spark, np.eye(3)).withColumn("cluster", F.lit(4))
    assert silhouette(points).first().silhouette == 0.0
    assert silhouette(points.where("pid < 0")).first().silhouette is None

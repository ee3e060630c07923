"""One-variable least squares and its evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.noise import gaussian, shuffle_key
from kindred.operators.order_stats import digest_values_at


def fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row ``(slope, intercept)``; null where x does not vary."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def predict(df: DataFrame, model: DataFrame, x: str, output: str = "prediction") -> DataFrame:
    """Add the prediction of a one-row model. Works on streams as well."""
    line = model.limit(1).select(F.struct("slope", "intercept")).scalar()
    with_line = df.withColumn("_line", line)
    value = F.col("_line.intercept") + F.col("_line.slope") * F.col(x)
    return with_line.withColumn(output, value).drop("_line")


def training_error(df: DataFrame, x: str, y: str) -> DataFrame:
    """``(mse, label_mean)`` of the line on the rows it was fitted to."""
    fitted = predict(df.select(x, y), fit(df, x, y), x, "_p")
    return fitted.agg(
        F.avg(F.pow(F.col("_p") - F.col(y), 2)).alias("mse"), F.avg(y).alias("label_mean")
    )


def assign_folds(df: DataFrame, key: str | Column, k: int, *, seed: int = 42, exact: bool = True) -> DataFrame:
    """Add ``fold``; rows beyond k equal folds get fold k and are only trained on.

    The shuffle order is the order of a seeded digest of the key.  Fold edges are
    k order statistics of that digest, so the rows themselves are not sorted.
    ``exact=False`` hashes rows to folds of about equal size in no pass at all.
    """
    digest = shuffle_key(seed, F.col(key) if isinstance(key, str) else key)
    if not exact:
        return df.withColumn("fold", F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(k)))

    def edges_of(n: int) -> list[int]:
        size = n // k
        if size == 0:
            raise ValueError(f"{n} rows cannot fill {k} folds")
        return [i * size for i in range(1, k + 1) if i * size < n]

    keyed = df.withColumn("_digest", digest)
    edges = digest_values_at(keyed, "_digest", edges_of)
    fold = sum([(F.col("_digest") >= e).cast("long") for e in edges], F.lit(0).cast("long"))
    return keyed.withColumn("fold", fold).drop("_digest")


def cross_validate(
    df: DataFrame, x: str, y: str, key: str | Column, k: int, *, seed: int = 42, exact: bool = True
) -> DataFrame:
    """``(mean_mse, label_mean)`` over k folds.

    After the fold edges, one pass for the means and one for sums per fold around
    them, which keeps the sums small.  The training sums of a fold are the totals
    minus its own.
    """
    folded = assign_folds(df, key, k, seed=seed, exact=exact)
    means = df.select(F.struct(F.avg(x).alias("x"), F.avg(y).alias("y"))).scalar()
    u, v = F.col("_u"), F.col("_v")
    names = ("n", "su", "sv", "suu", "suv", "svv")
    sums = (
        folded.withColumn("_m", means)
        .select("fold", (F.col(x) - F.col("_m.x")).alias("_u"), (F.col(y) - F.col("_m.y")).alias("_v"))
        .groupBy("fold")
        .agg(
            F.count("*").alias("n"),
            F.sum(u).alias("su"),
            F.sum(v).alias("sv"),
            F.sum(u * u).alias("suu"),
            F.sum(u * v).alias("suv"),
            F.sum(v * v).alias("svv"),
        )
    )
    all_folds = Window.partitionBy()  # k + 1 rows
    totals = sums.withColumns({f"t_{c}": F.sum(c).over(all_folds) for c in names})
    rest = {c: F.col(f"t_{c}") - F.col(c) for c in names}
    both = totals.where(F.col("fold") < k)
    fitted = both.withColumn(
        "slope",
        F.try_divide(
            rest["n"] * rest["suv"] - rest["su"] * rest["sv"],
            rest["n"] * rest["suu"] - rest["su"] * rest["su"],
        ),
    ).withColumn("intercept", (rest["sv"] - F.col("slope") * rest["su"]) / rest["n"])
    a, b = F.col("intercept"), F.col("slope")
    squared = (
        F.col("svv")
        - 2 * a * F.col("sv")
        - 2 * b * F.col("suv")
        + a * a * F.col("n")
        + 2 * a * b * F.col("su")
        + b * b * F.col("suu")
    )
    return fitted.agg(F.avg(squared / F.col("n")).alias("mean_mse")).withColumn("label_mean", means["y"])


def split_train_test(
    df: DataFrame, key: str | Column, *, test_share: float = 0.25, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: the last rows of a seeded shuffle, an exact count of them."""
    keyed = df.withColumn("_digest", shuffle_key(seed, F.col(key) if isinstance(key, str) else key))

    def first_test(n: int) -> list[int]:
        n_test = -int(-n * test_share // 1)
        return [n - n_test] if 0 < n_test <= n else []

    edge = digest_values_at(keyed, "_digest", first_test)
    is_test = F.col("_digest") >= edge[0] if edge else F.lit(False)
    return keyed.withColumn("is_test", is_test).drop("_digest")


def synthetic_score(df: DataFrame, rank: str, key: str | Column, *, seed: int = 0, output: str = "score") -> DataFrame:
    """Trial data: three quarters of the rank plus noise of deviation 10."""
    k = F.col(key) if isinstance(key, str) else key
    return df.withColumn(output, 0.75 * F.col(rank) + 10 * gaussian(seed, k))


def prediction_sample(predicted: DataFrame, actual: str, order: str, n: int = 5) -> DataFrame:
    """A few predictions beside the actual values."""
    return predicted.orderBy(order).limit(n).select(order, F.col("prediction").alias("predicted"), F.col(actual).alias("actual"))


def plot_series(df: DataFrame, score: str = "sim_score", rank: str = "edhrecRank", prediction: str | None = None) -> DataFrame:
    """The series of a chart: score, actual rank and, if there is one, the prediction."""
    wanted = [F.col(score).alias("sim_score"), F.col(rank).alias("actual")]
    if prediction:
        wanted.append(F.col(prediction).alias("predicted"))
    return df.select(*wanted)

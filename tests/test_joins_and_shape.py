import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import joins as J
from panelwright.operators import missing as M
from panelwright.operators import reshape as R
from panelwright.operators import shape as SH
from panelwright.operators.ranking import cumulate_down, take_share, with_rank, digest
from panelwright.plans.dataset import Dataset, Table


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_assign_into_two_halves_is_the_whole(spark, panel):
    full = spark.range(20).select(F.col("id").alias("t"), F.lit(1).cast("long").alias("g"), (F.col("id") * 2.0).alias("a"))
    empty = full.select("t", "g")
    first, second = full.filter("t < 10"), full.filter("t >= 10")
    whole = J.assign_into(J.assign_into(empty, first, panel), second, panel)
    assert rows(whole, "t", "a") == rows(full, "t", "a")
    part = J.assign_into(J.assign_into(empty, full.filter("t < 4"), panel), second, panel)
    assert rows(part, "t", "a") != rows(full, "t", "a")
    at_once = J.assign_all_into(empty, [first, second], panel)
    assert rows(at_once, "t", "a") == rows(full, "t", "a")


def test_assign_keeps_values_where_the_source_is_missing(spark, panel):
    to = spark.createDataFrame([(1, 1, 5.0), (2, 1, 6.0)], "t long, g long, a double")
    source = spark.createDataFrame([(1, 1, None), (2, 1, 9.0), (3, 1, 1.0)], "t long, g long, a double")
    assert rows(J.assign_into(to, source, panel), "t", "a") == [(1, 5.0), (2, 9.0)]
    with pytest.raises(ValueError):
        J.assign_into(to, source, panel, check=True)


def test_later_sources_win_where_they_have_a_value(spark, panel):
    to = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "t long, g long")
    a = spark.createDataFrame([(1, 1, 1.0), (2, 1, 1.0)], "t long, g long, a double")
    b = spark.createDataFrame([(1, 1, None, 7.0), (2, 1, 2.0, None)], "t long, g long, a double, b double")
    out = J.assign_all_into(to, [a, b], panel)
    assert rows(out, "t", "a", "b") == [(1, 1.0, 7.0), (2, 2.0, None), (3, None, None)]


def test_row_guard(spark):
    skeleton = spark.createDataFrame([(1, 1), (2, 1)], "t long, g long")
    good = spark.createDataFrame([(1, "a")], "g long, v string")
    bad = spark.createDataFrame([(1, "a"), (1, "b")], "g long, v string")
    assert J.left_join_keeping_rows(skeleton, good, ["g"], check=True).count() == 2
    with pytest.raises(ValueError):
        J.left_join_keeping_rows(skeleton, bad, ["g"], check=True)
    with pytest.raises(ValueError):
        J.left_join_keeping_rows(skeleton, good, ["other"])


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_the_plain_one(spark, how):
    # A third of the rows are one key, and all of them are equal rows.
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).cast("long").alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"),
    )
    right = spark.range(90).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    assert rows(J.salted_join(left, right, ["k"], how), "k", "v", "w") == rows(
        left.join(right, ["k"], how), "k", "v", "w"
    )


def largest_share(df, exchange="_salt"):
    """Rows of the largest partition over the mean, as the rows lie."""
    sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) * 8 / sum(sizes)


def test_salts_by_fair_shares(spark):
    """Eight partitions: one key with half of the rows and one just above a fair share."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 7 == 1, 1).otherwise(F.col("id"))
        left = spark.range(40_000).select(key.alias("k"), "id")
        right = left.select("k").distinct().withColumn("w", F.col("k") * 2)
        joined = J.salted_join(left, right, ["k"])
        assert joined.count() == 40_000 and joined.filter("w <> 2 * k").count() == 0
        assert largest_share(joined) < 3
        missing = left.withColumn("k", F.when(F.col("id") % 3 > 0, F.col("k")))
        kept = J.salted_join(missing, right, ["k"], "left")
        assert kept.count() == 40_000 and largest_share(kept) < 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranges_of_a_group_with_most_scores(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 3 + 1).otherwise(0).alias("k"),
        (F.lit(0.5) + F.col("id") * 1e-9).alias("x"),
        F.lit(1.0).alias("n"),
    )
    from panelwright.lineage import _made

    out = cumulate_down(rows, ["k"], "x", ["n"])
    sizes = [r[1] for r in spark.read.parquet(_made[-1]).groupBy("_bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
    assert out.groupBy("k").agg(F.max("cum_n").alias("a"), F.count("*").alias("b")).filter("a <> b").count() == 0


def test_balance_last_t(spark, panel):
    df = spark.createDataFrame(
        [(1, 1, 1.0), (3, 1, 3.0), (1, 2, 5.0), (3, 3, 7.0)], "t long, g long, v double"
    )
    out = SH.balance_last_t(df, panel)
    assert rows(out, "t", "g", "v") == [(1, 1, 1.0), (1, 3, None), (3, 1, 3.0), (3, 3, 7.0)]


def test_interpolation(series, read, panel):
    df = series(g1=[None, 1.0, None, None, 4.0, None], g2=[None] * 6)
    out = M.extrapolate(df, panel)
    assert read(out, "s") == {1: [1.0, 1.0, 2.0, 3.0, 4.0, 4.0], 2: [None] * 6}


def test_interpolation_is_by_position(spark, panel):
    df = spark.createDataFrame([(1, 1, 0.0), (5, 1, None), (6, 1, 2.0)], "t long, g long, s double")
    assert rows(M.extrapolate(df, panel), "t", "s") == [(1, 0.0), (5, 1.0), (6, 2.0)]


def test_group_and_time_means(series, read, panel):
    df = series(g1=[1.0, 3.0], g2=[3.0, None], g3=[None, None])
    assert read(M.fill_groups_with_time_means(df, panel), "s") == {1: [1.0, 3.0], 2: [3.0, None], 3: [2.0, 3.0]}
    out = read(M.fill_with_group_and_global_means(df, panel), "s")
    assert out == {1: [1.0, 3.0], 2: [3.0, 3.0], 3: [2.5, 2.5]}


def test_chained_imputation_invariants(spark, panel):
    base = spark.range(300).select(
        (F.col("id") % 30).alias("t"), F.floor(F.col("id") / 30).alias("g"), (F.col("id") % 17).cast("double").alias("a")
    )
    full = base.select("*", (F.col("a") * 2 + 1).alias("b"), F.lit("x").alias("name"))
    holed = full.withColumn("b", F.when(F.col("t") % 5 != 0, F.col("b")))
    out = M.impute_chained(holed, panel, max_iter=3)
    assert out.filter("b is null").count() == 0
    joined = out.join(full.select("t", "g", F.col("b").alias("truth")), ["t", "g"])
    assert joined.filter("abs(b - truth) > 1e-3").count() == 0
    assert out.columns == holed.columns
    tree = M.impute_chained(holed, panel, max_iter=1, estimator="tree")
    lo, hi = holed.agg(F.min("b"), F.max("b")).first()
    assert tree.filter((F.col("b") < lo) | (F.col("b") > hi)).count() == 0


def test_gram_of_many_columns(spark):
    rng = np.random.default_rng(8)
    values = rng.normal(size=(200, 40))
    df = spark.createDataFrame(values.tolist(), [f"c{i}" for i in range(40)])
    assert np.allclose(M._gram(df.repartition(5)), values.T @ values)
    few = df.select(df.columns[: M.FEW_COLUMNS])
    assert np.allclose(M._gram(few), values.T[: M.FEW_COLUMNS] @ values[:, : M.FEW_COLUMNS])


def test_resample_sizes(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    down = M.resample(df, ["id"], ["y"], 0.5, 0.333)
    assert (down.filter("y = 1").count(), down.filter("y = 0").count()) == (50, 299)
    assert down.select("id").distinct().count() == down.count()
    up = M.resample(df, ["id"], ["y"], 2.5, 1.0)
    assert (up.filter("y = 1").count(), up.filter("y = 0").count()) == (250, 900)
    assert up.filter("y = 1").select("id").distinct().count() <= 100
    assert rows(M.resample(df, ["id"], ["y"], 0.5, 0.333), "id") == rows(down, "id")
    assert M.resample(df, ["id"], ["y"]) is df


def test_a_row_on_the_threshold_in_any_column_is_negative(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 1.0, 1.0), (3, None, 2.0)], "id long, a double, b double")
    kept = M.resample(df, ["id"], ["a", "b"], 1.0, 0.0)
    assert rows(kept, "id") == [(2,), (3,)]


def test_rank_is_a_numbering_per_group(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3 == 0).alias("k"))
    ranked = with_rank(df, digest("id", 7), ["id"], by=["k"])
    got = ranked.groupBy("k").agg(F.min("_rank"), F.max("_rank"), F.count_distinct("_rank"), F.count("*"))
    for _k, low, high, distinct, n in got.collect():
        assert (low, high, distinct) == (1, n, n)
    assert take_share(df, F.lit(0.1), ["id"], 7).count() == 500


def test_running_sums_across_buckets(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("k"), (F.col("id") * 1.0).alias("x"), F.lit(1.0).alias("n"))
    out = cumulate_down(df, ["k"], "x", ["n"]).collect()
    for r in out:
        assert r.cum_n == (1500 - r.x // 2)


def test_first_per_key_and_one_hot(spark):
    df = spark.createDataFrame(
        [(1, 3, "b", "A / B"), (1, 2, "c", None), (2, 9, "d", "A-B")], "k long, o long, v string, c string"
    )
    assert rows(R.first_per_key(df, ["k"], ["o"]), "k", "o", "v") == [(1, 2, "c"), (2, 9, "d")]
    hot = R.one_hot(df, "c", "p", ["a_b"], tidy=True)
    assert rows(hot, "v", "p_a_b") == [("b", 1), ("c", 0), ("d", 1)]


def test_cut_columns_and_missing_columns(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "t long, a double, b double")
    assert R.totally_missing_columns(df) == ["a"]
    assert R.drop_totally_missing(df, ["t"]).columns == ["t", "b"]


def test_dataset(spark, panel):
    skeleton = spark.createDataFrame([(1, 1), (2, 1), (1, 2)], "t long, g long")
    yearly = spark.createDataFrame([(1, 4.0)], "g long, size double")
    monthly = spark.createDataFrame([(1, 1, 2.0)], "t long, g long, v double")
    data = Dataset(
        "d", panel, skeleton,
        [Table("a.yearly", ("g",), yearly), Table("a.monthly", ("t", "g"), monthly)],
        transforms={"both": {"f": "sum", "cols": ["size", "v"]}},
    )
    assert data.tables[0].name == "a_yearly"
    assert data.df().columns == ["t", "g", "both", "size", "v"]
    assert rows(data.df(), "t", "g", "both") == [(1, 1, 6.0), (1, 2, 0.0), (2, 1, 4.0)]
    subset = Dataset("d", panel, skeleton, data.tables, cols=["v"])
    assert subset.df().columns == ["t", "g", "v"]

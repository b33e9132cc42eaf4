import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.operators.ranking import global_order, ordered_plan, partitioned_row_number


def _frame(spark, n=3000):
    # value v: one hot value (0.0) for a third of rows, many ties elsewhere, some nulls
    return spark.range(n).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(0.0))
         .when(F.col("id") % 97 == 5, F.lit(None).cast("double"))
         .otherwise((F.col("id") * 7919 % 50).cast("double")).alias("v"),
        (F.col("id") % 7).alias("grp"),
    )


@pytest.fixture(params=["1", "8", "100", "3000"])
def ranges(spark, request):
    """So many ranges, not merged; 3000 over the same number of rows leave ranges empty."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "200" if request.param == "3000" else request.param)
    yield int(request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_global_order_matches_builtin(spark, ranges):
    df = _frame(spark, 150 if ranges == 3000 else 3000)
    for desc in (True, False):
        keys = [("v", desc), ("key", False)]
        ours = global_order(df, keys, rank_prefixes=(1,), ntiles=(4, 7))
        o = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_last()
        w = Window.orderBy(o, F.col("key"))
        wr = Window.orderBy(o)
        ref = df.select("key", F.row_number().over(w).alias("rn"), F.rank().over(wr).alias("rk"),
                        F.dense_rank().over(wr).alias("dr"), F.ntile(4).over(w).alias("t4"),
                        F.ntile(7).over(w).alias("t7"))
        got = ours.select("key", F.col("_g_rn").alias("rn"), F.col("_g_rank1").alias("rk"),
                          F.col("_g_dense1").alias("dr"), F.col("_g_ntile4").alias("t4"),
                          F.col("_g_ntile7").alias("t7"))
        assert got.exceptAll(ref.select(*got.columns)).count() == 0
        assert ref.select(*got.columns).exceptAll(got).count() == 0


def test_global_order_of_no_rows(spark):
    empty = _frame(spark, 50).filter(F.lit(False))
    assert global_order(empty, [("v", True), ("key", False)], rank_prefixes=(1,)).count() == 0
    assert partitioned_row_number(empty, ["grp"], ["key"]).count() == 0


def test_partitioned_row_number(spark, ranges):
    df = _frame(spark, 2000).withColumn("grp", F.when(F.col("grp") == 0, None).otherwise(F.col("grp") % 2))
    ours = partitioned_row_number(df, ["grp"], [("v", True), ("key", False)])
    w = Window.partitionBy("grp").orderBy(F.col("v").desc_nulls_last(), F.col("key"))
    ref = df.withColumn("_p_rn", F.row_number().over(w))
    assert ours.count() == 2000
    assert ours.select("key", "_p_rn").exceptAll(ref.select("key", "_p_rn")).count() == 0


def test_the_written_plan_has_one_shuffle_and_no_single_partition(spark):
    df = _frame(spark, 500)
    plan = ordered_plan(df, [("v", True), ("key", False)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange") == 1
    out = global_order(df, [("v", True), ("key", False)], rank_prefixes=(1,))
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan + final and "Window" not in plan + final


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    from tallyspark.operators.profile import exact_quantiles
    df = _frame(spark, 1001)
    vals = np.array([r[0] for r in df.select("v").collect() if r[0] is not None])
    got = exact_quantiles(df, "v", (0.1, 0.25, 0.5, 0.75, 0.9)).collect()[0]
    for q in (0.1, 0.25, 0.5, 0.75, 0.9):
        assert abs(got[f"q{round(q * 100)}"] - float(np.quantile(vals, q))) < 1e-9


def test_top_k_ranked_keeps_ties(spark):
    from tallyspark.plans.sales import top_k_ranked
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 9, 8, 7, 7, 7, 5, 1])], "id int, v int")
    got = sorted((r["id"], r["rnk"]) for r in top_k_ranked(df, "v", 3).collect())
    assert got == [(0, 1), (1, 1), (2, 3)]
    got = sorted((r["id"], r["rnk"]) for r in top_k_ranked(df, "v", 4).collect())
    assert got == [(0, 1), (1, 1), (2, 3), (3, 4), (4, 4), (5, 4)]
    dense = sorted((r["id"], r["rnk"]) for r in top_k_ranked(df, "v", 3, dense=True).collect())
    assert dense == [(0, 1), (1, 1), (2, 2), (3, 3), (4, 3), (5, 3)]


def test_weighted_positions_match_expanded_rows(spark, ranges):
    """Each (value, count) row covers `count` consecutive positions: compare with the
    positions of the expanded rows sorted by value (a brute force on a small fixture)."""
    from tallyspark.operators.ranking import weighted_positions
    pairs = [(float(v), int(w)) for v, w in [(5, 1), (1, 400), (3, 2), (2, 7), (9, 1), (4, 30)]]
    df = spark.createDataFrame(pairs, "v double, w bigint")
    expanded = sorted(v for v, w in pairs for _ in range(w))
    wanted = [1, 400, 401, 408, 409, 410, 440, 441]
    got = weighted_positions(df, ["v"], "w", wanted).collect()
    for p in wanted:
        hit = [r["v"] for r in got if r["_start"] <= p <= r["_end"]]
        assert hit == [expanded[p - 1]], p


def test_exact_quantiles_hot_value_and_several_columns(spark):
    import numpy as np
    from tallyspark.operators.profile import exact_quantiles_multi, value_counts
    df = _frame(spark, 3001).withColumn("u", (F.col("key") % 11).cast("double"))
    vc = value_counts(df, ["v", "u"])
    counts = {r["column_name"]: r["n"] for r in
              vc.groupBy("column_name").agg(F.sum("freq").alias("n")).collect()}
    got = {r["column_name"]: r for r in exact_quantiles_multi(vc, counts, (0.1, 0.5, 0.9)).collect()}
    for c in ("v", "u"):
        vals = np.array([r[0] for r in df.select(c).collect() if r[0] is not None])
        for q in (0.1, 0.5, 0.9):
            assert abs(got[c][f"q{round(q * 100)}"] - float(np.quantile(vals, q))) < 1e-9


def test_modes_order_numbers_as_numbers(spark):
    from tallyspark.operators.profile import describe_all, top_values
    df = spark.createDataFrame([(10,), (9,), (10,), (9,), (None,)], "n int")
    assert top_values(df, ["n"]).collect()[0]["n"] == 9  # tie: 9 < 10 numerically
    empty = spark.createDataFrame([(1, None), (2, None)], "k int, s string")
    rows = {r["column_name"]: r for r in describe_all(empty, ["k", "s"]).collect()}
    assert rows["s"]["count"] == 0 and rows["s"]["n_unique"] == 0 and rows["s"]["top"] is None
    assert rows["k"]["p50"] == 1.5 and rows["k"]["count"] == 2


def test_global_order_typed_keys_match_builtin(spark):
    """Keys of every type: string with quotes and non-ASCII text, date, decimal, timestamp."""
    words = F.element_at(F.array(*[F.lit(w) for w in ["a'b", "Zürich", "x\\y", "", "東京", "b"]]),
                         (F.col("id") % 6 + 1).cast("int"))
    df = spark.range(1200).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 11 == 0, F.lit(None).cast("string")).otherwise(words).alias("s"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 17).cast("int")).alias("d"),
        (F.col("id") % 13 / 4).cast("decimal(10,2)").alias("m"),
        F.expr("CAST('2021-03-04 05:06:07' AS TIMESTAMP_NTZ) + make_interval(0, 0, 0, 0, 0, 0, id % 7)")
         .alias("t"))
    keys = [("s", False), ("d", True), ("m", False), ("t", True), ("key", False)]
    ours = global_order(df, keys, rank_prefixes=(2,))
    order = [F.col("s").asc_nulls_last(), F.col("d").desc_nulls_last(), F.col("m").asc_nulls_last(),
             F.col("t").desc_nulls_last(), F.col("key").asc_nulls_last()]
    ref = df.select("key", F.row_number().over(Window.orderBy(*order)).alias("rn"),
                    F.rank().over(Window.orderBy(*order[:2])).alias("rk"))
    got = ours.select("key", F.col("_g_rn").alias("rn"), F.col("_g_rank2").alias("rk"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0

"""Operator semantics on tiny frames: nulls, ties, hot keys, empty input."""

import os
import tempfile

from pyspark.sql import functions as F

from tallyspark.operators import clean as C
from tallyspark.operators import profile as P
from tallyspark.operators import quality as Q
from tallyspark.sources import files as FS
from tallyspark.sources import versions as V
from tallyspark.session import scratch_root


def _staff(spark):
    rows = [(1, "a", 30, 100.0, "N"), (2, "b", None, 200.0, None), (3, "c", 41, None, "S"),
            (4, "d", 33, 250.5, "N"), (5, "a", 30, 100.0, "N")]
    return spark.createDataFrame(rows, "id bigint, name string, age int, salary double, region string")


def test_impute_mean_half_up_and_truncate(spark):
    df = _staff(spark)
    got = {r["id"]: (r["age"], r["salary"]) for r in C.impute_mean(df, ["age", "salary"]).collect()}
    # ages 30,41,33,30 -> mean 33.5 -> half-up 34 ; salary mean 650.5/4 = 162.625 -> 162.63
    assert got[2][0] == 34 and got[3][1] == 162.63
    trunc = {r["id"]: r["age"] for r in C.impute_mean(df, ["age"], int_mode="truncate").collect()}
    assert trunc[2] == 33


def test_impute_median_mode_and_constants(spark):
    df = _staff(spark)
    med = {r["id"]: r["salary"] for r in C.impute_median(df, ["salary"]).collect()}
    assert med[3] == 150.0  # median of 100, 200, 250.5, 100 -> (100 + 200) / 2
    mode = {r["id"]: r["region"] for r in C.impute_mode(df, ["region"]).collect()}
    assert mode[2] == "N"
    tie = spark.createDataFrame([("x",), ("y",), ("y",), ("x",), (None,)], "c string")
    assert sorted(r["c"] for r in C.impute_mode(tie, ["c"]).collect()) == ["x", "x", "x", "y", "y"]
    filled = C.fill_constants(df, {"region": "Unknown", "age": 0}).filter(F.col("id") == 2).collect()[0]
    assert filled["region"] == "Unknown" and filled["age"] == 0


def test_coerce_and_parse(spark):
    df = spark.createDataFrame([("1.5", "2024-01-02"), ("n/a", "bad"), (None, None)], "p string, d string")
    out = C.parse_dates(C.coerce_numeric(df, ["p"]), ["d"]).collect()
    assert out[0]["p"] == 1.5 and str(out[0]["d"]) == "2024-01-02"
    assert out[1]["p"] is None and out[1]["d"] is None


def test_dedup_exact_and_keep_first_hot_group(spark):
    df = _staff(spark)
    assert C.dedup_exact(df).count() == 5
    subset = ["name", "age", "salary", "region"]
    kept = C.dedup_keep_first(df, subset, "id")
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3, 4]
    hot = spark.range(5000).select(F.lit("k").alias("g"), F.col("id"))
    one = C.dedup_keep_first(hot, ["g"], "id").collect()
    assert len(one) == 1 and one[0]["id"] == 0


def test_dense_row_id_is_dense(spark):
    df = spark.range(300).select((F.col("id") * 7 % 300).alias("k"))
    ids = sorted(r["row_id"] for r in C.dense_row_id(df, ["k"]).collect())
    assert ids == list(range(300))


def test_null_report_and_profile(spark):
    df = _staff(spark)
    rep = {r["column_name"]: r["null_count"] for r in P.missing_report(df).collect()}
    assert rep == {"age": 1, "salary": 1, "region": 1}
    prof = {r["column_name"]: (r["dtype"], r["non_null"], r["total_rows"]) for r in P.profile_columns(df).collect()}
    assert prof["age"] == ("int", 4, 5)
    dup = P.dup_report(df.drop("id")).collect()[0]
    assert (dup["total_rows"], dup["distinct_rows"], dup["duplicate_rows"]) == (5, 4, 1)


def test_describe_all_shapes(spark):
    df = _staff(spark)
    rows = {r["column_name"]: r for r in P.describe_all(df, ["age", "region"]).collect()}
    assert rows["age"]["count"] == 4 and rows["age"]["p50"] == 31.5 and rows["age"]["top"] is None
    assert rows["region"]["top"] == "N" and rows["region"]["freq"] == 3 and rows["region"]["mean"] is None


def test_quality_rules_and_split(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 99)], "id int, parent int")
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    assert sorted(r["id"] for r in Q.orphans(child, "parent", parent, "pk").collect()) == [4]
    rules = [Q.Rule("parent_fk", "foreign_key", "parent", parent=(parent, "pk")),
             Q.Rule("parent_nn", "not_null", "parent"),
             Q.Rule("id_small", "check", "id", "id < 4")]
    suite = {r["check_name"]: r["violations"] for r in Q.run_suite(child, "t", rules).collect()}
    assert suite == {"parent_fk": 1, "parent_nn": 1, "id_small": 1}
    split = {r["id"]: r["reject_reason"] for r in Q.split_valid(child, rules).collect()}
    assert split == {1: None, 2: None, 3: "parent_nn", 4: "id_small;parent_fk"} or \
        split == {1: None, 2: None, 3: "parent_nn", 4: "parent_fk;id_small"}
    dups = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert Q.duplicate_keys(dups, "k").collect()[0]["cnt"] == 2


def test_guarded_copy_skips_missing_and_reports(spark):
    src = scratch_root(spark)
    spark.range(100).write.parquet(src)
    dst = scratch_root(spark)
    rep = FS.guarded_copy(spark, src, dst)
    assert rep["status"] == "copied" and rep["rows_read"] == 100 and rep["rows_copied"] == 100
    assert spark.read.parquet(dst).count() == 100
    missing = FS.guarded_copy(spark, src + "-does-not-exist", scratch_root(spark))
    assert missing["status"] == "skipped"


def test_publish_is_all_or_nothing(spark):
    root = scratch_root(spark)
    base = scratch_root(spark)
    spark.range(10).withColumnRenamed("id", "k").write.parquet(base)
    V.register_base(spark, root, "t", base)
    checks = lambda cur, batch: Q.run_suite(cur["t"], "t", [Q.Rule("k_unique", "unique", "k")])
    ok = V.publish(spark, root, {"t": spark.range(10, 15).withColumnRenamed("id", "k")}, checks)
    assert ok["published"] and V.resolve(spark, root, "t").count() == 15
    bad = V.publish(spark, root, {"t": spark.range(0, 3).withColumnRenamed("id", "k")}, checks)
    assert not bad["published"] and bad["violations"] == 6  # three keys, two rows each
    assert V.resolve(spark, root, "t").count() == 15  # readers never see the rejected batch


def test_partitioned_write_prunes(spark):
    out = scratch_root(spark)
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("p"), "id")
    FS.write_parquet(df, out, partition_by="p")
    parts = sorted(d for d in os.listdir(out) if d.startswith("p="))
    assert parts == ["p=0", "p=1", "p=2"]
    q = spark.read.parquet(out).filter(F.col("p") == "1")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and q.count() == 333


def test_partitioned_write_splits_a_hot_value(spark):
    out = scratch_root(spark)
    hot = F.when(F.col("id") % 3 == 0, F.lit("small")).otherwise(F.lit("hot"))
    df = spark.range(30000).select(hot.alias("p"), "id")
    # AQE merges these tiny range partitions into one; without merging, 30,000 rows
    # behave like a large table
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        FS.write_parquet(df, out, partition_by="p")
    finally:
        spark.conf.set(key, old)
    files = lambda v: [f for f in os.listdir(os.path.join(out, f"p={v}")) if f.endswith(".parquet")]
    assert len(files("hot")) > 2  # two thirds of the rows: several writer tasks
    assert spark.read.parquet(out).groupBy("p").count().collect() and \
        spark.read.parquet(out).count() == 30000


def test_file_metadata_of_files_folders_and_missing_paths(spark):
    d = tempfile.mkdtemp()
    os.makedirs(os.path.join(d, "nested", "deep"))
    os.mkdir(os.path.join(d, "empty"))
    for name in ("x.txt", "nested/deep/y.txt"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("hello")
    rows = FS.file_metadata(spark, [os.path.join(d, n) for n in ("x.txt", "nope.csv", "nested", "empty")]).collect()
    by = {r["item_name"]: r for r in rows}
    assert by["x.txt"]["exists"] and by["x.txt"]["size"] == 5 and not by["x.txt"]["is_folder"]
    assert by["nope.csv"]["exists"] is False
    assert by["nested"]["exists"] and by["nested"]["size"] == 5 and by["nested"]["n_files"] == 1
    assert by["empty"]["exists"] and by["empty"]["is_folder"] and by["empty"]["n_files"] == 0


AWKWARD = ['say "hi", ok', 'back\\slash \\" end\\', "two\nlines", "dos\r\nline", "", None, " blanks ", ",", '"', "ü€"]


def test_csv_is_lossless(spark):
    df = spark.createDataFrame(list(enumerate(AWKWARD)), "id int, t string")
    out = scratch_root(spark)
    FS.write_csv(df, out, null_value=FS.NULL_TEXT)
    back = FS.read_csv(spark, out, schema=df.schema, null_value=FS.NULL_TEXT, mode="FAILFAST")
    assert dict(map(tuple, back.collect())) == dict(enumerate(AWKWARD))
    FS.write_csv(df, out)   # the default: empty and NULL are one
    back = dict(map(tuple, FS.read_csv(spark, out, schema=df.schema).collect()))
    assert back == dict(enumerate(x or None for x in AWKWARD))
    FS.write_csv(df, out, single_file=True)
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 1


def test_guarded_copy_of_csv_leaves_the_schema_alone(spark):
    schema = spark.createDataFrame([], "id int, v double").schema
    src, dst = scratch_root(spark), scratch_root(spark)
    FS.write_csv(spark.createDataFrame([(1, "1.5"), (2, "n/a"), (3, 'x"\ny')], "id int, v string"), src)
    rep = FS.guarded_copy(spark, src, dst, fmt="csv", schema=schema)
    assert (rep["rows_read"], rep["rows_copied"], rep["rows_skipped"]) == (3, 1, 2)
    assert schema.names == ["id", "v"]


def test_commits_are_numbered_folded_and_checked(spark, monkeypatch):
    import pytest
    monkeypatch.setattr(V, "FOLD_AFTER", 4)
    root, base = scratch_root(spark), scratch_root(spark)
    spark.range(10).write.parquet(base)
    V.register_base(spark, root, "t", base)
    V.register_base(spark, root, "t", base)    # again: nothing changes
    assert V.resolve(spark, root, "t").count() == 10
    for i in range(5):
        V.publish(spark, root, {"t": spark.range(100 + i, 101 + i)})
    assert V.resolve(spark, root, "t").count() == 15
    last, state = V.manifest(spark, root)
    V.publish(spark, root, {}, replaces={"t": spark.range(3)})
    assert V.resolve(spark, root, "t").count() == 3
    with pytest.raises(V.Conflict):             # this writer has not seen the replacement
        V.commit(spark, root, last, state, {"t": V.Change(base)})


def test_unique_means_the_same_in_suite_and_split(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    stored = spark.createDataFrame([(2,), (2,), (9,)], "k int")
    rules = [Q.Rule("k_unique", "unique", "k"), Q.Rule("k_new", "new_key", "k", parent=(stored, "k"))]
    suite = {r["check_name"]: r["violations"] for r in Q.run_suite(df, "t", rules).collect()}
    split = {r["v"]: r["reject_reason"] for r in Q.split_valid(df, rules).collect()}
    assert suite == {"k_unique": 2, "k_new": 1}
    assert split == {"a": "k_unique", "b": "k_unique", "c": "k_new", "d": None, "e": None}
    assert Q.run_suite(df, "t", []).count() == 0


def test_left_outer_join_with_a_shared_key_name(spark):
    from tallyspark.operators.relational import left_outer_join
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (1, "q"), (3, "r")], "k int, b string")
    assert sorted(map(tuple, left_outer_join(a, b, "k", "k").collect()), key=str) == [
        (1, "x", "p"), (1, "x", "q"), (2, "y", None)]


def test_scratch_tables_are_deleted_and_settings_kept(spark):
    import pytest
    from tallyspark import session as SS
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "123")
    SS.apply_scale_conf(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "123"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    with SS.scratch(spark):
        path = scratch_root(spark)
        spark.range(3).write.parquet(path)
        assert FS.path_exists(spark, path)
    assert not FS.path_exists(spark, path)

    class Elsewhere:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Elsewhere
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SS.checkpoint_dir(Session)


def test_means_keep_every_decimal_and_decimals_are_profiled(spark):
    from decimal import Decimal as D
    fine = spark.createDataFrame([(0.001,), (0.002,), (0.004,), (None,)], "x double")
    row = P.describe_all(fine, ["x"]).collect()[0]
    assert abs(row["mean"] - 0.007 / 3) < 1e-15 and abs(row["std"] - 0.0015275252316519468) < 1e-12
    row = P.describe_numeric(fine, ["x"]).collect()[0]
    assert abs(row["mean"] - 0.007 / 3) < 1e-15 and abs(row["stddev"] - 0.0015275252316519468) < 1e-12
    assert {r["x"] for r in C.impute_mean(fine, ["x"], decimals=4).collect()} == {0.001, 0.002, 0.004, 0.0023}
    money = spark.createDataFrame([(D("1.10"),), (D("2.25"),), (None,)], "m decimal(10,2)")
    assert P.describe_all(money, ["m"]).collect()[0]["mean"] == 1.675
    assert {r["m"] for r in C.impute_by_dtype(money).collect()} == {D("1.10"), D("2.25"), D("1.68")}
    big = spark.createDataFrame([(1e17,), (3e17,)], "x double")
    assert P.describe_all(big, ["x"]).collect()[0]["mean"] == 2e17


def test_median_of_integers_may_lie_between_two(spark):
    df = spark.createDataFrame([(2,), (3,), (None,)], "n int")
    assert sorted(r["n"] for r in C.impute_median(df, ["n"]).collect()) == [2.0, 2.5, 3.0]
    assert sorted(r["n"] for r in C.impute_median(df, ["n"], int_mode="truncate").collect()) == [2, 2, 3]


def test_medians_in_the_columns_own_type(spark):
    from decimal import Decimal as D
    wide = spark.createDataFrame([(D("90071992547409930.1"),), (D("90071992547409930.3"),), (None,)], "m decimal(20,1)")
    assert sorted(r["m"] for r in C.impute_median(wide, ["m"]).collect())[1] == D("90071992547409930.2")
    rows = [(i % 7 or None, D(i) / 4, float(i * i % 101), None) for i in range(4001)]
    df = spark.createDataFrame(rows, "a int, b decimal(12,2), c double, d double").repartition(5)
    got = P.bracketed_quantiles(df, ["a", "b", "c", "d"], (0.25, 0.5, 0.9))
    one = spark.range(1).select(*[v.cast("double").alias(f"{c}{q}") for (c, q), v in got.items()]).first()
    for i, c in enumerate("abc"):
        values = sorted(float(r[i]) for r in rows if r[i] is not None)
        for q in (0.25, 0.5, 0.9):
            at = (len(values) - 1) * q
            want = values[int(at)] + (values[min(int(at) + 1, len(values) - 1)] - values[int(at)]) * (at - int(at))
            assert abs(one[f"{c}{q}"] - want) < 0.011, (c, q)
    assert one["d0.5"] is None
    assert P.bracketed_quantiles(df.limit(0), ["a"]) and P.bracketed_quantiles(df, []) == {}


def test_a_missed_bracket_is_widened(spark, monkeypatch):
    monkeypatch.setattr(P, "BRACKET", 10)
    monkeypatch.setattr(P, "BRACKET_SLACK", 0.001)
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    (value,) = P.bracketed_quantiles(df, ["x"]).values()
    assert spark.range(1).select(value).first()[0] == 499.5


def test_csv_without_line_breaks_is_read_in_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        one, other = scratch_root(spark), scratch_root(spark)
        df = spark.range(20_000).select("id", F.concat(F.lit('a "quoted", text '), F.col("id")).alias("t")).coalesce(1)
        FS.write_csv(df, one)
        assert list(FS.line_break_files(spark, one).values()) == [False]
        back = FS.read_csv(spark, one, schema=df.schema, mode="FAILFAST")
        assert back.rdd.getNumPartitions() > 3 and back.count() == 20_000
        assert back.exceptAll(df).count() == 0
        FS.write_csv(df.filter("id < 3").withColumn("t", F.concat("t", F.lit("\nx"))), other)
        assert list(FS.line_break_files(spark, other).values()) == [True]
        both = FS.read_csv(spark, scratch_folder_of(spark, one, other), schema=df.schema, mode="FAILFAST")
        assert both.count() == 20_003 and both.filter("t LIKE '%\nx'").count() == 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def scratch_folder_of(spark, *folders):
    """One folder with the files of several."""
    import shutil
    out = scratch_root(spark).removeprefix("file://")
    os.makedirs(out)
    for i, folder in enumerate(folders):
        for name in os.listdir(folder.removeprefix("file://")):
            if name.startswith("part-"):
                shutil.copy(os.path.join(folder.removeprefix("file://"), name), os.path.join(out, f"part-{i}-{name}"))
    return out

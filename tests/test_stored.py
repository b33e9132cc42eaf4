"""Sketches, incremental totals, digests, layouts and histories against brute force."""

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import digest as D
from tallyspark.operators import history as H
from tallyspark.operators import sketches as K
from tallyspark.plans import incremental as I
from tallyspark.plans import stored as ST
from tallyspark.session import plan_text, scratch_root
from tallyspark.sources import layout as L
from tallyspark.sources import versions as V
from tallyspark.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_merged_sketches_keep_their_bounds(spark):
    rows = spark.range(60_000).select((F.col("id") % 40).cast("int").alias("d"), (F.col("id") * 7919 % 20_011).alias("x"),
                                      F.sqrt(F.col("id").cast("double")).alias("y"))
    days = K.sketched(rows, F.col("d"), {"x": F.col("x")}, {"y": F.col("y")})
    assert days.count() == 40
    for first, last in ((0, 39), (3, 17), (8, 8)):
        part = rows.filter(F.col("d").between(first, last))
        got = K.merged(days.filter(F.col("day").between(first, last)), [], ["x"], {"y": [0.5]}).first()
        exact = part.select("x").distinct().count()
        n = part.count()
        assert got["n_rows"] == n and abs(got["x"] - exact) <= max(1, exact * K.distinct_error())
        below, upto = part.filter(F.col("y") < got["y"][0]).count(), part.filter(F.col("y") <= got["y"][0]).count()
        assert below <= n * (0.5 + K.RANK_ERROR) + 1 and upto >= n * (0.5 - K.RANK_ERROR) - 1


def test_dashboard_reads_states_and_the_batch_only(spark):
    t, root = Tables(spark, SF), scratch_root(spark)
    ST.dashboard_batches(t, root)
    totals = I.customer_totals(spark, root)
    p = plan_text(totals, "simple")
    assert "lineitem.parquet" not in p and "/lines/" not in p and p.count("FileScan parquet") == 1
    from tallyspark.sources import standins as S
    full = S.customer_sales(t, with_profit=True).select(*totals.columns)
    assert totals.exceptAll(full).count() == 0 and full.exceptAll(totals).count() == 0
    # a batch of late lines of known orders: the order isn't counted again
    late = ST._fact(t).filter("order_id % 10 = 1").drop("line_no").limit(20)
    I.add_batch(spark, root, late)
    after = I.customer_totals(spark, root)
    assert after.agg(F.sum("total_orders")).first()[0] == full.agg(F.sum("total_orders")).first()[0]
    assert after.agg(F.sum("n_lines")).first()[0] == full.agg(F.sum("n_lines")).first()[0] + 20
    assert I.fold_states(spark, root, after=2) and not I.fold_states(spark, root, after=2)
    assert len(V.manifest(spark, root)[1][I.STATE].paths) == 1
    assert I.customer_totals(spark, root).exceptAll(after).count() == 0


def test_digests_name_the_damaged_ranges_and_rows(spark):
    a = spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    same = D.find_damage(a, a.repartition(7), "k")
    assert same.ranges.count() == 0 and same.rows.count() == 0 and same.compared == 0
    # a lost row, a row twice, a changed value, and a pair that cancels under XOR
    b = (a.filter("k NOT IN (17, 40000)").withColumn("v", F.when(F.col("k") == 25_000, 9).otherwise(F.col("v")))
         .unionAll(a.filter("k = 123")).unionAll(a.filter("k = 124")).unionAll(a.filter("k = 124")))
    found = D.find_damage(a, b, "k", fan=8, leaf_rows=100)
    rows = {(r["k"], r["v"]): (r["in_source"], r["in_copy"]) for r in found.rows.collect()}
    assert rows == {(17, 3): (1, 0), (40_000, 2): (1, 0), (25_000, 3): (1, 0), (25_000, 9): (0, 1), (123, 4): (1, 2),
                    (124, 5): (1, 3)}
    assert found.compared < 1000
    for r in found.ranges.collect():
        assert any(r["low"] <= k <= r["high"] for k in (17, 123, 124, 25_000, 40_000))


def test_digests_with_null_keys_nulls_and_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(D, "MOST_RANGES", 2)
    rows = [(None if i % 50 == 0 else i, None if i % 3 else i, None if i % 3 == 0 else i) for i in range(2000)]
    a = spark.createDataFrame(rows, "k long, x long, y long")
    swapped = [(k, y, x) if k in (7, 701, 1501) else (k, x, y) for k, x, y in rows]
    found = D.find_damage(a, spark.createDataFrame(swapped, a.schema), "k", fan=4, leaf_rows=5)
    assert sorted({r["k"] for r in found.rows.collect()}) == [7, 701, 1501]
    lost = D.find_damage(a, a.filter("k IS NOT NULL"), "k", fan=4, leaf_rows=5)
    assert lost.rows.agg(F.sum("in_source")).first()[0] == 40
    empty = a.limit(0)
    assert D.find_damage(empty, empty, "k").rows.count() == 0
    assert D.find_damage(a, empty, "k", leaf_rows=5).rows.agg(F.sum("in_source")).first()[0] == 2000


@pytest.mark.parametrize("buckets, split", [(4, 1), (16, 1), (8, 3)])
def test_bucketed_tables_join_without_an_exchange(spark, buckets, split):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, lines = ST.bucketed_tables(Tables(spark, SF), buckets, split)
        joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        p = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in p and "SortMergeJoin" in p
        assert joined.count() == Tables(spark, SF).lineitem("l_orderkey").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_a_hot_bucket_is_written_by_several_tasks(spark):
    import os
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    path = scratch_root(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS tally_hot")
    L.write_bucketed(rows, "tally_hot.t", path, ["k"], 4, split=5)
    sizes = [pq.ParquetFile(os.path.join(path.removeprefix("file://"), f)).metadata.num_rows
             for f in os.listdir(path.removeprefix("file://")) if f.startswith("part-")]
    assert sum(sizes) == 30_000 and max(sizes) < 8_000       # the hot key alone has 10,001, its bucket 15,000
    assert spark.table("tally_hot.t").filter("k = 1").count() == 10_001
    L.drop_database(spark, "tally_hot")


def _admitted(path, column, low, high):
    """Files whose footers admit a value of [low, high]."""
    import glob
    files, hit = glob.glob(path.removeprefix("file://") + "/part-*.parquet"), 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            at = next(i for i in range(meta.num_columns) if meta.row_group(g).column(i).path_in_schema == column)
            s = meta.row_group(g).column(at).statistics
            hit += s.min <= high and s.max >= low
    return hit, len(files)


def test_ranges_on_every_clustered_column_leave_files_unread(spark):
    rows = spark.range(40_000).select((F.col("id") * 7919 % 10_007).alias("a"), (F.col("id") * 104_729 % 5_003).alias("b"),
                                      (F.col("id") * 31 % 977).cast("double").alias("c"), (F.col("id") % 500).alias("e"))
    path = scratch_root(spark)
    L.write_clustered(rows, path, ["a", "b", "c"], 64, {"e": 500})
    plain = scratch_root(spark)
    rows.repartition(64).write.parquet(plain)
    for column, low, high in (("a", 100, 300), ("b", 4000, 4100), ("c", 10.0, 30.0)):
        hit, files = _admitted(path, column, low, high)
        all_hit, all_files = _admitted(plain, column, low, high)
        assert all_hit == all_files and hit <= files // 2
    back = spark.read.parquet(path)
    assert back.exceptAll(rows).count() == 0 and back.count() == 40_000
    # Bloom filters of a column that isn't clustered: they are part of the files
    import glob
    import os
    without = scratch_root(spark)
    L.write_clustered(rows, without, ["a", "b", "c"], 64)
    size = [sum(os.path.getsize(f) for f in glob.glob(p.removeprefix("file://") + "/part-*")) for p in (path, without)]
    assert size[0] > size[1] + 64 * 32
    assert back.filter("e = 77").count() == 80


def brute_versions(rows):
    """{key: [(from, to, state)]} day by day."""
    out = {}
    for key in {r[0] for r in rows}:
        days = {}
        for k, d, s in rows:
            if k == key:
                days.setdefault(d, []).append(s)
        spans = []
        for d in sorted(days):
            s = min(set(days[d]), key=lambda s: (-days[d].count(s), s))
            if not spans or spans[-1][1] != s:
                spans.append((d, s))
        out[key] = [(d, spans[i + 1][0] if i + 1 < len(spans) else None, s) for i, (d, s) in enumerate(spans)]
    return out


def test_history_against_brute_force(spark):
    rnd = random.Random(4)
    base = dt.date(2020, 1, 1)
    rows = [(rnd.randint(1, 6), base + dt.timedelta(days=rnd.randint(0, 30)), rnd.choice("aab")) for _ in range(400)]
    df = spark.createDataFrame(rows, "k int, day date, s string")
    want = brute_versions(rows)
    got = {}
    for r in H.versions(df, "k", ["s"], "day").orderBy("k", "version").collect():
        got.setdefault(r["k"], []).append((r["valid_from"], r["valid_to"], r["s"]))
        assert r["is_current"] == (r["valid_to"] is None) and r["version"] == len(got[r["k"]])
    assert got == want
    assert {r["k"]: r["s"] for r in H.current(df, "k", ["s"], "day").collect()} == {k: v[-1][2] for k, v in want.items()}
    found = H.as_of(df, "k", ["s"], "day")
    assert found.count() == 400
    for r in found.collect():
        assert any(f <= r["day"] and (t is None or r["day"] < t) and s == r["valid_s"] for f, t, s in want[r["k"]])
    p = plan_text(found, "simple")
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_type_evidence_merges_and_widens(spark):
    from tallyspark.operators import lattice as Y
    a = spark.createDataFrame([("1", "1.5", "2020-01-31", "true"), ("-7", "", None, "FALSE")], "a string, b string, c string, d string")
    b = spark.createDataFrame([("3000000000", "20.25", "2020-02-30", "x")], a.schema)

    def types(found):
        return {r["column_name"]: r["type"] for r in Y.chosen(found).collect()}
    ea, eb = Y.evidence(a), Y.evidence(b)
    assert types(ea) == {"a": "int", "b": "decimal(2,1)", "c": "date(yyyy-MM-dd)", "d": "boolean"}
    both = Y.merged(ea, eb)
    assert types(both) == {"a": "bigint", "b": "decimal(4,2)", "c": "string", "d": "string"}
    assert types(both) == types(Y.evidence(a.unionByName(b)))
    why = {(r["column_name"], r["candidate"]): r["example"] for r in both.collect()}
    assert why["a", "int"] == "3000000000" and why["c", "date(yyyy-MM-dd)"] == "2020-02-30" and why["d", "boolean"] == "x"
    out = Y.typed(a, types(ea))
    assert [t for _, t in out.dtypes] == ["int", "decimal(2,1)", "date", "boolean"]
    assert out.filter("b IS NULL AND c IS NULL").count() == 1
    huge = spark.createDataFrame([("9" * 30,), ("0.5",)], "a string")
    assert types(Y.evidence(huge)) == {"a": "decimal(31,1)"}
    assert types(Y.evidence(spark.createDataFrame([("9" * 30,), ("0." + "1" * 20,)], "a string"))) == {"a": "double"}
    assert types(Y.evidence(a.limit(0))) == dict.fromkeys("abcd", "string")


def test_a_killed_copy_leaves_no_double_rows(spark):
    from tallyspark.sources import ledger as LG
    src, dst = scratch_root(spark), scratch_root(spark)
    spark.range(1000).repartition(5).write.parquet(src)
    schema = spark.read.parquet(src).schema
    size = max(s for s, _ in LG.source_files(spark, src).values())
    real, calls = LG.create_once, []

    def fails(spark, folder, name, text):       # the rows of the third batch are written, its entry isn't
        calls.append(name)
        if len(calls) == 3:
            raise RuntimeError("killed")
        return real(spark, folder, name, text)
    LG.create_once = fails
    try:
        with pytest.raises(RuntimeError, match="killed"):
            LG.sync(spark, src, dst, schema, batch_bytes=size)
    finally:
        LG.create_once = real
    assert LG.read_copy(spark, dst, schema).count() < 1000
    done = LG.sync(spark, src, dst, schema, batch_bytes=size)
    assert done["files_left"] == 2 and done["files_copied"] == 3
    copy = LG.read_copy(spark, dst, schema)
    assert copy.count() == 1000 and copy.distinct().count() == 1000
    assert LG.sync(spark, src, dst, schema) == {"files_copied": 0, "files_left": 5, "files_gone": 0}


def test_a_folded_ledger_holds_everything(spark, monkeypatch):
    from tallyspark.sources import ledger as LG
    monkeypatch.setattr(LG, "FOLD_AFTER", 3)
    src, dst = scratch_root(spark), scratch_root(spark)
    spark.range(700).repartition(7).write.parquet(src)
    schema = spark.read.parquet(src).schema
    size = max(s for s, _ in LG.source_files(spark, src).values())
    assert LG.sync(spark, src, dst, schema, batch_bytes=size)["files_copied"] == 7
    number, entries = LG.read_ledger(spark, dst)
    assert number == 7 and len(entries) == 7 and LG.read_copy(spark, dst, schema).count() == 700

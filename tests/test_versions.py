"""Commits, key filters and updates of touched files."""

import os

import pytest
from pyspark.sql import functions as F

from tallyspark.session import plan_text, scratch_root
from tallyspark.sources import keyfilters as K
from tallyspark.sources import versions as V


def _stock(spark, root, n=8):
    base = scratch_root(spark)
    (spark.range(800).select(F.col("id").alias("k"), (F.col("id") * 10).alias("qty")).repartitionByRange(n, "k")
     .write.parquet(base))
    V.register_base(spark, root, "stock", base, spark.read.parquet(base).schema)
    return base


def _times(paths):
    return {p: os.stat(p.removeprefix("file:")).st_mtime_ns for p in paths}


def test_an_update_rewrites_the_touched_files_alone(spark):
    root = scratch_root(spark)
    _stock(spark, root)
    before = _times(V.files_of(spark, V.manifest(spark, root)[1]["stock"]))
    changes = spark.createDataFrame([(5, 3), (7, 4), (799, 1)], "k long, sold long")
    rewrite = V.update_touched(spark, root, "stock", changes, "k", {"qty": F.col("qty") - F.col("new_sold")})
    assert len(rewrite.drops) == 2 and set(rewrite.drops) <= set(before)
    V.publish(spark, root, {}, rewrites={"stock": rewrite})
    after = _times(V.files_of(spark, V.manifest(spark, root)[1]["stock"]))
    assert {p: t for p, t in after.items() if p in before} == {p: t for p, t in before.items() if p not in rewrite.drops}
    rows = {r["k"]: r["qty"] for r in V.resolve(spark, root, "stock").collect()}
    assert rows == {k: 10 * k - {5: 3, 7: 4, 799: 1}.get(k, 0) for k in range(800)}
    # again, over the rewritten files and the others; and with keys that no row has
    again = V.update_touched(spark, root, "stock", spark.createDataFrame([(5, 1)], "k long, sold long"), "k",
                             {"qty": F.col("qty") - F.col("new_sold")})
    V.publish(spark, root, {}, rewrites={"stock": again})
    assert V.resolve(spark, root, "stock").filter("k = 5").first()["qty"] == 46
    assert V.resolve(spark, root, "stock").count() == 800
    none = spark.createDataFrame([(5000, 1)], "k long, sold long")
    assert V.update_touched(spark, root, "stock", none, "k", {"qty": F.col("qty")}) is None


def test_replaced_files_stay_gone_in_a_folded_manifest(spark, monkeypatch):
    monkeypatch.setattr(V, "FOLD_AFTER", 4)
    root = scratch_root(spark)
    _stock(spark, root)
    for i in range(6):
        change = spark.createDataFrame([(i * 130, 1)], "k long, sold long")
        V.publish(spark, root, {}, rewrites={"stock": V.update_touched(
            spark, root, "stock", change, "k", {"qty": F.col("qty") - F.col("new_sold")})})
    rows = V.resolve(spark, root, "stock")
    assert rows.count() == 800 and rows.agg(F.sum("qty")).first()[0] == 10 * 800 * 799 // 2 - 6


def test_a_reader_sees_nothing_of_a_commit_that_is_being_written(spark, monkeypatch):
    root = scratch_root(spark)
    _stock(spark, root)
    seen = []
    real = V._local

    def spy(jvm, fs, path):     # called between writing the draft and giving it its number
        seen.append((V.manifest(spark, root)[0], V.resolve(spark, root, "stock").count()))
        return real(jvm, fs, path)
    monkeypatch.setattr(V, "_local", spy)
    V.publish(spark, root, {"stock": spark.createDataFrame([(1000, 1)], "k long, qty long")})
    monkeypatch.undo()
    assert seen and set(seen) == {(1, 800)}
    assert V.manifest(spark, root)[0] == 2 and V.resolve(spark, root, "stock").count() == 801
    assert not [f for f in os.listdir(f"{root}/{V.MANIFEST}".removeprefix("file://")) if f.startswith("_draft")]


def test_drifted_columns_are_refused(spark):
    root = scratch_root(spark)
    _stock(spark, root)
    with pytest.raises(ValueError, match="columns differ"):
        V.publish(spark, root, {"stock": spark.createDataFrame([("x", 1)], "k string, qty long")})


def test_filters_admit_every_key_and_few_others(spark):
    root = scratch_root(spark)
    for v in range(4):
        V.publish(spark, root, {"t": spark.range(20_000).select((F.col("id") * 4 + v).alias("k"))}, keys={"t": "k"})
    content = V.manifest(spark, root)[1]["t"]
    assert len(content.keys) == 4
    filters = list(content.keys.values())
    asked = spark.range(80_000).select(F.col("id").alias("k"))
    admitted = K.admitted(spark, asked, "k", filters)
    held = V.holders(spark, root, "t", asked, "k")
    assert held.count() == 80_000 and held.join(admitted, ["version", "k"], "left_anti").count() == 0
    false = admitted.count() - 80_000
    assert false < 0.02 * 3 * 80_000
    # a batch of the third version's keys reads that version and no other
    batch = spark.createDataFrame([(2,), (402,), (4002,), (-5,), (None,)], "k long")
    assert len(V.versions_to_read(spark, content, batch, "k").paths) == 1
    assert {r["k"] for r in V.stored_keys(spark, root, "t", batch, "k").collect()} == {2, 402, 4002}
    nothing = spark.createDataFrame([(-1,), (10_000_000,)], "k long")
    assert V.versions_to_read(spark, content, nothing, "k").paths == []
    assert V.stored_keys(spark, root, "t", nothing, "k").count() == 0
    text = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("s"))
    V.publish(spark, root, {"u": text}, keys={"u": "s"})
    assert V.stored_keys(spark, root, "u", spark.createDataFrame([("k7",), ("zz",)], "s string"), "s").count() == 1


def test_a_false_positive_is_verified_on_the_rows(spark, monkeypatch):
    root = scratch_root(spark)
    V.publish(spark, root, {"t": spark.range(100).select(F.col("id").alias("k"))}, keys={"t": "k"})
    monkeypatch.setattr(K, "prune", lambda spark, keys, key, filters: {f.version for f in filters})
    assert V.stored_keys(spark, root, "t", spark.createDataFrame([(50,), (1000,)], "k long"), "k").collect() == [(50,)]


def test_the_batch_check_prunes_by_the_key_range(spark):
    root = scratch_root(spark)
    _stock(spark, root)
    p = plan_text(V.stored_keys(spark, root, "stock", spark.createDataFrame([(5,), (9,)], "k long"), "k"), "simple")
    assert "GreaterThanOrEqual(k,5)" in p and "LessThanOrEqual(k,9)" in p

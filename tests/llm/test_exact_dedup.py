import hashlib
from collections import defaultdict

from tallyspark.llm import exact_dedup as X
from tests.llm.frames import DOCS_SCHEMA, doc_rows, docs_frame


def low(text):
    return (text or "").encode().lower()


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[low(r[1])].append(r[0])
    out, stayed = [], set()
    for r in rows:
        ids = [i for i in groups[low(r[1])] if i is not None]
        best = max(ids) if ids else None
        kept = r[0] == best and low(r[1]) not in stayed
        if kept:
            stayed.add(low(r[1]))
        out.append((r[0], best, len(groups[low(r[1])]), kept, hashlib.sha256(low(r[1])).hexdigest()))
    return sorted(out, key=str)


def found(frame):
    return sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"], r["digest"].hex())
                   for r in frame.collect()), key=str)


def test_matches_brute_force_on_odd_rows(spark):
    assert found(X.decisions(docs_frame(spark))) == brute(doc_rows())


def test_smallest_identifier_can_stay(spark):
    rows = {r["id"]: r["keep_id"] for r in X.decisions(docs_frame(spark), keep="min").collect()}
    assert rows[3] == 1 and rows[8] == 7


def test_hot_group_arrives_as_few_entries(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', id) END AS text")
    rows = X.decisions(docs).collect()
    assert len(rows) == 3000 and sum(r["kept"] for r in rows) == 2001
    assert {r["keep_id"] for r in rows if r["group_size"] > 1} == {2997}


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS_SCHEMA)
    assert X.decisions(empty).count() == 0 and X.keep_one(empty).count() == 0


def test_keep_one_leaves_one_row_of_each_text_and_all_columns(spark):
    docs = docs_frame(spark)
    kept = X.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [low(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({low(r[1]) for r in doc_rows()})


def test_query_matches_its_sql(spark):
    import duckdb
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    q = X.op10_exact_dedup(spark, d)
    sql = con.execute(X.ORACLE_SQL)
    names = [c[0] for c in sql.description]
    assert sorted(tuple(r[c] for c in names) for r in q.collect()) == sorted(sql.fetchall())


def test_merge_rounds_need_one_exchange(spark):
    """The runs are cut by digest once; the rounds find their entries in place."""
    from pyspark.sql import functions as F

    from tallyspark.session import plan_text
    runs = spark.range(5000).select((F.col("id") % X.RUNS).cast("int").alias("run"), F.unhex(F.sha2((F.col("id") % 300).cast("string"), 256)).alias("digest"),
                                    (F.col("id") % 300 * 2).cast("int").alias("nbytes"), (F.col("id") % 300).alias("proof"), F.col("id").alias("keep_id"),
                                    F.lit(1).cast("long").alias("size"))
    merged = X.merge_runs(runs, F.max)
    p = plan_text(merged, "simple")
    assert p.count("Exchange") == 1 and "rangepartitioning" in p
    rows = merged.collect()
    assert len(rows) == 300 and sum(r["size"] for r in rows) == 5000
    assert all(r["keep_id"] == max(i for i in range(5000) if i % 300 == r["proof"]) for r in rows)

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import quality_rules as Q
from tests.llm.frames import DOCS_SCHEMA, doc_rows, docs_frame

FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(wins)
    covered = {i + k for i, x in enumerate(wins) if n[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed]


def test_base_rules_match_brute_force(spark):
    rows, v = Q.with_verdict(docs_frame(spark))
    got = sorted(([r["doc_id"], r["text"], *(r[v][f] for f in FIELDS)] for r in rows.collect()), key=str)
    assert got == sorted(([r[0], r[1], *brute(r[1])] for r in doc_rows()), key=str)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "cc", "é", " ", "\n", "\t", "\x0b", "#", " "]),
                         max_size=60).map("".join), min_size=1, max_size=30))
def test_base_rules_on_random_texts(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = frame.select("i", Q.base_counts(F.col("t")).alias("c")).select("i", "c.*").collect()
    assert {r["i"]: [r[f] for f in FIELDS[:5]] for r in got} == {
        i: brute(t)[:5] for i, t in enumerate(texts)}


def corpus():
    """Host h: 40 documents under one banner; 12 of them hold little else; 30 copies of one
    clean text and 3 near copies stay."""
    clean = lambda i: "\n".join(" ".join(f"w{i}x{j}y{k}" for k in range(30)) for j in range(3))
    banner = " ".join(f"banner{k}" for k in range(80))
    rows = [(i, banner + "\n" + clean(i), "h") for i in range(28)]
    rows += [(100 + i, banner.upper() + " \n" + f"only{i} this", "h") for i in range(12)]
    rows += [(200 + i, clean(999), "h") for i in range(30)]
    rows += [(300 + i, clean(999) + f"\nedit{i}", "h") for i in range(3)]
    return rows


def test_depleted_documents_go_and_clean_copies_stay(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    rows, v = Q.with_verdict(docs)
    kept = {r["doc_id"] for r in rows.filter(F.col(v)["kept"]).collect()}
    assert kept == {r[0] for r in corpus()} - set(range(100, 112))
    assert sorted(r["doc_id"] for r in Q.clean(docs).collect()) == sorted(kept)


def test_boilerplate_lines_are_taken_out_of_the_kept_texts(spark):
    docs = spark.createDataFrame([(i, "\n\n" + t + "\n", h) for i, t, h in corpus()],
                                 "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in Q.clean(docs).collect()}
    whole = {i: t for i, t, _ in corpus()}
    banner = whole[0].split("\n")[0]
    assert all(got[i] == "\n\n" + whole[i].removeprefix(banner + "\n") + "\n" for i in got)
    assert not any("banner" in t for t in got.values()) and set(range(28)) <= set(got)


def test_line_of_another_host_is_not_touched(spark):
    rows = corpus() + [(400 + i, f"text {i}\n" + corpus()[0][1], "other") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out, v = Q.with_verdict(docs)
    assert {r[v]["words_removed"] for r in out.filter("doc_id >= 400").collect()} == {0}


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOCS_SCHEMA)
    assert Q.clean(empty).count() == 0
    docs = docs_frame(spark)
    kept = Q.clean(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {12, 13}


def test_query_matches_its_sql(spark):
    import duckdb
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    sql = con.execute(Q.ORACLE_SQL)
    names = [c[0] for c in sql.description]
    got = Q.op2_quality_rules(spark, d)
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(sql.fetchall())

from collections import Counter

import corpus_pipeline as C
from tallyspark.llm import mixing as M
from tallyspark.llm import quality_rules as Q
from tallyspark.operators.materialize import materialize
from tests.llm import test_exact_dedup, test_packing, test_quality_rules, test_simhash_dedup
from tests.llm.frames import DOCS_SCHEMA

SF = "/root/testdata/sf0.001"


def texts(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality_rules", "exact_dedup", "simhash_dedup",
                                        "source_mixing", "packing"]
    before, out = docs, []
    for _, stage in C.STAGES:
        out.append(materialize(stage(spark, before, SF)))
        before = out[-1]
    for kept in out[:-1]:
        assert kept.columns == docs.columns
    rows = texts(docs)

    depleted = {r["doc_id"] for r in verdicts(docs) if not r["base_failed"] and not r["kept"]}
    want = [r for r in rows if not test_quality_rules.brute(r[1])[-1] and r[0] not in depleted]
    assert sorted(texts(out[0])) == sorted(want)

    best = {t: max(i for i, x in want if test_exact_dedup.low(x) == t)
            for t in {test_exact_dedup.low(x) for _, x in want}}
    want = [r for r in want if best[test_exact_dedup.low(r[1])] == r[0]]
    assert sorted(texts(out[1])) == sorted(want)

    component = {i: c for i, _, c in test_simhash_dedup.brute(want)}
    want = [r for r in want if component[r[0]] == r[0]]
    assert sorted(texts(out[2])) == sorted(want)

    labels = M.label_domain(spark.read.parquet(f"{SF}/labels.parquet"))
    members, *_ = M.rates(out[2], labels)
    copies = {r["id"]: r["copies"] for r in members.collect()}
    mixed = texts(out[3])
    assert Counter(i for i, _ in mixed) == Counter({i: c for i, c in copies.items() if c})
    assert set(mixed) <= set(want)

    packed = [r.asDict() | {"id": r["doc_id"]} for r in out[4].collect()]
    assert test_packing.check(packed, mixed)[0] == 0


def verdicts(docs):
    rows, v = Q.with_verdict(docs)
    return rows.select("doc_id", f"{v}.*").collect()


def test_run_is_the_stages_one_after_another(spark):
    out = C.run(spark, SF)
    assert C.ORACLE_SQL is None and out.count() > 0
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_every_stage_takes_an_empty_table(spark):
    empty = spark.createDataFrame([], DOCS_SCHEMA)
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_boilerplate_lines_are_gone_in_all_later_stages(spark):
    """Forty texts of one source share a footer; one of them holds next to nothing else."""
    footer = " ".join(f"footer{k}" for k in range(60))

    def body(i, n):
        return "\n".join(" ".join(f"w{i}x{j}x{k}" for k in range(12)) for j in range(n))
    rows = [(i, f"{body(i, 8)}\n{footer}", "en", "site", 0) for i in range(40)]
    rows += [(90, f"{footer}\n{body(90, 1)}", "en", "site", 0), (91, f"{body(91, 8)}\n{footer}", "en", "other", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cleaned = dict(texts(C.keep_quality(spark, docs, SF)))
    assert cleaned == {i: body(i, 8) for i in range(40)} | {91: rows[-1][1]}      # 90 is depleted
    before = docs
    for _, stage in C.STAGES[:4]:
        before = materialize(stage(spark, before, SF))
        assert all("footer" not in t for i, t in texts(before) if i != 91)
    assert {i for i, _ in texts(before)} <= set(cleaned)

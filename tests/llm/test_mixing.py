import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import mixing as M
from tests.llm.frames import DOCS_SCHEMA, docs_frame

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n=600):
    """Three kinds of documents with words of their own; every second one is labelled."""
    rows, labels = [], []
    for i in range(n):
        kind = "high" if i % 10 < 6 else "low" if i % 10 < 8 else "toxic"
        draw = random.Random(i)     # words that say nothing about the kind
        text = " ".join(f"common{draw.randrange(40)}" for _ in range(draw.randrange(20, 50)))
        text += {"high": f" fine{i % 3} good", "low": " SPAM!! BUY!! ###", "toxic": f" nasty{i % 4} vile"}[kind]
        rows.append((i, text, kind))
        if i % 2:
            labels.append((i, 0 if kind == "low" else 1, 1 if kind == "toxic" else 0))
    return (spark.createDataFrame(rows, "doc_id long, text string, kind string"),
            spark.createDataFrame(labels, LABELS))


def least_squares(t, p, targets):
    """Plain projected gradient in numpy, many small steps: the smallest distance of the totals."""
    wanted = np.array(targets) * t.sum()
    every = np.linalg.pinv((p * t[:, None]).T @ p)
    r = np.ones(len(t))
    for _ in range(20_000):
        r = np.maximum(0, r - p @ (every @ ((r * t) @ p - wanted)))
    gap = (r * t) @ p - wanted
    return gap @ every @ gap


def test_rates_meet_the_targets_or_the_least_squares(spark):
    docs, labels = corpus(spark)
    for targets, met in (({"high": 0.9, "low": 0.07, "toxic": 0.03}, True),
                         ({"high": 0.3, "low": 0.2, "toxic": 0.5}, True),
                         ({"high": 0.2, "low": 0.0, "toxic": 0.8}, False)):
        members, steps, classifier = M.rates(docs, M.label_domain(labels), targets)
        rows = members.orderBy("id").collect()
        t, p = np.array([r["tokens"] for r in rows], float), np.array([r["p"] for r in rows])
        rate = np.array([r["rate"] for r in rows])
        assert np.allclose(p.sum(axis=1), 1) and (rate >= 0).all()
        gap = ((rate * t) @ p - np.array(list(targets.values())) * t.sum())
        if met:
            assert np.abs(gap).max() <= 2 * M.TOLERANCE * t.sum() and len(steps) < 20
        else:
            every = np.linalg.pinv((p * t[:, None]).T @ p)
            start = t @ p - np.array(list(targets.values())) * t.sum()
            least = least_squares(t, p, list(targets.values()))
            assert gap @ every @ gap <= least + 1e-4 * (start @ every @ start)


def test_held_out_accuracy_on_unlabelled_documents(spark):
    docs, labels = corpus(spark)
    members, _, classifier = M.rates(docs, M.label_domain(labels))
    best = members.select("id", F.array_position("p", F.array_max("p")).alias("k")).collect()
    kinds = {r["doc_id"]: r["kind"] for r in docs.collect()}
    right = [classifier.domains[r["k"] - 1] == kinds[r["id"]] for r in best if r["id"] % 2 == 0]
    assert sum(right) / len(right) > 0.97


def test_held_out_accuracy_on_the_documents_table(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = M.label_domain(spark.read.parquet(f"{d}/labels.parquet"))
    members, _, classifier = M.rates(docs, labels.filter("id % 4 > 0"))
    best = members.select("id", F.array_position("p", F.array_max("p")).alias("k"))
    test = best.join(labels.filter("id % 4 = 0"), "id").collect()
    right = [classifier.domains[r["k"] - 1] == r["domain"] for r in test]
    majority = max(sum(r["domain"] == x for r in test) for x in classifier.domains)
    print(sum(right) / len(right), majority / len(test))
    assert sum(right) > majority + (len(test) - majority) / 2


def test_copies_follow_the_rates(spark):
    docs, labels = corpus(spark)
    targets = {"high": 0.9, "low": 0.1, "toxic": 0.0}
    members, *_ = M.rates(docs, M.label_domain(labels), targets)
    copies = {r["id"]: r["copies"] for r in members.collect()}
    rate = {r["id"]: r["rate"] for r in members.collect()}
    assert all(abs(copies[i] - rate[i]) < 1 for i in copies)
    mixed = M.mix(docs, M.label_domain(labels), targets)
    assert mixed.columns == docs.columns
    got = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {i: c for i, c in copies.items() if c}
    kinds = {r["doc_id"]: r["kind"] for r in docs.collect()}
    assert all(copies[i] >= 1 for i in copies if kinds[i] == "high")
    assert sum(copies[i] > 0 for i in copies if kinds[i] == "toxic") < 6


def test_odd_rows_and_missing_labels(spark):
    docs = docs_frame(spark)
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, None), (12, None, 1), (9, 1, 0),
                                 (12345, 0, 0)], LABELS)
    members, *_ = M.rates(docs, M.label_domain(odd))
    assert members.count() == docs.count()
    assert M.mix(docs, M.label_domain(odd)).columns == docs.columns
    none = M.label_domain(odd.limit(0))
    members, _, classifier = M.rates(docs, none)
    assert {tuple(round(x, 6) for x in r["p"]) for r in members.collect()} == {(0.333333,) * 3}
    empty = spark.createDataFrame([], DOCS_SCHEMA)
    assert M.rates(empty, none)[0].count() == 0 and M.mix(empty, none).count() == 0


def test_query_columns(spark):
    out = M.op1_source_mixing(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "tokens", "p_high", "p_low", "p_toxic", "rate", "copies"]
    assert out.count() == 200


def soft(spark, n=4000):
    """Members whose memberships are soft: the first targets are met by large rates of few."""
    draw = np.random.default_rng(1)
    p = draw.dirichlet(np.array([0.6, 0.25, 0.15]) * 9, n)
    t = draw.integers(20, 500, n)
    rows = [(int(a), [float(x) for x in b]) for a, b in zip(t, p)]
    return t.astype(float), p, spark.createDataFrame(rows, "tokens long, p array<double>").repartition(2).cache()


def test_production_targets():
    assert M.TARGETS == {"high": 0.90, "low": 0.07, "toxic": 0.03} and M.TOLERANCE <= 1e-6


def test_soft_memberships_meet_reachable_targets(spark):
    t, p, members = soft(spark)
    steps = M.fit_rates(members, [0.90, 0.07, 0.03])
    rate = members.select(M.rate_column(F.col("p"), steps).alias("r"), "tokens", "p").collect()
    totals = sum(r["r"] * r["tokens"] * np.array(r["p"]) for r in rate)
    assert np.abs(totals / t.sum() - [0.90, 0.07, 0.03]).max() <= 1e-6


def test_out_of_reach_the_projected_gradient_vanishes_and_the_gap_is_told(spark):
    t, p, members = soft(spark)
    wanted = np.array([0.2, 0.0, 0.8]) * t.sum()
    with pytest.warns(UserWarning, match="off by"):
        steps = M.fit_rates(members, [0.2, 0.0, 0.8])
    r = np.maximum(0, 1 - p @ np.sum(steps, axis=0))
    gradient = p @ np.linalg.pinv((p * t[:, None]).T @ p) @ ((r * t) @ p - wanted)
    assert gradient.min() >= -1e-3 and np.abs(gradient[r > 0]).max() <= 1e-3


def test_steps_without_an_end_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_SUMS", 3)
    with pytest.raises(RuntimeError, match="not settled"):
        M.fit_rates(soft(spark)[2], [0.90, 0.07, 0.03])

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tallyspark.llm import suffix_tree as S
from tests.llm.frames import DOCS_SCHEMA, doc_rows, docs_frame


def brute(rows, min_share):
    """The same model with plain dictionaries: (id, text) -> rows of the result."""
    docs = []
    for i, t in rows:
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
        docs.append((i, held, [*(t or "").encode().lower().split(), b""]))
    uni = Counter(w for _, h, ws in docs if not h for w in ws)
    n, v = sum(uni.values()), len(uni)
    nexts = {d: defaultdict(Counter) for d in range(1, S.MAX_DEPTH + 1)}
    for _, h, ws in docs:
        if not h:
            for j, w in enumerate(ws):
                for d in range(1, min(S.MAX_DEPTH, j) + 1):
                    nexts[d][tuple(ws[j - d:j])][w] += 1
    least = max(min_share * n, 1)
    states = {}
    for d in nexts:
        for c, follow in nexts[d].items():
            total = sum(follow.values())
            if total < least:
                continue
            up = uni if d == 1 else nexts[d - 1][c[1:]]
            up_total = sum(up.values())
            dev = cells = 0
            for w, k in follow.items():
                e = total * up[w] / up_total
                if max(k, e) >= S.MIN_CELL:
                    cells += 1
                    dev += 2 * (k * math.log(k / e) - (k - e))
            if cells and dev > cells + S.DEVIATIONS * math.sqrt(2 * cells):
                kept = {w: k for w, k in follow.items() if k >= S.MIN_NEXT}
                states[c] = (kept, total, sum(kept.values()))
    out = []
    for i, h, ws in docs:
        base = full = 0.0
        for j, w in enumerate(ws):
            p = (uni[w] + 1) / (n + v + 1)
            base += math.log10(p)
            for d in range(1, min(S.MAX_DEPTH, j) + 1):
                if tuple(ws[j - d:j]) in states:
                    kept, total, c2 = states[tuple(ws[j - d:j])]
                    p = (kept.get(w, 0) + (total - c2 + len(kept)) * p) / (total + len(kept))
            full += math.log10(p)
        out.append((i, h, len(ws), sum(uni[w] > 0 for w in ws), n, base, full))
    return out, states


def compare(frame, want):
    got = sorted((tuple(r) for r in frame.collect()), key=str)
    want = sorted(want, key=str)
    assert len(got) == len(want)
    key = lambda r: tuple(map(str, r[:5])) + (round(r[5], 4), round(r[6], 4))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9)
    return got


def test_odd_rows_match_brute_force(spark):
    rows = [r for r in doc_rows() if len(r[1] or "") < 5000]
    for i in range(300):    # the word after "m m" hangs on what stands three words back
        text = " ".join(f"{'pq'[(i * j) % 2]} m m {'xy'[(i * j) % 2]} u{(i * 7 + j * 3) % 11}" for j in range(12))
        rows.append((1000 + i, text, "en", "a", *rows[0][4:]))
    want, states = brute([r[:2] for r in rows], 0.005)
    assert {len(c) for c in states} == {1, 2, 3}
    compare(S.score(docs_frame(spark, rows), min_share=0.005, batch_tokens=2000, least_parts=9), want)


def test_support_stays_when_the_corpus_grows(spark):
    """A context seen often enough is a candidate however small its share of the corpus is."""
    rows = [(i, f"rare{i % 3} then{i % 3} " + " ".join(f"w{(i * j) % 89}" for j in range(60)))
            for i in range(400)]
    n = brute(rows, 1)[0][0][4]      # training tokens
    want, states = brute(rows, 50 / n)
    assert {c for c in states if c[0].startswith(b"rare")} and not brute(rows, 0.05)[1]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compare(S.score(docs, min_share=0.05, min_support=50, batch_tokens=3000, least_parts=9), want)
    assert S.MIN_SUPPORT <= 400


def test_documents_match_brute_force_and_beat_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want, states = brute(rows, S.MIN_SHARE)
    assert len(states) > 20
    got = compare(S.score(docs, batch_tokens=50_000, least_parts=16), want)
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_probabilities_of_a_state_sum_to_one():
    """Over the training vocabulary and the one unseen word that add-one leaves room for."""
    rows = [(i, f"a b{i % 3} a b0 c{i % 5}") for i in range(200)]
    _, states = brute(rows, 0.01)
    kept, total, c2 = max(states.values(), key=lambda s: s[1])
    assert abs((sum(kept.values()) + (total - c2 + len(kept)) * 1.0) / (total + len(kept)) - 1) < 1e-12


def test_no_training_documents_and_empty_table(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = spark.createDataFrame([(held, "a b"), (held, None)], "doc_id long, text string")
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                  for r in S.score(docs).collect()) == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert S.score(spark.createDataFrame([], DOCS_SCHEMA)).count() == 0


def test_query_columns(spark):
    out = S.op7_suffix_tree(spark, "/root/testdata/sf0.001")
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"),
                          ("n_known", "bigint"), ("train_tokens", "bigint"), ("base_score", "double"),
                          ("score", "double")]
    assert out.count() == 200


def test_numbers_of_pairs_with_and_without_room_for_positions():
    rng = np.random.default_rng(3)
    for keys in (rng.integers(0, 50, 1000), rng.integers(0, 1 << 62, 500).repeat(2), np.zeros(0, np.int64), np.array([7])):
        want, at = np.unique(keys, return_inverse=True)
        got, number = S.numbered(keys)
        assert got.tolist() == want.tolist() and number.tolist() == at.tolist()


def test_a_level_is_sorted_once_for_the_answers_of_all_partitions(monkeypatch):
    rng = np.random.default_rng(5)
    codes, ids = rng.integers(0, 9, 600), rng.permutation(9) - 4
    row = {"codes": S.packed(codes), "lens": [600], "held": [False],
           "words": S.packed_run(ids, np.bincount(codes, minlength=9))}
    none = pa.table({"level": pa.array([], pa.int32()), "blob": pa.array([], pa.binary()), "kinds": pa.array([], pa.int64())})
    level = S.Batch(row, none, 1, 1, 600).levels[0]
    context, word = level.ids[level.pairs // 9], ids[level.pairs % 9]
    order = np.lexsort((word, context))
    blobs = [S.packed_run(context[part], word[part], 1000 + part, 7000 + part)
             for part in (np.sort(order.reshape(-1)[i::20]) for i in range(20)) if len(part)]
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(S.np, "argsort", lambda *a, **k: sorts.append(1) or argsort(*a, **k))
    told = pa.table({"level": pa.array([1] * len(blobs), pa.int32()), "blob": pa.array(blobs, pa.binary()),
                     "kinds": pa.nulls(len(blobs), pa.int64())})
    got = S.Batch(row, told, 1, 1, 600).levels[0]
    assert len(blobs) == 20 and len(sorts) == 2              # of the words and of the contexts
    assert got.c.tolist() == (1000 + np.arange(len(order))).tolist()
    assert got.pair_ids.tolist() == (7000 + np.arange(len(order))).tolist()


def test_codes_by_first_occurrence():
    known = S.vocabulary()
    assert [known[w] for w in (b"x", b"y", b"x", b"", b"z")] == [1, 2, 1, 0, 3] and list(known) == [b"", b"x", b"y", b"z"]

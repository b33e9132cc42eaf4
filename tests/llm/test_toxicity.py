import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyspark.llm import noisy_channel as N
from tallyspark.llm import toxicity as T
from tests.llm.frames import DOCS_SCHEMA, docs_frame

SF = "/root/testdata/sf0.1"


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    model = T.fit(docs, labels)
    rows = {r["id"]: r for r in T.score(docs, model).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    return model, rows, truth, texts


def test_held_out_accuracy(fitted):
    """A tenth of the toxic labels lie on texts without any toxic word, which no text model can know."""
    _, rows, truth, _ = fitted
    held = [(rows[i]["score"], y) for i, y in truth.items() if is_held_out(i)]
    pos, neg = ([s for s, y in held if y == want] for want in (1, 0))
    assert len(pos) > 60 and len(neg) > 500
    auc = np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])
    predicted = [(s >= 0.5, y) for s, y in held]
    recall = sum(p for p, y in predicted if y) / len(pos)
    precision = sum(y for p, y in predicted if p) / max(1, sum(p for p, _ in predicted))
    print(f"held-out AUC {auc:.4f}, recall {recall:.4f}, precision {precision:.4f}")
    assert auc >= 0.9 and recall >= 0.8 and precision >= 0.98


def disguised(word, rnd):
    how = rnd.choice(["leet", "leet", "spaced", "dotted", "repeated", "mixed"])
    signs = {"o": "0", "i": "1!", "e": "3", "a": "4@", "s": "5$", "t": "7+", "l": "1"}
    if how in ("leet", "mixed"):
        at = [k for k, c in enumerate(word) if c in signs]
        at = set(rnd.sample(at, rnd.randint(1, min(3, len(at))))) if at else set()
        word = "".join(rnd.choice(signs[c]) if k in at else c for k, c in enumerate(word))
    if how in ("repeated", "mixed"):
        k = rnd.randrange(len(word))
        word = word[:k] + word[k] * rnd.randint(2, 5) + word[k + 1:]
    if how == "spaced":
        word = " ".join(word)
    return rnd.choice(".-_").join(word) if how == "dotted" else word


def test_disguised_words_are_found(spark, fitted):
    model, rows, truth, texts = fitted
    rnd, plain, hidden = random.Random(3), [], []
    for i, y in truth.items():
        if y == 1 and is_held_out(i) and rows[i]["words"] and rows[i]["score"] >= 0.5:
            text = texts[i]
            for w in rows[i]["words"]:
                text = re.sub(rf"(?i)\b{w}\b", lambda m: disguised(m[0].lower(), rnd), text)
            plain.append(i)
            hidden.append((i, text))
    found = T.score(spark.createDataFrame(hidden, "doc_id long, text string"), model).collect()
    recall = sum(r["score"] >= 0.5 for r in found) / len(hidden)
    print(f"{len(hidden)} disguised documents, recall {recall:.4f}")
    assert len(hidden) > 50 and recall >= 0.9


def test_clean_documents_stay_clean(fitted):
    _, rows, truth, _ = fitted
    clean = [i for i, y in truth.items() if y == 0 and is_held_out(i)]
    assert sum(rows[i]["score"] >= 0.5 for i in clean) <= len(clean) // 200


def test_decoding_is_the_best_of_all_readings():
    rng, rnd = np.random.default_rng(1), random.Random(2)
    restorer = N.Restorer(rng.uniform(0.1, 9.0, N.CELLS))

    def cost(letters):
        total, last = 0.0, 0
        for code in letters:
            if code == N.BREAK:
                total += restorer.cost[last * N.SIZE] if last else 0.0
                last = 0
            else:
                total += restorer.cost[last * N.SIZE + code]
                last = (last * N.SIZE + code) % N.SIZE ** 3
        return total + (restorer.cost[last * N.SIZE] if last else 0.0)

    for _ in range(60):
        text = "".join(rnd.choice("ab0é1-*x") * rnd.randint(1, 3) for _ in range(rnd.randint(1, 5)))
        runs = [N.readings(c, min(len(list(run)), 3)) for c, run in itertools.groupby(text)]
        best = min((sum(s for _, s in way) + cost([c for letters, _ in way for c, _ in letters]),
                    "".join(x or " " for letters, _ in way for _, x in letters)) for way in itertools.product(*runs))
        assert restorer._best(text).split() == best[1].split()


def test_character_counts_against_brute_force():
    texts = ["Hello wörld 42 it's", "", "  ", "日本 a", "x" * 50]
    want = Counter()
    for word in re.findall("[A-Za-z\x80-\U0010ffff]+", "\n".join(texts)):
        codes = [0, 0, 0, *[ord(c.lower()) - 96 if c.isascii() else N.OTHER for c in word], 0]
        want.update(tuple(codes[i:i + 4]) for i in range(len(codes) - 3))
    got = N.cell_counts("\n".join(texts).encode())
    cells = {tuple(int(x) for x in np.unravel_index(i, (N.SIZE,) * 4)): int(got[i]) for i in np.flatnonzero(got)}
    cells.pop((0, 0, 0, 0), None)       # nothing after nothing: the begin of an empty text
    assert cells == dict(want)
    p = np.exp(-N.costs(got).reshape(-1, N.SIZE).astype(float))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_units_hold_tokens_and_spaced_runs():
    assert N.units("a b  c\nnext d e f") == {"a", "b", "c", "next", "d", "e", "f", "a b c", "d e f"}
    assert N.units("x y word z") == {"x", "y", "word", "z"}
    restorer = N.Restorer(np.ones(N.CELLS))
    assert restorer.words("12 34") == () and restorer.words("Plain.") == ("plain",)


def test_only_texts_and_labels_that_are_not_held_out_count(spark):
    def own(i):
        return " ".join(f"q{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}v" for k in range(20))
    rows = [(i, f"awful{'' if i % 3 else ' nasty'} {own(i)}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learned = [(i, int(i % 3 == 0)) for i in range(200)]
    turned = [(i, 1 - y if is_held_out(i) else y) for i, y in learned]
    scores = []
    for labels in (learned, turned):
        model = T.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert set(model.weights) == {"nasty"}
        scores.append(sorted((r["id"], r["score"]) for r in T.score(docs, model).collect()))
    assert scores[0] == scores[1]
    assert all((s >= 0.5) == (i % 3 == 0) for i, s in scores[0])


def test_odd_rows_missing_labels_and_empty_tables(spark):
    docs = docs_frame(spark)
    labels = spark.createDataFrame([(1, None), (None, 1), (1, 0), (99, 1)], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    out = T.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    nothing = spark.createDataFrame([], DOCS_SCHEMA)
    assert T.score(nothing, T.fit(nothing, labels)).count() == 0
    assert T.fit(nothing, labels.limit(0)).bias == 0


def test_query_columns(spark):
    out = T.op13_toxicity(spark, "/root/testdata/sf0.001")
    assert out.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = out.collect()
    assert len(rows) == 200 and all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in rows)


def test_stretches_of_a_lattice_read_like_the_whole():
    rng = np.random.default_rng(5)
    restorer = N.Restorer(N.costs(N.cell_counts(b"the better letter is a little bitter than all that hello idiot stuff " * 9)))
    paths, path = [], restorer._path
    restorer._path = lambda text: paths.append(text) or path(text)
    for _ in range(4000):
        text = "".join(rng.choice(list("abeehillnosttu013@$!*-.\u00e9 "), rng.integers(1, 18)))
        assert restorer._best(text) == path(text)
    paths.clear()
    for word in ("xabollettered", "yabollettered", "qabollettereds"):
        restorer._best(word)
    assert paths == ["abollettere"]


def test_units_in_use_outlive_a_full_memory(monkeypatch):
    monkeypatch.setattr(T, "CACHED", 10)
    reader, calls = T.Reader(N.costs(np.zeros(N.CELLS, np.int64)), frozenset(["plain"])), []
    words = reader.restorer.words
    reader.restorer.words = lambda unit: calls.append(unit) or words(unit)
    for i in range(40):
        assert reader.words(f"plain w{i}x w{i}y w{i}z") == {"plain"}
    assert calls.count("plain") == 1 and len(calls) == 121 and len(reader.seen) + len(reader.older) <= 20

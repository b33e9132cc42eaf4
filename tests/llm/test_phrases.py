import random
import re
from collections import Counter

import numpy as np

from tallyspark.llm import phrases as P
from tallyspark.llm.hat_trie import HatTrie
from tests.llm.frames import DOCS_SCHEMA, docs_frame

COLUMNS = ["lang", "phrase", "a", "l", "r", "n", "score"]
LOWER = str.maketrans(P.UPPER, P.LOWER)


def brute(rows, max_words=3, min_count=10, percent=50):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, max_words + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    candidates = {key: c for key, c in f.items() if len(key[1]) > 1 and c >= min_count}
    out = []
    for (lang, ws), a in candidates.items():
        cuts = [(P.SCALE * a * a // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        held = any(lang == other and len(ls) > len(ws) and 100 * c >= percent * a
                   and any(ls[i:i + len(ws)] == ws for i in range(len(ls)))
                   for (other, ls), c in candidates.items())
        if not held:
            out.append((lang, " ".join(ws), a, f[lang, ws[:k]], f[lang, ws[k:]], n[lang], score))
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def texts(seed, docs=400):
    rnd = random.Random(seed)
    words = ["a", "B", "the", "cat", "Ä", "éa", "x-y", "日本", "w\x00", "end\xa0"]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", "!", " , ", "\r\n", ";"]
    return [("".join(rnd.choice(words[:rnd.choice([3, 10])]) + rnd.choice(ends) for _ in range(rnd.randint(0, 80))),
             rnd.choice(["en", "de", None, "und"])) for _ in range(docs)]


def test_against_brute_force(spark):
    rows = texts(5) + [(None, "en"), ("", None), ("one two " * 40, "fr")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    want = brute(rows)
    assert len(want) > 60
    assert found(P.mine(docs, least_parts=7)) == want
    # many small batches
    assert found(P.mine(docs, batch_tokens=50, least_parts=3)) == want


def test_longer_phrases_and_other_limits(spark):
    rows = texts(9, 60)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    for words, count, percent in ((5, 4, 80), (2, 6, 50), (4, 2, 30)):
        assert found(P.mine(docs, max_words=words, min_count=count, contained_percent=percent, least_parts=4)) \
            == brute(rows, words, count, percent)


def test_odd_rows_and_empty_table(spark):
    rows = [(r["text"], r["lang"]) for r in docs_frame(spark).collect()]
    assert found(P.mine(docs_frame(spark), min_count=2, least_parts=3)) == brute(rows, min_count=2)
    assert P.mine(spark.createDataFrame([], DOCS_SCHEMA), least_parts=2).count() == 0


def test_first_of_each_language(spark):
    rows = texts(5)
    docs = spark.createDataFrame(rows, "text string, lang string")
    want = []
    for lang in sorted({r[0] for r in brute(rows)}):
        own = sorted((r for r in brute(rows) if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        want += [(lang, i, r[1]) for i, r in enumerate(own[:7], 1)]
    got = P.first_of_each(P.mine(docs, least_parts=5), 7)
    assert sorted(tuple(r) for r in got.select("lang", "rank", "phrase").collect()) == want


def test_trie_bursts_and_spills_whole_subtrees():
    rng = np.random.default_rng(2)
    width = 300
    numbers = np.concatenate([rng.integers(0, 200 * width, 60_000), rng.integers(0, width, 60_000) + 7 * width,
                              np.full(5000, 7 * width + 3)])
    rng.shuffle(numbers)
    trie = HatTrie(200 * width, width, burst=64, most=9_000)
    runs = []
    for part in np.array_split(numbers, 9):
        runs += list(trie.add(part))
        assert trie.entries() <= 9_000
    assert len(trie.leaves) > 100 and len(runs) > 5
    runs += list(trie.rest())
    assert trie.entries() == 0
    got = Counter()
    for keys, n in runs:
        assert (np.diff(keys) > 0).all()
        for k, c in zip(keys.tolist(), n.tolist()):
            got[k] += c
    assert got == Counter(numbers.tolist())


def test_runs_round_trip():
    rng = np.random.default_rng(4)
    prefix, word = np.sort(rng.integers(0, 1 << 60, 500)), rng.integers(0, 1 << 40, 500)
    assert (P.unpacked_run(P.packed_run(prefix, word, word + 1), 3) == np.stack([prefix, word, word + 1])).all()

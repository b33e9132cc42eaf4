import hashlib
import random

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tallyspark.llm import token_alignment as T
from tallyspark.llm.bpe_words import ByteBpe
from tallyspark.operators.materialize import materialize
from tests.llm.frames import DOCS_SCHEMA, doc_rows, docs_frame

PATH_A = public_tokenizers.path("byte_bpe_50k.json")
PATH_B = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["a▁b and more", "▁", "x ▁ y", "<|endoftext|> is text", "two  blanks", " lead", "tail ", "\n", "a\tb\t c", "日本 語🙂",
       "no\xa0break \xa0 space", "<0x41> <s> </s>", "don't we'll I'm", "é ́x", "\x00 nul \x01", "word" * 300,
       "tabs\t\tand\nlines\n\nhere", "1234567 89,0.1 --- ###", "﻿bom", "a\r\nb"]


def brute(rows):
    """Token by token: every A token against every B token."""
    a_model = Tokenizer.from_file(PATH_A)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    a_bytes = ByteBpe(PATH_A, special=False).token_bytes()

    def b_bytes(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(ids, size):
        ends = np.cumsum([len(size(i)) for i in ids]).tolist()
        return list(zip(ids, [0, *ends], ends))

    found, count = [], {}
    for i, text in rows:
        text = text or ""
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text)
        want = (" " + text).encode()
        if not text or b"".join(a_bytes[x] for x in a) != want or b"".join(map(b_bytes, b)) != want:
            found.append((i, [], [], "", []))
            continue
        a, b = spans(a, lambda x: a_bytes[x]), spans(b, b_bytes)
        links = [(x, y) for x, s, e in a for y, s2, e2 in b if s < e2 and s2 < e]
        for pair in links:
            count[pair] = count.get(pair, 0) + 1
        both = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for high in both:
            sides = (",".join(str(x) for x, _, e in side if low < e <= high) for side in (a, b))
            groups.append("|".join(sides))
            low = high
        found.append((i, a, b, ";".join(groups), links))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(((i, len(a), len(b), groups.count("|"), len(links), sum(count[p] == best[p[1]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                   for i, a, b, groups, links in found), key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("id", *COLUMNS).collect()), key=str)


def test_odd_texts_and_rows(spark):
    rows = [(r[0], r[1]) for r in doc_rows() if len(r[1] or "") < 5000] + list(enumerate(ODD, 100))
    docs = spark.createDataFrame([(i, t, *r) for (i, t), r in zip(rows, [doc_rows()[0][2:]] * len(rows))], DOCS_SCHEMA)
    assert found(T.align(docs, PATH_A, PATH_B)) == brute(rows)


def test_random_mixes_of_blanks(spark):
    rnd = random.Random(7)
    parts = ["a", "the", "é", "42", "!", "'s", "\n", "\t", " ", " ", " ", "\xa0", "日", "🙂", "▁", "\r\n", "\x85", "﻿", "x" * 9]
    rows = [(i, "".join(rnd.choices(parts, k=rnd.randint(0, 40)))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(T.align(docs, PATH_A, PATH_B)) == brute(rows)


def test_documents_in_small_blocks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 2500")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute(rows)
    assert found(T.align(docs, PATH_A, PATH_B)) == want
    blocks = materialize(T.blocks_of(docs.repartition(16), PATH_A, PATH_B))
    assert blocks.count() == 16
    rows = T.pair_rows(blocks)
    scores = T.pair_scores(rows)
    told = rows.join(scores.select("pair", "n_links", "is_best"), "pair")
    assert found(T.scored_documents(blocks, told.select("block", "at", "n_links", "is_best"))) == want


def test_postings_give_documents_and_links_of_a_pair(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    blocks = T.blocks_of(docs.repartition(4), PATH_A, PATH_B)
    opened = T.document_postings(blocks).groupBy("a", "b").agg({"id": "count", "times": "sum"})
    scores = T.pair_scores(T.pair_rows(blocks)).select("a", "b", "n_docs", "n_links")
    assert scores.count() > 1000
    assert sorted(map(tuple, opened.select("a", "b", "count(id)", "sum(times)").collect())) \
        == sorted(map(tuple, scores.collect()))


def test_planes_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 7, 64, 5000):
        key = np.unique(np.concatenate([rng.integers(0, 40 * n, 400), np.arange(n)]))
        pair, doc, times = key // n, key % n, rng.integers(1, 70, len(key))
        got = np.zeros((41, n), np.int64)
        for plane, p, d in T.postings(*T.planes(pair, doc, times, n), n):
            got[p, d] += 1 << plane
        want = np.zeros((41, n), np.int64)
        want[pair, doc] = times
        assert (got == want).all()


def test_query_columns_and_empty_table(spark):
    out = T.op11_token_alignment(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", *COLUMNS]
    assert out.count() == 200
    assert T.align(spark.createDataFrame([], DOCS_SCHEMA), PATH_A, PATH_B).count() == 0

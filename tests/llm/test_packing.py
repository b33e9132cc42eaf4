import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyspark.llm import packing as P
from tests.llm.frames import DOCS_SCHEMA, doc_rows, docs_frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts):
    """Every id lies in exactly one piece, sequences are gapless and within the window."""
    want, got, sequences = defaultdict(int), defaultdict(int), defaultdict(list)
    for i, t in texts:
        want[(i, tuple(ids_of(t)))] += 1
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[(r["id"], r["doc_tokens"])].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end and length > 0
            end += length
        assert end <= P.WINDOW
    for (i, ids), copies in want.items():
        pieces = defaultdict(int)
        for r in by_doc[(i, len(ids))]:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
            if zlib.crc32(part) == r["ids_crc32"]:
                got[(i, ids)] += r["length"]
                pieces[r["start"], r["length"]] += 1
        assert got[(i, ids)] >= copies * len(ids)
    assert sum(r["length"] for r in rows) == sum(c * len(ids) for (_, ids), c in want.items())
    padding = 0
    for s in sequences.values():
        n = sum(x for _, x in s)
        padding += 0 if n & (n - 1) == 0 else P.WINDOW - n
    return padding, len(sequences)


def test_odd_rows(spark):
    rows = P.pack(docs_frame(spark), PATH).collect()
    assert check(rows, [r[:2] for r in doc_rows()])[0] == 0
    starts = defaultdict(list)
    for r in rows:
        if r["id"] == 7:
            starts[r["start"]].append(r["length"])
    end = 0
    for s in sorted(starts):
        assert s == end
        end += starts[s][0]
    assert end == len(ids_of(doc_rows()[6][1]))


def test_documents_without_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    padding, sequences = check(P.pack(docs, PATH).collect(), texts)
    total = sum(len(ids_of(t)) for _, t in texts)
    assert padding == 0 and sequences <= total // P.WINDOW + 11


def test_query_columns(spark):
    out = P.op8_packing(spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == {c: "bigint" for c in (
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], DOCS_SCHEMA), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
def test_plans_place_every_rank_once(counts):
    h = np.zeros(65, np.int64)
    for n, c in counts.items():
        h[n] = c
    place = P.Placement(*P.plan_windows(h, 64))
    sequences, total = defaultdict(list), 0
    for n, c in counts.items():
        for r in range(c):
            parts = place.place(n, r, 0)
            end = 0
            for s, length, sequence, offset in parts:
                assert s == end
                end += length
                sequences[sequence].append((offset, length))
            assert end == n
            total += n
    full = 0
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        full += end == 64
        assert end & (end - 1) == 0  # full, or a power of two: no padding
    assert full == total // 64


def test_places_of_many_pieces_at_once():
    place = P.Placement(fills=[(4, 0, 5, 0, 0), (3, 0, 4, 7, 1), (1, 0, 9, 20, 3), (2, 0, 9, 30, 2)],
                        cuts=[(4, 5, 2, 1, 0, 2), (3, 4, 2, 1, 2, 0)])
    got = place.places(*map(np.array, ([3, 4, 1, 4, 3], [2, 4, 7, 6, 5], [0, 1024, 0, 2048, 5])))
    assert got.T.tolist() == [[0, 0, 3, 9, 1], [1, 1024, 4, 4, 0], [2, 0, 1, 27, 3], [3, 2048, 1, 21, 3], [3, 2049, 3, 10, 1],
                              [4, 5, 1, 23, 3], [4, 6, 2, 31, 2]]
    assert place.place(4, 6, 10) == [(10, 1, 21, 3), (11, 3, 10, 1)]
    assert P.Placement([], []).places(*np.zeros((3, 0), np.int64)).shape == (5, 0)


def test_least_squares_uses_most_of_an_even_histogram():
    h = np.full(1025, 1000, np.int64)
    h[0] = h[1024] = 0
    combos = P.combinations(np.arange(1, 1024))
    x = P.repeat_counts(combos, h)
    use = np.zeros(1025)
    for row, c in zip(combos, x):
        for n in row[row > 0]:
            use[n] += c
    assert (use <= h + 1e-6).all()
    assert use @ np.arange(1025) > 0.85 * (h @ np.arange(1025))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aé \n\t'sZ1# 　<|endoftext|>"), max_size=40))
def test_cached_words_give_the_library_ids(text):
    for encoder in ENCODERS:
        got = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "x  y", " x", "x ", "it's  'S", "᠎ ᠎ a"])
def test_special_strings_and_loose_blanks(text):
    for encoder in ENCODERS:
        got = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F), max_size=60))
def test_latin_texts(text):
    test_special_strings_and_loose_blanks(text)


def test_ids_of_the_documents_table():
    import duckdb
    for (text,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall():
        test_special_strings_and_loose_blanks(text)


BLANKS = [" ", "  ", "\t", "\t\t", "\xa0", " \xa0", "\xa0 ", "\n", "\n\n", " \n", "\r\n", "\u2003", "\x85", "\u180e", "\x1c"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["one", "42", "the", "é", "it's", "!", "x1", "日本"]), st.sampled_from(BLANKS)),
                max_size=12))
def test_mixed_blanks(parts):
    test_special_strings_and_loose_blanks("".join(word + blank for word, blank in parts))


@pytest.mark.parametrize("text", ["one \xa0 \xa0 two three\t\tfour\xa0five", "thecat \xa0 \xa0 cat 42\t\t\tacat\xa042"])
def test_blanks_whose_counts_cancel(text):
    test_special_strings_and_loose_blanks(text)


def test_many_texts_at_once_and_a_small_cache(monkeypatch):
    monkeypatch.setattr(P, "CACHE_BYTES", 2000)
    monkeypatch.setattr(P, "NEW_WORDS", 3)
    texts = ["", "a b c d e f g", " lead", "a b", "b <|endoftext|> a", "long words here again", "a b c", "x  y"] * 3
    encoder = P.Encoder(PATH)
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_many(texts)]
        assert got == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.size <= 2000


def test_plain_words_are_cut_beforehand():
    bpe = P.ByteBpe(PATH)
    words = ["the", "ea.", "rent.\nThesen", "555-9246", "LA!!\nAscirr", "ci\u00f3n,%%%", "\u00d3S2go", "_x_", "(a)b3.\nc",
             "<|endoftext", "\u00aa".join("ab"), "it's", "\u4e2d\u6587", "a\u00b2", "x\n\ny", "a\u0301"]
    plain = [w for w in words if P.plain(w)]
    assert plain == words[:10]
    ids, starts = bpe.plain_words(plain)
    for w, a, b in zip(plain, starts, starts[1:]):
        assert ids[a:b].tolist() == TOKENIZER.encode(" " + w, add_special_tokens=False).ids
    text = "first.\nWord " + " ".join(words)
    assert np.frombuffer(P.Encoder(PATH).encode(text), "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abXY\u00e9\u00d109.,!$\n'\u00b2-_", min_size=1, max_size=9), min_size=1, max_size=8))
def test_words_of_letters_digits_and_signs(words):
    text = " ".join(words)
    assert np.frombuffer(ENCODERS[0].encode(text), "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_words_in_use_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(P, "CACHE_BYTES", 8000)
    encoder, calls = P.Encoder(PATH), []
    encode = encoder.bpe.plain_words
    encoder.bpe.plain_words = lambda words: calls.extend(words) or encode(words)
    for i in range(60):
        encoder.encode("x common words " + " ".join(f"w{i}n{j}" for j in range(9)))
    assert calls.count("common") == 1 and len(calls) == 60 * 9 + 3
    assert len(encoder.cache) + len(encoder.older) < 2 * 8000 // P.ENTRY_BYTES


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abZ\u00c9\u024f\u0250\u00d7\u00f719.'!~\n\t\u4e2d"), max_size=8), max_size=8))
def test_plain_words_of_a_column(words):
    assert P.are_plain(pa.array(words, pa.large_string())).tolist() == [P.plain(w) for w in words]


def test_words_are_remembered_in_bounded_bytes(monkeypatch):
    monkeypatch.setattr(P, "CACHE_BYTES", 1000)
    encoder, texts = P.Encoder(PATH), ["a " + "long" * 300, *(f"x and {i} of w{i}" for i in range(40)), "a of " + "y" * 900]
    for many in ([texts], [[t] for t in texts]):
        for part in many:
            got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_many(part)]
            assert got == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in part]
            assert encoder.size <= 1000 and len(encoder.cache) <= 4 and len(encoder.older) <= 4
            assert len(encoder.cache.starts) == len(encoder.cache) + 1 and encoder.cache.starts[-1] == len(encoder.cache.ids)


def test_parts_are_bounded_by_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(P, "TEXTS", 3)
    monkeypatch.setattr(P, "TEXT_BYTES", 10)
    texts = ["a" * n for n in (1, 1, 1, 1, 25, 4, 6, 1, 0, 0, 0, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    got = [list(map(len, p.column("text").to_pylist())) for p in P.parts_of(batch)]
    assert got == [[1, 1, 1], [1], [25], [4, 6], [1, 0, 0], [0, 0]]


ENCODERS = [P.Encoder(PATH)]

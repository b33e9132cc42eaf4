import public_tokenizers
import sentencepiece

from tallyspark.llm import token_counts as T
from tests.llm.frames import DOCS_SCHEMA, LONG, doc_rows, docs_frame

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["a" * 5000, "é" * 700 + "x" * 900, "日本語テキスト " * 300, "🙂🙃" * 400, "<s> </s> <unk> <0x0A>" * 80,
       "  lead  and   runs  " * 90, "\n\n\t" * 500, "ab" * 3000 + " " + "cd" * 3000, "́" * 600,
       "ßäöü\r\n" * 300, " " * 2000, "word" * 1000 + LONG[:3000]]


def brute(rows):
    return sorted(((i, len((t or "").encode()), len(MODEL.encode(t or ""))) for i, t in rows), key=str)


def found(frame):
    return sorted(((r["id"], r["n_bytes"], r["n_tokens"]) for r in frame.collect()), key=str)


def test_odd_rows_whole(spark):
    assert found(T.token_counts(docs_frame(spark), PATH)) == brute([r[:2] for r in doc_rows()])


def test_small_chunks_are_spliced_to_the_whole_count(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, ODD[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk, overlap in ((64, 8), (50, 3), (700, 40)):
        assert found(T.token_counts(docs, PATH, chunk=chunk, overlap=overlap)) == brute(rows)


def test_documents_in_small_chunks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(T.token_counts(docs, PATH, chunk=500, overlap=30)) == brute(rows)


def test_boundaries_are_code_points_and_agree_with_the_ids():
    pieces = T.Pieces(PATH)
    for text in [*ODD, "Ünïcode ÄÖ ü 日本 x"]:
        at, n = pieces.ends(text)
        assert at[-1] == len(text) and n[-1] == len(MODEL.encode(text))
        for a, k in list(zip(at, n))[:200]:
            if pieces.stable(text, int(a)):
                left, right = MODEL.encode(text[:a]), MODEL.encode(text)
                assert right[:k] == left


def test_query_and_empty_table(spark):
    out = T.op4_token_counts(spark, "/root/testdata/sf0.001")
    assert [c for c, _ in out.dtypes] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in out.collect())
    assert T.token_counts(spark.createDataFrame([], DOCS_SCHEMA), PATH).count() == 0

"""Token counts with overlap resynchronisation for huge documents.

A text of up to CHUNK code points is encoded whole.  A longer one is cut into chunks that
overlap, the chunks are dealt over the tasks and encoded with offsets, and neighbours are
spliced at a boundary that both encodings have and that is *proven* stable: no piece of the
vocabulary contains the two characters that meet there next to each other, so no merge can ever
span it, whatever stands to the left or right; left of it and right of it the encodings are
those of the whole text.  Where two neighbours share no such boundary (alignment fails), the
document is cut again with a wider overlap and longer chunks, until at last it is one chunk.

Only the boundaries inside the overlaps travel, with the number of tokens before them, so the
splice of a document handles a few numbers for each chunk.

Defined results: NULL text counts as empty (no tokens); repeated rows each give a row; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.text import text_key
from tallyspark.operators.materialize import materialize, materialize_observed

CHUNK = 1 << 15          # code points encoded at a time
OVERLAP = 1 << 8         # code points that two neighbours share at first
WIDEN = 8                # by which chunk and overlap grow where alignment fails
LIMIT = 4096


class Pieces:
    """A sentencepiece model and the pairs of characters that stand together in a piece."""

    def __init__(self, model_file: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.joined = set()
        for i in range(self.model.get_piece_size()):
            if not (self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i)):
                piece = self.model.id_to_piece(i).replace("▁", " ")
                self.joined.update(piece[j:j + 2] for j in range(len(piece) - 1))

    def count(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def ends(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """For each token that begins a new character: its begin (code points) and the number
        of tokens before it; closed by the length of the text and the number of all tokens."""
        begins = [b for b, _ in self.model.encode_as_offset_mapping(text)["offsets"]]
        at = np.array([*begins, len(text)], np.int64)
        n = np.arange(len(at))
        first = np.concatenate([[True], at[1:] != at[:-1]])
        return at[first], n[first]

    def stable(self, text: str, at: int) -> bool:
        return 0 < at < len(text) and text[at - 1:at + 1] not in self.joined


@lru_cache(maxsize=1)
def pieces_of(model_file: str) -> Pieces:
    """One a worker process, which runs many tasks."""
    return Pieces(model_file)


def chunk_rows(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """One row per chunk of each text: row key columns, chunk_no, begin, text of the chunk.
    Chunk i starts at i * chunk and runs ``overlap`` beyond the start of the next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                key, text = b.column("key")[i], b.column("text")[i].as_py()
                parts = max(1, -(-(len(text) - overlap) // chunk))
                for k in range(parts):
                    end = len(text) if k == parts - 1 else (k + 1) * chunk + overlap
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()], pa.binary()), pa.array([k], pa.int32()),
                         pa.array([k == parts - 1]), pa.array([k * chunk], pa.int64()),
                         pa.array([text[k * chunk:end]])],
                        ["key", "chunk_no", "last", "begin", "text"])
    return texts.mapInArrow(run, "key binary, chunk_no int, last boolean, begin long, text string")


BOUNDARIES = "array<struct<at:long,n:long>>"


def encoded_chunks(chunks: DataFrame, model_file: str, overlap: int) -> DataFrame:
    """Per chunk: the proven boundaries in the overlap with the chunk before (head) and with the
    chunk after (tail), as positions in the document with the tokens before them in the chunk,
    and the tokens of the whole chunk."""
    schema = (f"key binary, chunk_no int, last boolean, head {BOUNDARIES}, tail {BOUNDARIES}, n long")
    pair = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_file)
        for b in batches:
            for i in range(b.num_rows):
                text, begin = b.column("text")[i].as_py(), b.column("begin")[i].as_py()
                at, n = pieces.ends(text)

                def within(low: int, high: int) -> list[dict]:
                    inside = np.flatnonzero((at > low) & (at < high))
                    return [{"at": begin + int(at[j]), "n": int(n[j])} for j in inside
                            if pieces.stable(text, int(at[j]))]
                row = b.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [row.column("key"), row.column("chunk_no"), row.column("last"),
                     pa.array([within(0, overlap)], pair),
                     pa.array([within(len(text) - overlap, len(text))], pair),
                     pa.array([int(n[-1])], pa.int64())],
                    ["key", "chunk_no", "last", "head", "tail", "n"])

    return chunks.mapInArrow(run, schema)


def spliced(chunks: DataFrame) -> DataFrame:
    """(key, n_tokens) of each document; n_tokens is NULL where two neighbours don't align."""
    order = Window.partitionBy("key").orderBy("chunk_no")
    pairs = chunks.withColumn("next_head", F.lead("head").over(order))
    common = F.filter("tail", lambda x: F.exists("next_head", lambda y: y["at"] == x["at"]))
    cut = F.get(common, 0)
    here = F.filter("next_head", lambda y: y["at"] == cut["at"])
    joint = F.when(F.col("last"), F.col("n")).otherwise(cut["n"] - F.get(here, 0)["n"])
    # a chunk counts up to the cut with its successor; what the successor has before it is taken off
    return (pairs.select("key", joint.alias("part"))
            .groupBy("key").agg(F.when(F.count("part") == F.count(F.lit(1)),
                                       F.sum("part")).alias("n_tokens")))


def huge_counts(texts: DataFrame, model_file: str, chunk: int = CHUNK, overlap: int = OVERLAP
                ) -> DataFrame:
    """(key, n_tokens) of texts (key, text), encoded in overlapping chunks."""
    done = None
    while True:
        chunks = chunk_rows(texts, chunk, overlap).repartition("key", "chunk_no")
        found, seen = materialize_observed(spliced(encoded_chunks(chunks, model_file, overlap)),
                                           F.count(F.lit(1)).alias("rows"),
                                           F.count("n_tokens").alias("aligned"))
        good = found.filter("n_tokens IS NOT NULL")
        done = good if done is None else done.unionByName(good)
        if seen["aligned"] == seen["rows"]:
            return done
        failed = found.filter("n_tokens IS NULL").select("key")
        texts = texts.join(failed, "key", "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id",
                 text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens."""
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    rows = rows.withColumn("huge", F.char_length("text") > chunk + overlap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_file)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("n_bytes"),
                     pa.array(pieces.count(part.column("text").to_pylist()), pa.int64())],
                    ["id", "n_bytes", "n_tokens"])

    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    small = (rows.filter(~F.col("huge")).select("id", n_bytes, "text")
             .mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long"))
    big = rows.filter("huge").withColumn("key", text_key(F.col("text")))
    # a huge text that is repeated is encoded once
    texts = materialize(big.select("key", "text").dropDuplicates(["key"]))
    counts = huge_counts(texts, model_file, chunk, overlap)
    large = big.select("id", n_bytes, "key").join(counts, "key").select("id", "n_bytes", "n_tokens")
    return small.unionByName(large)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counts = token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                         (F.col("n_tokens") > LIMIT).alias("over_limit"))

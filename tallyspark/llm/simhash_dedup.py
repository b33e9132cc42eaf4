"""SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint bit is the majority of that bit over the XXH64 hashes of the text's word
shingles.  Two fingerprints are linked when they differ in at most RADIUS bits.

Covering tables: bit position i gets a non-zero vector m(i) of RADIUS+1 bits; table v (a
non-zero vector too) keeps the positions with <m(i), v> = 1 over GF(2).  Any RADIUS positions
span at most RADIUS dimensions, so some v is orthogonal to all of them: in that table the
differing positions are masked away and the pair meets.  No pair within the radius is lost,
for 2^(RADIUS+1)-1 tables of about half the bits.

Equal fingerprints are one node.  A bucket is searched breadth-first: a popped node is
compared with the nodes not reached yet, and only the reaching edge is given out, so a bucket
of k nodes gives at most k-1 edges and a dense bucket takes few comparisons.  A bucket beyond
HOT_BUCKET nodes is dealt out again: of RADIUS+1 blocks of its masked bits a linked pair
agrees in one, which gives RADIUS+1 narrower tables for those nodes alone.  Components are
found on the distributed edges.

Defined results: NULL or blank text has fingerprint zero, linked like any other; NULL ids are
never a component's id unless it has no other; repeated rows each give a row (``keep_one``
leaves one row of a component); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.components import components
from tallyspark.llm.runs import sorted_runs
from tallyspark.llm.text import as_they_are, columns_free_of, text_key
from tallyspark.operators.materialize import materialize, materialize_observed

SHINGLE_WORDS = 4
HASH_SEED = 42
RADIUS = 4
BITS = 64
HOT_BUCKET = 8192
SLICE = 1 << 16      # shingles hashed and counted at a time


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint as an unsigned 64-bit number; bytes methods know ASCII only, which is
    the lower-casing and the blanks wanted here."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle_words, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), SLICE):
        part = np.array([digest(line[s:e], HASH_SEED)
                         for s, e in zip(starts[at:at + SLICE], ends[at:at + SLICE])], np.uint64)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    majority = 2 * ones > len(starts)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """id, key (digest of the text), fp (the fingerprint's bits as a signed long)."""
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"),
                       F.col(text_col).cast("binary").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, key binary, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            fps = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("key"), pa.array(fps.view(np.int64))],
                ["id", "key", "fp"])

    return rows.mapInArrow(run, schema)


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    vectors = [1 + i % ((1 << (radius + 1)) - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vectors[i] & v).bit_count() & 1)
            for v in range(1, 1 << (radius + 1))]


def narrower_masks(mask: int, radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The mask with one of radius+1 blocks of the positions it leaves out added."""
    free = [i for i in range(bits) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[j::radius + 1]) for j in range(radius + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def dealt(nodes: DataFrame, masks) -> DataFrame:
    """Each node under every table's key; ``masks`` is a column of (table, mask) structs."""
    rows = nodes.select("fp", F.explode(masks).alias("m"))
    return rows.select(F.col("m.t").alias("t"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"),
                       "fp")


def _mask_structs(masks: list[tuple[int, int]]):
    return F.array(*(F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).cast("long").alias("mask"))
                     for t, m in masks))


def reached(fps: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Edges (from, to) of a breadth-first forest over the nodes within ``radius`` bits."""
    nodes = np.unique(fps)
    src, dst = [], []
    if len(nodes) == 2:
        if (int(nodes[0]) ^ int(nodes[1])).bit_count() <= radius:
            src.append(int(nodes[0])), dst.append(int(nodes[1]))
        return src, dst
    left = nodes
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                new = left[near]
                left = left[~near]
                queue.extend(new)
                src.extend([int(x)] * len(new))
                dst.extend(new.tolist())
    return src, dst


def _search(hot: int | None, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v, t = [], [], []
        for rows, whole in sorted_runs(batches, ["t", "key"], hot):
            fps = rows.column("fp").to_numpy()
            if whole:
                a, b = reached(fps.view(np.uint64), radius)
                u += a
                v += b
                t += [None] * len(a)
            else:
                u += fps.view(np.uint64).tolist()
                v += u[-len(fps):]
                t += rows.column("t").to_pylist()
            if len(u) > 20_000:
                yield _edges(u, v, t)
                u, v, t = [], [], []
        yield _edges(u, v, t)
    return run


def _edges(u, v, t) -> pa.RecordBatch:
    cols = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (u, v)]
    return pa.RecordBatch.from_arrays([*cols, pa.array(t, pa.int32())], ["u", "v", "t"])


def links(nodes: DataFrame, radius: int = RADIUS, hot: int = HOT_BUCKET) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints linked within ``radius`` bits."""
    def searched(rows: DataFrame, most: int | None) -> DataFrame:
        rows = rows.repartition("t", "key").sortWithinPartitions("t", "key")
        return rows.mapInArrow(_search(most, radius), "u long, v long, t int")

    masks = covering_masks(radius)
    found, seen = materialize_observed(
        searched(dealt(nodes, _mask_structs(list(enumerate(masks)))), hot),
        F.count("t").alias("deferred"))
    edges = found.filter("t IS NULL").select("u", "v")
    if seen["deferred"]:
        again = found.filter("t IS NOT NULL").select("t", F.col("u").alias("fp")).distinct()
        finer = [F.when(F.col("t") == t, _mask_structs(
            [(t * (radius + 1) + j, m) for j, m in enumerate(narrower_masks(mask, radius))]))
            for t, mask in enumerate(masks)]
        rows = again.select("fp", F.explode(F.coalesce(*finer)).alias("m"))
        rows = rows.select(F.col("m.t").alias("t"),
                           F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"), "fp")
        edges = edges.unionByName(materialize(searched(rows, None)).select("u", "v"))
    return edges


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, radius: int):
    """(id, key, fp) of the documents, and (fp, component_id, keeper) of the fingerprints."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle_words))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("key")))
    nodes = materialize(prints.groupBy("fp").agg(first.alias("first")))
    roots = components(links(nodes.select("fp"), radius))
    r = roots.select(F.col("node").alias("fp"), "root")
    nodes = (nodes.join(r, "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    tops = nodes.groupBy("root").agg(F.min("first").alias("top"))
    return prints, materialize(nodes.join(tops, "root").select(
        "fp", F.col("top.id").alias("component_id"), F.col("top").alias("keeper")))


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per document: id, fp, component_id."""
    prints, groups = grouped(docs, id_col, text_col, shingle_words, radius)
    return prints.join(groups, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component (its smallest id), with all
    their columns."""
    columns = docs.columns
    prints, groups = grouped(docs, id_col, text_col, shingle_words, radius)
    n = columns_free_of(columns, "id_", "key_", "stay")
    keepers = groups.select(F.struct("keeper.id", "keeper.key").alias(n["stay"])).distinct()
    keyed = docs.withColumns({n["id_"]: F.col(id_col), n["key_"]: text_key(F.col(text_col))})
    kept = keyed.join(keepers, F.col(n["id_"]).eqNullSafe(F.col(n["stay"])["id"])
                      & (F.col(n["key_"]) == F.col(n["stay"])["key"]), "left_semi")
    repeated = prints.groupBy("id", "key").count().filter("count > 1")
    if not repeated.isEmpty():  # the staying row itself may be repeated
        kept = kept.dropDuplicates([n["id_"], n["key_"]])
    return kept.select(*as_they_are(columns))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return components_of(docs).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

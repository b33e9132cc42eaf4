import random
import re

import pyarrow as pa
import xxhash
from hypothesis import given
from hypothesis import strategies as st

from tallyspark.llm import simhash_dedup as S
from tallyspark.llm.components import components
from tallyspark.llm.runs import sorted_runs
from tests.llm.frames import DOCS_SCHEMA, doc_rows, docs_frame


def plain_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    """rows of (id, text) -> sorted (id, fingerprint, component)."""
    fps = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    up = {f: f for f in distinct}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 4:
                up[root(a)] = root(b)
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return sorted(((i, f, least.get(root(f))) for (i, _), f in zip(rows, fps)), key=str)


def found(frame):
    return sorted(((r["id"], r["fp"] % 2**64, r["component_id"]) for r in frame.collect()), key=str)


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_every_pair_within_the_radius_meets_in_a_table(x, flips):
    y = x ^ sum(1 << i for i in flips)
    met = [m for m in S.covering_masks() if x & m == y & m]
    assert met
    assert any(x & w == y & w for m in met for w in S.narrower_masks(m))


@given(st.text(st.sampled_from("aB é\t\nw "), max_size=200))
def test_fingerprint_matches_the_definition(text):
    assert S.fingerprint(text.encode()) == plain_fingerprint(text)


def test_odd_rows_match_brute_force(spark):
    assert found(S.components_of(docs_frame(spark))) == brute([r[:2] for r in doc_rows()])


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert found(S.components_of(docs)) == want
    out = S.op5_simhash_dedup(spark, "/root/testdata/sf0.001").collect()
    assert sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in out), key=str) == want
    assert {len(r["fingerprint"]) for r in out} == {16}


def test_dense_bucket_beyond_the_hot_limit_loses_no_link(spark):
    """Several hundred fingerprints around one centre, searched with a tiny hot limit."""
    rng = random.Random(3)
    fps = {0}
    while len(fps) < 400:
        fps.add(sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))))
    nodes = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    edges = S.links(nodes, hot=20)
    root = {r["node"]: r["root"] for r in components(edges).collect()}
    got = {}
    for f in fps:
        got.setdefault(root.get(S._signed(f), S._signed(f)), set()).add(f)
    left, want = set(fps), []
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            x = todo.pop()
            group.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= 4}
            left -= near
            todo += near
        want.append(group)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(200, 260)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "u long, v long")
    root = {r["node"]: r["root"] for r in components(frame).collect()}
    assert {root.get(i, i) for i in range(100, 161)} == {100}
    assert {root.get(i, i) for i in [*range(200, 260), 500]} == {200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@given(st.lists(st.integers(0, 5), max_size=60), st.integers(1, 9), st.one_of(st.none(), st.integers(2, 4)))
def test_sorted_runs_hand_out_every_row_of_a_run(keys, size, most):
    keys = sorted(keys)
    batches = [pa.RecordBatch.from_pydict({"k": keys[i:i + size]}) for i in range(0, len(keys), size)]
    got = {}
    for rows, whole in sorted_runs(iter(batches), ["k"], most):
        ks = rows.column("k").to_pylist()
        assert len(set(ks)) == 1
        assert whole == (most is None or keys.count(ks[0]) <= most)
        got[ks[0]] = got.get(ks[0], 0) + len(ks)
    assert got == {k: keys.count(k) for k in set(keys) if keys.count(k) > 1}


def test_keep_one_of_each_component(spark):
    docs = docs_frame(spark)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in brute([r[:2] for r in doc_rows()])}
    ids = [r["doc_id"] for r in kept.collect()]
    # id 9 stands for two texts of different components: both stay
    assert sorted(ids, key=str) == sorted([*want, 9], key=str)
    assert S.keep_one(spark.createDataFrame([], DOCS_SCHEMA)).count() == 0

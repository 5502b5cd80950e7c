"""Hard negatives, the digest index and the Merkle manifest on awkward rows and against plain versions."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnflow.llm import exact_dedup as E
from txnflow.llm import hard_negatives as N
from txnflow.llm import merkle_manifest as M
from txnflow.session import work_folder

VECTORS = "vec_id long, label int, embedding array<float>"


# --- hard negatives ---
def mined(rows, anchors, positives=5, negatives=10):
    """Plain version over (vec_id, label, vector)."""
    q = [(i, label, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, label, v in rows]
    for a, of, v in (r for r in q if r[0] in anchors):
        scored = sorted((-int(v @ w), i, label) for i, label, w in q if i != a)
        for p, pos, _ in [s for s in scored if s[2] == of][:positives]:
            fit = [(s, i) for s, i, label in scored if label != of and 30 * -p <= 100 * -s <= 90 * -p]
            for rank, (s, neg) in enumerate(fit[:negatives], 1):
                yield a, pos, rank, neg, -p, -s


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("dims", [1, 8, 13, 64])
def test_scores_equal_inner_products(dims):
    rng = np.random.default_rng(dims)
    for spread in (3, 300, 1 << 22):
        width = -(-dims // 8) * 8
        a, c = (np.zeros((n, width), np.int32) for n in (7, 50))
        a[:, :dims], c[:, :dims] = (rng.integers(-spread, spread, x[:, :dims].shape) for x in (a, c))
        want = c.astype(np.int64) @ a.astype(np.int64).T
        assert (N.scores(N.subset_sums(a), N.bit_planes(c)) == want).all()


def test_mining_against_a_plain_version(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(3, 20))
    rows = [(i, i % 3, (centres[i % 3] * 0.2 + rng.normal(size=20) * 0.15 + 0.1).astype(np.float32).tolist()) for i in range(300)]
    # Ties: the same vector under several ids and labels.
    rows += [(300 + i, i % 3, rows[0][2]) for i in range(9)]
    anchors = {r[0] for r in rows if r[0] % 10 == 0}
    small = N.MiningParams(anchors_per_block=8, rows_per_block=32, blocks_per_chunk=2)
    frame = N.mine_hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0, small)
    want = sorted(mined(rows, anchors))
    assert len(want) > 200
    assert found(frame) == want


def test_awkward_vectors(spark):
    rows = [
        (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 2, [0.5]), (3, 2, None), (4, None, [1.0, 1.0]), (None, 2, [1.0, 1.0]),
        (5, 2, [float("nan"), 1.0]), (6, 2, [float("inf"), 1.0]), (7, 2, [None, 1.0]), (8, 2, []), (9, 2, [1e30, 1.0]),
        (10, 2, [0.25, 0.5, 9.0]), (10, 2, [0.25, 0.5, 9.0]),
    ]
    frame = spark.createDataFrame(rows, VECTORS).withColumn("chunk", F.lit("x")).withColumn("n", F.lit("x"))
    got = found(N.mine_hard_negatives(frame, F.col("vec_id") == 0))
    # 2 scores 0.5, and both rows of 10 tie at 0.5 of the positive's 1.25.
    assert got == [(0, 1, 1, 2, 81920, 32768), (0, 1, 2, 10, 81920, 32768), (0, 1, 3, 10, 81920, 32768)]
    assert found(N.mine_hard_negatives(frame.limit(0), F.col("vec_id") == 0)) == []
    assert found(N.mine_hard_negatives(frame, F.lit(False))) == []


# --- exact dedup ---
def test_filter_keeps_every_digest_through_resizes_and_deletions():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 1 << 63, (5000, 4), dtype=np.uint64)
    rows = np.stack([np.ones(5000), np.arange(5000), np.arange(5000), np.ones(5000)], axis=1).astype(np.int64)
    shard = E.Shard()
    for at in range(0, 5000, 700):
        shard.merge(digests[at : at + 700], rows[at : at + 700])
    assert len(shard.filter.prints) > 64
    assert (shard.filter.find(digests, shard.digests) == np.arange(5000)).all()
    gone = rows[::3] * np.array([1, 1, 1, 0])
    shard.replace(digests[::3], gone)
    shard.compact()
    held = shard.filter.find(digests, shard.digests) >= 0
    assert (held == (np.arange(5000) % 3 > 0)).all()
    strange = rng.integers(0, 1 << 63, (5000, 4), dtype=np.uint64)
    assert (shard.filter.find(strange, shard.digests) == -1).all()
    # Equal prints and buckets, other digests: hits that do not verify.
    near = shard.digests.copy()
    near[:, 3] ^= np.uint64(1)
    assert (shard.filter.find(near, shard.digests) == -1).all()


def groups_of(rows):
    """Plain version over live (doc_id, text)."""
    out = []
    for d, t in rows:
        same = [e for e, u in rows if (u or "") == (t or "")]
        out.append((d, max((e for e in same if e is not None), default=None), len(same), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def check_groups(index, rows):
    got = index.groups().collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == groups_of(rows)
    # One row of each text stays, and it is the named one.
    kept = [(r["text_sha256"], r["doc_id"], r["keep_id"]) for r in got if r["kept"]]
    assert len(kept) == len({(t or "") for _, t in rows})
    assert all(d == k for _, d, k in kept)


def test_index_inserts_and_deletes(spark, odd_columns):
    index = E.DigestIndex(spark, work_folder(spark, "digests"))
    rows = [(r["doc_id"], r["text"]) for r in odd_columns.collect()]
    index.insert(odd_columns)
    check_groups(index, rows)
    more = [(5, "same words here again and again"), (20, "new"), (21, ""), (None, "new"), (None, "only without ids")]
    index.insert(spark.createDataFrame(more, "doc_id long, text string"))
    check_groups(index, rows + more)
    index.delete(spark.createDataFrame([(5,), (21,), (7,), (99,), (None,)], "doc_id long"))
    left = [(d, t) for d, t in rows + more if d not in (5, 21, 7)]
    check_groups(index, left)
    again = [(7, rows[-1][1]), (30, "new")]
    index.insert(spark.createDataFrame(again, "doc_id long, text string"))
    check_groups(index, left + again)


def test_index_over_many_shards_and_hot_text(spark, monkeypatch):
    monkeypatch.setattr(E, "ROWS_PER_SHARD", 50)
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 2}") for i in range(900)]
    index = E.DigestIndex(spark, work_folder(spark, "digests"))
    index.insert(spark.createDataFrame(rows[:500], "doc_id long, text string").repartition(3))
    index.insert(spark.createDataFrame(rows[500:], "doc_id long, text string").repartition(3))
    check_groups(index, rows)
    index.delete(spark.createDataFrame([(i,) for i in range(800, 900)], "doc_id long"))
    check_groups(index, rows[:800])


def test_unfinished_change_does_not_count(spark, documents):
    index = E.DigestIndex(spark, work_folder(spark, "digests"))
    assert index.groups().collect() == []
    index.insert(documents([]))
    assert index.groups().collect() == []
    index.insert(documents([(1, "a")]))
    # A change that failed after its rows were written.
    index._write(documents([(9, "b")]).selectExpr("doc_id", "1L as row_id", "unhex('00') as digest"), "rows", 2)
    check_groups(index, [(1, "a")])
    index.insert(documents([(2, "a")]))
    check_groups(index, [(1, "a"), (2, "a")])


# --- Merkle manifest ---
def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, more=0):
    d, text, lang, source, n = doc
    values = (d, source, lang, None if n is None else n + more, text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root of a list of hashes, and each one's list of (before, after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(paths, at):
            p.append((nodes[i - 1], "") if i % 2 else ("", nodes[i + 1] if i + 1 < len(nodes) else ""))
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], paths


def manifest(docs):
    """Plain version: rows of op13 over (doc_id, text, lang, source, n_chars)."""
    langs = sorted({d[2] for d in docs}, key=lambda x: (x is not None, (x or "").encode()))
    subs, inner = [], []
    for lang in langs:
        own = sorted((d for d in docs if d[2] == lang), key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        sub, paths = tree([leaf(d) for d in own])
        subs.append(sub)
        inner.append((own, paths))
    root, tops = tree(subs)
    for (own, paths), sub, top in zip(inner, subs, tops):
        for d, path in zip(own, paths):
            changed = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0
            acc = leaf(d, 1 if changed else 0)
            for before, after in path + top:
                acc = h(before, acc, after)
            proof = h(*(b + a for b, a in path + top))
            yield d[0], leaf(d), sub, root, proof, acc, acc == root


def audited(docs):
    more = M.leaf(n_chars=F.col("n_chars").cast("decimal(20,0)") + 1)
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, more)
    return sorted((tuple(r) for r in M.audit(M.build_manifest(docs, claimed=claimed)).collect()), key=repr)


def rows_of(docs):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in docs.collect()]


def test_manifest_of_awkward_rows(spark, odd_columns):
    lang = F.when(F.col("doc_id") < 4, F.lit(None)).when(F.col("doc_id") == 7, "ä").otherwise(F.col("lang"))
    docs = odd_columns.withColumns({
        "lang": lang, "n_chars": F.when(F.col("doc_id") != 5, F.col("n_chars")),
        **{c: F.lit("x") for c in ("grp", "rank", "hash", "item", "block", "path", "kids", "d0", "claimed")},
    })
    assert audited(docs) == sorted(manifest(rows_of(docs)), key=repr)
    assert audited(docs.limit(0)) == []


@pytest.mark.parametrize("sizes", [(1,), (2, 3), (1, 5, 16), (17, 4, 64, 65)])
def test_manifest_over_several_rollups(spark, monkeypatch, sizes):
    # Four leaves to a block: up to four rollups, and last blocks of every length.
    monkeypatch.setattr(M, "BITS", 2)
    docs = [(100 * g + i, f"text {i}", f"l{g}", "s", i) for g, n in enumerate(sizes) for i in range(n)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = audited(frame)
    assert got == sorted(manifest(docs), key=repr)
    assert any(not r[-1] for r in got) == any(zlib.crc32(str(d[0]).encode()) % 7 == 0 for d in docs)


def test_many_languages_and_the_largest_count(spark, monkeypatch):
    monkeypatch.setattr(M, "BITS", 1)
    docs = [(i, "t", f"{i % 11}", None, (1 << 63) - 1) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    assert audited(frame) == sorted(manifest(docs), key=repr)


def test_rollup_of_a_block_takes_one_shuffle(spark, documents):
    nodes = documents([(1, "a")]).selectExpr("lang as grp", "n_chars as n", "doc_id as rank", "text as hash", "doc_id as item")
    plan = M._rolled_up(nodes, ("item",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1

"""Vector codes: against plain Lloyd rounds over all parts, in whole numbers."""
import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, part string, n string, error string, code string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "p", "n", "e", "c", "x") for i, v, lab in rows], SCHEMA)


def plain(rows, rounds=6, dims=None):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return Counter()
    dims = -(-max(len(v) for _, v, _ in kept) // 8) * 8
    w = dims // 8
    ints = [[math.floor(4096 * float(np.float32(x))) for x in v] + [0] * (dims - len(v)) for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, [float(np.float32(x)) for x in kept[k][1]]))[:16]
    books = [[ints[k][p * w:(p + 1) * w] for k in first] for p in range(8)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            members = {}
            for v in ints:
                members.setdefault(nearest(v[p * w:(p + 1) * w], books[p])[1], []).append(v[p * w:(p + 1) * w])
            for j, own in members.items():
                books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    found = [[nearest(v[p * w:(p + 1) * w], books[p]) for p in range(8)] for v in ints]
    error = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, lab), e in zip(kept, error):
        by_label[lab] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, "".join(f"{j:02x}" for _, j in f), e, by_label[lab], digest) for (i, _, lab), f, e in zip(kept, found, error))


def got(df):
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def vectors(n, seed, dims=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(9, dims))
    x = (centers[rng.integers(0, 9, n)] + 0.2 * rng.normal(size=(n, dims))).astype(np.float32)
    return [(int(i), row.tolist(), int(rng.integers(0, 4))) for i, row in enumerate(x)]


@pytest.mark.parametrize("dims,scale", [(1, 1.0), (3, 1e-3), (8, 1e6)])
def test_cover_tree_assigns_like_a_full_comparison(dims, scale):
    rng = np.random.default_rng(dims)
    for n in (1, 2, 25, 1500):
        points = np.floor(scale * np.concatenate([rng.normal(size=(n, dims)) * 50, np.repeat(rng.normal(size=(1, dims)), n, axis=0),
                                                  rng.integers(0, 3, size=(n, dims))])).astype(np.int64)
        tree = codes.CoverTree.build(points)
        assert sorted(tree.order.tolist()) == list(range(3 * n))
        own = points[tree.order]
        for node in range(len(tree.center)):      # every node covers its range, children share it out
            lo, hi = tree.first[node], tree.last[node]
            far = np.sqrt(((own[lo:hi] - points[tree.center[node]]) ** 2).sum(axis=1).astype(float)).max()
            assert far <= tree.radius[node] * (1 + 1e-9) + 1e-6
            kids = range(tree.child[node], tree.child[node] + tree.children[node])
            if kids:
                assert [tree.first[k] for k in kids] + [hi] == [lo] + [tree.last[k] for k in kids]
        tree = codes.CoverTree.unpack(tree.pack())
        for k in (1, 2, 16):
            book = points[rng.integers(0, len(points), k)]
            want = np.stack([((own - c) ** 2).sum(axis=1) for c in book], axis=1).argmin(axis=1)
            assert (tree.assign(own, book) == want).all()


def test_subtrees_are_given_away_whole(monkeypatch):
    rng = np.random.default_rng(2)
    points = (np.repeat(np.array([[0, 0], [100_000, 0]]), 4000, axis=0) + rng.integers(0, 50, (8000, 2))).astype(np.int64)
    tree = codes.CoverTree.build(points)
    seen = []
    real = codes.squared
    monkeypatch.setattr(codes, "squared", lambda a, b: seen.append(len(a)) or real(a, b))
    tree.assign(points[tree.order], np.array([[0, 0], [100_000, 0]]))
    assert sum(seen) < 50


@pytest.mark.parametrize("block", [5, 40, 2048])
def test_codes_against_plain_lloyd(spark, monkeypatch, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    monkeypatch.setattr(codes, "LEAF", 3)
    rows = vectors(300, 1) + [(7, vectors(1, 9)[0][1], None)] * 90 + [
        (None, vectors(1, 8)[0][1], 2), (400, None, 1), (401, [None] * 16, 1), (402, [float("nan")] * 16, 0),
        (403, [float("inf")] + [0.0] * 15, 0), (404, [-float("inf")] + [0.0] * 15, None), (405, [0.5] * 16, None), (-3, [0.5] * 16, None)]
    assert got(codes.codes(frame(spark, rows).repartition(5))) == plain(rows)


def test_few_vectors_uneven_lengths_and_salted_labels(spark, monkeypatch):
    monkeypatch.setattr(codes, "LABELS_BROADCAST", 0)
    monkeypatch.setattr(codes, "SALT_ROWS", 10)
    rows = [(i, [0.25 * i, -1.0, 3.5][:i % 4], None if i % 3 else 1) for i in range(60)]
    assert got(codes.codes(frame(spark, rows))) == plain(rows)
    assert got(codes.codes(frame(spark, rows[:3]))) == plain(rows[:3])


def test_large_components_are_bounded(spark):
    rows = [(i, [(-1) ** i * 3e38] * 16 if i % 2 else [float(i)] * 16, i) for i in range(20)]
    out = codes.codes(frame(spark, rows)).collect()
    assert len(out) == 20 and all(r.error >= 0 for r in out)


def test_empty_tables(spark):
    assert codes.codes(frame(spark, [])).collect() == []
    assert codes.codes(frame(spark, [(1, None, 3), (2, [float("nan")], 3)])).collect() == []
    assert got(codes.codes(frame(spark, [(1, [], 3)]))) == plain([(1, [], 3)])


def test_codes_of_the_embeddings(spark, sf_small):
    from tidemark.llm.queries import QUERIES, read
    rows = [(r.vec_id, r.embedding, r.label) for r in read(spark, sf_small, "embeddings").collect()]
    assert got(QUERIES["op13_vector_codes"](spark, sf_small)) == plain(rows)

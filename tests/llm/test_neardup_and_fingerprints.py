"""Operators 7 and 8 against exact similarities."""

import hashlib
import random
import statistics
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import dart, fingerprints, neardup
from tidemark.llm.common import read, written
from tidemark.llm.components import components

from .conftest import words


def test_dart_signatures_estimate_the_generalised_jaccard_similarity():
    rng = np.random.default_rng(2)
    for n, share, top in ((300, .1, 1), (300, .3, 5), (40, .3, 40), (2000, .05, 3), (1, 0, 1)):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b, wa = a.copy(), rng.integers(1, top + 1, n).astype(float)
        wb = wa.copy()
        new, heavier = rng.random(n) < share, rng.random(n) < share
        b[new] = rng.integers(0, 2**63, new.sum())
        wb[heavier] = rng.integers(1, top + 1, heavier.sum())
        both = np.minimum(wa, wb)[a == b].sum()
        want = both / (wa.sum() + wb.sum() - both)
        sig = dart.signatures(np.repeat([0, 1], n), np.concatenate([a, b]), np.concatenate([wa, wb]), 2, 2000)
        assert abs((sig[0] == sig[1]).mean() - want) < 0.05
        alone = dart.signatures(np.zeros(n, int), a, wa, 1, 2000)
        assert (alone[0] == sig[0]).all()       # a set's signature doesn't depend on its batch


def exact_classes(texts):
    """Union-find over all pairs, by the definition."""
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sets = []
    for t in texts:
        w = neardup.WORD.findall((t or "").lower())
        sets.append(Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter({("raw", t or ""): 1}))
    index = defaultdict(list)
    for i, s in enumerate(sets):
        near = Counter(j for g in s for j in index[g])
        for j in near:
            both = sum((s & sets[j]).values())
            if both >= 0.8 * (sum(s.values()) + sum(sets[j].values()) - both):
                root[find(i)] = find(j)
        for g in s:
            index[g].append(i)
    out = defaultdict(set)
    for i in range(len(texts)):
        out[find(i)].add(i)
    return {frozenset(x) for x in out.values()}


def classes_of(docs):
    out = defaultdict(set)
    for r in neardup.class_of_rows(written(neardup.classes(docs), "c")).collect():
        out[r.class_key].add(r.doc_id)
    return {frozenset(x) for x in out.values()}


def test_classes_of_the_documents(spark, sf_small):
    docs = read(spark, sf_small, "documents")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    want = {frozenset(rows[i].doc_id for i in c) for c in exact_classes([r.text for r in rows])}
    assert classes_of(docs) == want


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(21)

    def edit(text, rate):
        return [f"e{rng.randrange(10**9)}" if rng.random() < rate else w for w in text]

    base, far = words(rng, 150), words(rng, 150)
    rows = [base] + [edit(base, rng.choice([.01, .02, .03, .05])) for _ in range(120)]         # a group of near copies
    rows += [far] * 40 + [edit(far, .01) for _ in range(10)]
    chain = words(rng, 120)                                                                  # near its neighbours only
    for _ in range(8):
        chain = chain[2:] + words(rng, 2)
        rows.append(chain)
    shared = words(rng, 60)
    rows += [shared + words(rng, 60) for _ in range(40)]                                     # a passage in common: no copies
    rows += [words(rng, n) for n in (1, 2, 4, 5, 6, 30_000)] + [["same"]] * 2
    return [" ".join(r) for r in rows] + [None, "", "", "...", "Same!"]


def test_planted_groups(docs_of, planted):
    docs = docs_of(list(enumerate(planted)))
    want = {frozenset(c) for c in exact_classes(planted)}
    assert classes_of(docs) == want
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(min(c) for c in want)


def test_tiles_alone_find_every_link(docs_of, planted, monkeypatch):
    """Without any link from pivots, and with nobody excused as a pivot, the tiles give the same classes."""
    mixed, verified = neardup._mixed, neardup._verified
    monkeypatch.setattr(neardup, "TILE", 16)        # many tiles
    monkeypatch.setattr(neardup, "SIGNATURE_TILE", 32)
    monkeypatch.setattr(neardup, "_verified", lambda *a: verified(*a).limit(0))
    monkeypatch.setattr(neardup, "_mixed", lambda members, labels, pivots: mixed(
        members, labels, pivots.withColumn("pivot", F.lit(b""))))
    assert classes_of(docs_of(list(enumerate(planted)))) == {frozenset(c) for c in exact_classes(planted)}


def test_texts_of_unlike_members_stay_out_of_the_tiles(docs_of, monkeypatch):
    """300 texts that share most of their words, and six near copies of one: texts move for those near by signature only."""
    rng = random.Random(6)
    shared = words(rng, 185)
    texts = [" ".join(shared + words(rng, 115)) for _ in range(300)]
    texts += [texts[0] + f" x{i}" for i in range(6)]
    across, seen = neardup._across, {}

    def spy(rows, reps, met, threshold):
        tiles = neardup._tiles

        def count(some, reps, side):
            seen[side] = some.count()
            return tiles(some, reps, side)

        with monkeypatch.context() as m:
            m.setattr(neardup, "_tiles", count)
            return across(rows, reps, met, threshold)

    monkeypatch.setattr(neardup, "_across", spy)
    assert classes_of(docs_of(list(enumerate(texts)))) == {frozenset(c) for c in exact_classes(texts)}
    assert seen[neardup.TILE] * 10 < seen[neardup.SIGNATURE_TILE]


def test_near_duplicate_edges(docs_of):
    docs = docs_of([(1, "a b c d e f"), (1, "a b c d e f"), (1, "other text of five words"), (None, "A b, c d e f"), (None, "alone here now then there"), (2, None)])
    rows = neardup.class_of_rows(written(neardup.classes(docs), "c")).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in rows) == [
        ("1", "1", 1), ("1", "1", 3), ("1", "1", 3), ("2", "2", 1), ("None", "1", 3), ("None", "None", 1)]
    kept = neardup.keep_one(docs)
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [
        ("1", "a b c d e f"), ("1", "other text of five words"), ("2", "None"), ("None", "alone here now then there")]
    assert neardup.keep_one(docs.limit(0)).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert got == want


def test_fingerprints(spark, docs_of, planted):
    rng = random.Random(9)
    texts = planted + [" ".join(words(rng, 300)) for _ in range(60)] + ["é漢" * 40 + " " + " ".join(words(rng, 50, 0, 3))]
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs_of(rows)).collect()}
    errors, twins = [], defaultdict(set)
    for n, (i, t) in enumerate(rows):
        t, other = t or "", rows[(n + 1) % len(rows)][1] or ""
        edited = t[:len(t) - len(t) // 4] + other[:len(t) // 4]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(r.near_edited - neardup.similarity(t, edited))
        errors.append(r.near_next - neardup.similarity(t, other))
        twins[t].add(r.fingerprint)
        twins[edited].add(r.edited_fingerprint)
    assert all(len(x) == 1 for x in twins.values())
    assert abs(statistics.mean(errors)) < 0.02 and statistics.pstdev(errors) < 0.08


def test_weights_count(spark):
    rng = random.Random(1)
    few = words(rng, 40)
    a, b = " ".join(few * 6), " ".join(few * 2)     # the same shingles, other counts
    want = neardup.similarity(a, b)
    ones = spark.createDataFrame([(" ".join(few * 6 + [str(i)]), " ".join(few * 2 + [str(i)])) for i in range(1)], "a string, b string")
    bins = 512
    both = fingerprints.with_fingerprint(fingerprints.with_fingerprint(ones, "a", "x", bins), "b", "y", bins)
    near = both.select(fingerprints.likeness(F.col("x"), F.col("y"))).first()[0]
    assert 0.25 < want < 0.4 and abs(near - want) < 0.25


def test_next_over_many_ranges(spark, docs_of):
    """Ranges of about two rows, a third of them without an id: every row's next is the next in order, and rows without id are split."""
    rng = random.Random(4)
    rows = [(None, f"n{i}") for i in range(100)] + [(rng.randrange(-50, 50), f"t{rng.randrange(40)}") for _ in range(200)]
    got = fingerprints.with_next(docs_of(rows).select("doc_id", F.col("text").alias("t")), 2 * (fingerprints.ROW_BYTES + 2))
    assert got.rdd.getNumPartitions() > 100
    seen = got.withColumn("task", F.spark_partition_id()).collect()
    hashes = {r.t: r.h for r in got.select("t", F.xxhash64("t").alias("h")).collect()}
    place = lambda r: (-(1 << 63) if r[0] is None else r[0], hashes[r[1]])
    order = sorted(rows, key=place)
    want = Counter((*r, n[1]) for r, n in zip(order, order[1:] + order[:1]))
    assert Counter((r.doc_id, r.t, r.next.t) for r in seen) == want
    assert len({r.task for r in seen if r.doc_id is None}) > 20


def test_fingerprint_edges(docs_of, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROW_BYTES", fingerprints.RANGE_BYTES // 2)     # ranges of two rows
    rows = [(5, None), (1, ""), (None, "first one here"), (9, "last"), (9, "last"), (7, "a b c d e f g h")]
    got = fingerprints.fingerprints(docs_of(rows)).collect()
    assert len(got) == 6 and {r.fingerprint for r in got if r.doc_id in (1, 5)} == {""}
    assert {(r.near_edited, r.near_next) for r in got if r.doc_id == 1} == {(1.0, 1.0)}       # next: 5, empty too
    assert {r.near_next for r in got if r.doc_id == 5} == {0.0}
    seven = next(r for r in got if r.doc_id == 7)
    assert seven.edited_sha256 == hashlib.sha256(("a b c d e f g h"[:12] + "las").encode()).hexdigest()
    nines = sorted(r.edited_sha256 for r in got if r.doc_id == 9)
    assert nines == sorted(hashlib.sha256(x.encode()).hexdigest() for x in ("lasl", "lasf"))  # its twin, then the first: null id
    one = fingerprints.fingerprints(docs_of([(1, "only one row in here")])).first()
    assert one.near_next == 1.0
    assert fingerprints.fingerprints(docs_of([])).collect() == []

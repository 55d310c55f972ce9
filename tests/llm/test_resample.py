"""Importance resampling: against a plain version by words, CRC of spelled runs and one sort."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import resample

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, buckets, runs):
    w = WORDS.findall((text or "").translate(SMALL))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets
                    for n in range(runs[0], runs[1] + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, buckets=10000, runs=(1, 1), min_words=20, percent=10, seed=2024):
    found = [(i, *plain_features(t, buckets, runs)) for i, t in docs]
    s = Counter(b for _, _, f in found for b in f)
    t = Counter(b for x in target for b in plain_features(x, buckets, runs)[1])
    s_all, t_all = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * t_src / ((s[b] + 1.0) * t_all)))
    t_src = s_all
    rows = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = percent * len(able) // 100
    places = Counter()
    for k, r in enumerate(able):
        places[(r[0], r[2], r[3], r[4], k + 1 if k < drawn else None)] += 1
    for r in rows:
        if r[1] < min_words:
            places[(r[0], r[2], r[3], r[4], None)] += 1
    return places


def got(frame):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect())


def random_texts(n, seed):
    rng = random.Random(seed)
    pool = [f"{rng.choice(['Wort', 'mot', 'İx', 'ß', 'ÉTÉ', '日本', 'don', '7'])}{rng.randrange(60)}" for _ in range(80)]
    glue = [" ", "  ", ", ", "\n", "-", "'", "\x7f", "\x00", "…"]
    return [(i, "".join(rng.choice(pool) + rng.choice(glue) for _ in range(rng.randrange(0, 60)))) for i in range(n)]


EDGES = [(900, None), (901, ""), (902, " \n.,"), (None, "null id " * 12), (None, "null id " * 12), (5, "same same " * 15),
         (5, "same same " * 15), (903, "x" * 5000 + " tail"), (904, "A\x00B\x7fC é É ")]


def test_compose_equals_crc_of_the_joined_bytes():
    rng = random.Random(1)
    pairs = [(rng.randbytes(rng.randrange(0, 9)), rng.randbytes(rng.choice([0, 1, 2, 3, 7, 64, 1000, 70_000]))) for _ in range(200)]
    got = resample.compose(np.array([zlib.crc32(x) for x, _ in pairs], dtype=np.uint32),
                           np.array([zlib.crc32(y) for _, y in pairs], dtype=np.uint32),
                           np.array([len(y) for _, y in pairs], dtype=np.int64))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in pairs]


@pytest.mark.parametrize("most,stretch,runs", [(200_000, 1 << 20, (1, 1)), (40, 1 << 20, (1, 2)), (3, 50, (2, 3)), (7, 1, (1, 3))])
def test_features_of_small_dictionaries_and_stretches(monkeypatch, most, stretch, runs):
    monkeypatch.setattr(resample, "STRETCH", stretch)
    monkeypatch.setattr(resample, "GROWTH", 0.0)
    words = resample.Dictionary(most)
    words.learn()
    texts = [t or "" for _, t in random_texts(60, 4) + EDGES]
    for again in range(3):
        words.learn()                                           # what waited is in the automaton now, if it fits
        n, of, bucket = resample.features([t.encode() for t in texts], 997, runs, words)
        for i, t in enumerate(texts):
            want_n, want = plain_features(t, 997, runs)
            assert n[i] == want_n and Counter(bucket[of == i].tolist()) == Counter(want), (again, t)
    assert 0 < len(words.crc) <= most


@pytest.mark.parametrize("runs,percent", [((1, 1), 10), ((1, 2), 100), ((2, 2), 0)])
def test_resample_against_the_plain_version(docs_of, runs, percent):
    docs, target = random_texts(300, 2) + EDGES, [t for _, t in random_texts(40, 3)] + [None]
    found = resample.resample(docs_of(docs), docs_of(list(enumerate(target))), runs=runs, percent=percent)
    assert got(found) == plain(docs, target, runs=runs, percent=percent)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_ranks_over_many_ranges_and_ties(docs_of, monkeypatch):
    from tidemark.functions import quantiles
    monkeypatch.setattr(quantiles, "RANGE_ROWS", 20)
    docs = random_texts(200, 5) + [(7, "one and the same text " * 5)] * 150
    found = resample.resample(docs_of(docs), docs_of(random_texts(10, 6)), percent=60)
    assert got(found) == plain(docs, [t for _, t in random_texts(10, 6)], percent=60)


def test_empty_tables(docs_of):
    assert resample.resample(docs_of([]), docs_of([])).collect() == []
    docs = random_texts(30, 8)
    assert got(resample.resample(docs_of(docs), docs_of([]))) == plain(docs, [])


def test_resample_of_the_documents(spark, sf_small):
    from tidemark.llm.common import read
    from tidemark.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in read(spark, sf_small, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in read(spark, sf_small, "benchmark").select("text").collect()]
    assert got(QUERIES["op11_importance_resampling"](spark, sf_small)) == plain(docs, target)


@pytest.mark.parametrize("buckets,runs", [(997, (1, 1)), (1 << 16, (1, 2)), (70_001, (2, 3))])
def test_texts_are_scanned_once_into_numbers(docs_of, monkeypatch, buckets, runs):
    """What is written of each text are the buckets of its features; counts and scores are made of that alone."""
    docs = random_texts(120, 11) + EDGES
    own = resample.featured(docs_of(docs), buckets, runs)
    assert own.columns == ["doc_id", "n_words", "features"]
    number = resample.number_type(buckets)
    found = Counter((r.doc_id, r.n_words, tuple(sorted(np.frombuffer(bytes(r.features), dtype=number).tolist()))) for r in own.collect())
    want = [(i, *plain_features(t, buckets, runs)) for i, t in docs]
    assert found == Counter((i, n, tuple(sorted(f))) for i, n, f in want)
    assert resample.bucket_counts(own, buckets).tolist() == np.bincount([b for _, _, f in want for b in f], minlength=buckets).tolist()
    gain = np.arange(buckets, dtype=np.int64) - 400
    monkeypatch.setattr(resample, "STRETCH", 100)
    weights = Counter((r.doc_id, r.n_words, r.n_features, r.weight) for r in resample.scored(own, gain).collect())
    assert weights == Counter((i, n, len(f), sum(b - 400 for b in f)) for i, n, f in want)
    seen = []
    real = resample.featured
    monkeypatch.setattr(resample, "featured", lambda *a: seen.append(a[0].columns) or real(*a))
    resample.resample(docs_of(docs), docs_of([]), buckets, runs).collect()
    assert len(seen) == 2       # the documents and the target, each once

"""Operator 3: accuracy on held-out rows, Viterbi against exhaustive search, edges."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import langid
from tidemark.llm.common import read


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    found = langid.identify(docs, langid.language_model(docs), held=langid.held_out(F.col("doc_id")))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where("held").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_and_labels_are_never_learned_from(spark, docs_of):
    import zlib
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = docs_of([(i, "aaa bbb") for i in ids] + [(None, "ccc")])
    assert langid.language_model(rows)["langs"] == []
    assert {r.lang_pred for r in langid.identify(rows, langid.language_model(rows)).collect()} == {"und"}


def test_viterbi_equals_exhaustive_search():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = rng.integers(0, 6, 5)
        scores = rng.normal(size=(9, 3)).astype(np.float32) * 3
        index = rng.integers(0, 9, lengths.sum())
        got = langid._viterbi(scores, index, lengths, 1.5)
        at = 0
        for n in lengths:
            own = scores[index[at:at + n]].astype(float)
            value = lambda path: sum(own[i, k] for i, k in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))  # noqa: B023, E731
            if n:
                best = max(value(p) for p in itertools.product(range(3), repeat=int(n)))
                assert abs(value(got[at:at + n].tolist()) - best) < 1e-4
            at += n


def corpus(spark):
    rng = random.Random(8)
    make = {"xx": "the of and with from by".split(), "yy": "der und nicht ein für über".split(), "ru": "это как для что мир".split()}
    rows = [(i, " ".join(rng.choice(make[k]) for _ in range(40)), k) for i, k in enumerate(itertools.islice(itertools.cycle(make), 300))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_spans_scripts_and_edges(spark):
    model = langid.fit(corpus(spark))
    assert model["langs"] == ["ru", "xx", "yy"]
    rows = [(1, "the of and with the of by from der und nicht ein für über der und это что для мир как что"), (2, None), (3, ""),
            (4, "123 ... \n"), (5, "漢字仮名"), (5, "漢字仮名"), (None, "the and of the and"), (7, "это " * 30_000)]
    docs = spark.createDataFrame([(i, t, "zz", "q") for i, t in rows], "doc_id long, text string, lang string, held string")
    out = langid.identify(docs, model).collect()
    first = next(r for r in out if r.doc_id == 1)
    assert [s.lang for s in first.spans] == ["xx", "yy", "ru"]
    assert rows[0][1][first.spans[1].first:first.spans[1].last] == "der und nicht ein für über der und"
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in out if r.doc_id in (2, 3, 4)) == [(2, "und", 0.0), (3, "und", 0.0), (4, "und", 0.0)]
    assert [(r.lang_pred, r.score) for r in out if r.doc_id == 5] == [("ru", 0.0)] * 2
    assert [(r.lang_pred, r.score) for r in out if r.doc_id == 7] == [("ru", 1.0)]
    assert [r.lang_pred for r in out if r.doc_id is None] == ["xx"]
    assert langid.identify(docs.limit(0), model).collect() == []


def test_rejection_keeps_rows_whole(spark, docs_of):
    model = langid.fit(corpus(spark))
    docs = docs_of([(1, "the of and with"), (2, None), (3, "12 34"), (3, "der und nicht")])
    kept = langid.keep_identified(docs, model, 0.5)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.bucket) for r in kept.collect()) == [(1, "the of and with", "bucket"), (3, "der und nicht", "bucket")]


def test_texts_of_a_slice_only_are_python_objects():
    """A task holds the texts of one slice as Python strings, not those of a whole batch."""
    import pyarrow as pa
    from tidemark.llm.common import slices, text_slices

    texts = ["ab", None, "", "ñandú", "x" * 30, "日本", "𐐀" * 4, "tail"] * 5
    for most in (1, 6, 30, 1000):
        own = list(text_slices(pa.array(texts, pa.string()), most))
        assert [(lo, hi) for lo, hi, _ in own] == list(slices(texts, most))
        assert [t for *_, part in own for t in part] == texts
        assert all(hi - lo == 1 or sum(len(t or "") for t in part) <= most for lo, hi, part in own)
    assert list(text_slices(pa.array([], pa.string()), 5)) == []


def test_tasks_give_their_memory_back(spark, docs_of, monkeypatch):
    """Of the stages of the pipeline that run Python, each task does so once, also when it is ended early."""
    from tidemark.llm import common
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    assert list(common.lean(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3] and len(given) == 1
    early = common.lean(lambda batches: iter(batches))(iter([1, 2]))
    assert next(early) == 1
    early.close()
    assert len(given) == 2


def test_given_back_memory_leaves_the_process():
    """In a process of its own, as a worker is: what 200 MB of small texts took is not kept."""
    import subprocess
    import sys
    code = """
import re, pyarrow as pa
from tidemark.llm.common import give_back
held = lambda: int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
a = pa.array(["%07d" % i * 400 for i in range(40_000)])
kept, texts = [], []
for t in a.to_pylist():
    texts.append(t + "!")
    kept.append(t[:600] + "?")      # small ones between large ones
full = held()
del a, texts, t
give_back()
assert held() < full - 80, (full, held())
"""
    root = __file__.rsplit("/tests/", 1)[0]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=60)

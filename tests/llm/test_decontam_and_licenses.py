"""Operators 4 and 5: against SQL on the given tables, and against plain Python on planted edges."""

import random
import re

import pytest

from tidemark.llm import decontam, licenses, queries

from .conftest import words


def plain(rows, items, threshold=0.8):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w, n: {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    held = {n: [(i, grams(split(t), n)) for i, t in rows] for n in range(1, 6)}
    out = set()
    for j, s in items:
        n = min(5, len(split(s)))
        want = grams(split(s), n) if n else set()
        for i, have in held[n or 1]:
            if want and len(want & have) >= threshold * len(want):
                out.add((i, j, len(want & have), len(want)))
    return out


def test_containment_equals_brute_force(spark, docs_of):
    rng = random.Random(11)
    items = [(j, " ".join(words(rng, rng.randint(3, 40)))) for j in range(60)] + [(60, None), (61, ""), (62, "one two"), (63, "A b c d e!")]
    rows = []
    for i in range(150):
        text = words(rng, rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            part = items[rng.randrange(60)][1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(text))
            text[at:at] = part
        rows.append((i, " ".join(text)))
    rows += [(500, None), (501, ""), (502, "x A, b\nC. d E x"), (None, items[5][1]), (503, items[7][1].upper()),
             (504, " ".join(words(rng, 60_000) + items[9][1].split()))]
    docs = docs_of(rows)
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontam.contaminated(docs, bench).collect()}
    assert got == plain(rows, items) and len(got) > 60
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in {g[0] for g in got})


def test_short_items_are_found(spark, docs_of):
    """Items of one to four words are runs of so many words, and look-ups of the other classes stay as they are."""
    rng = random.Random(2)
    rows = [(i, " ".join(words(rng, 200, 0, 400))) for i in range(40)] + [(100, "x y z OK, fine"), (101, "ok not fine"), (102, "w7x"), (103, "fine ok fine")]
    items = [(j, " ".join(words(rng, rng.randint(6, 60), 0, 400))) for j in range(30)] + [(30, rows[3][1][:300]), (31, rows[9][1])]
    short = [(50, "ok fine"), (51, "w7x"), (52, "not there at all"), (53, "x y z ok"), (54, " ... ")]
    bench = lambda xs: spark.createDataFrame(xs, "item_id long, text string")
    docs = docs_of(rows)
    got = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontam.contaminated(docs, bench(items + short)).collect()}
    assert got == plain(rows, items + short) and {(100, 50, 1, 1), (100, 53, 1, 1), (102, 51, 1, 1), (103, 50, 1, 1)} <= got
    assert not {g for g in got if g[:2] == (101, 50)}
    cuts = decontam.cuts_of(decontam.sketches(bench(items))[1])
    more = decontam.cuts_of(decontam.sketches(bench(items + short))[1])
    assert {c: x for c, x in more.items() if c >= 0} == cuts and {c for c in more if c < 0} == {-1, -2, -4}
    from pyspark.sql import functions as F
    count = lambda cs: {r.size_class: r.n for r in docs.select(F.inline(decontam.lookups(decontam.word_array(F.col("text")), cs)))
                        .groupBy("size_class").agg(F.count("*").alias("n")).collect()}
    before, after = count(cuts), count(more)
    assert before and {c: n for c, n in after.items() if c >= 0} == before
    six = decontam.cuts_of(decontam.sketches(bench(items + [(60, "an item of five words")]))[1])     # one shingle: its own class only
    assert {c: x for c, x in six.items() if c > 0} == {c: x for c, x in cuts.items() if c > 0}


def test_repeated_rows_and_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "q r s t u v")], "item_id long, text string")
    docs = docs_of([(1, "x a b c d e f"), (1, "x a b c d e f"), (1, "clean text"), (2, "q r s t u v")])
    assert sorted((r.doc_id, str(r.item_id), r.n_shared) for r in decontam.contaminated(docs, bench).collect()) == [(1, "1", 2), (2, "None", 2)]
    assert [r.text for r in decontam.drop_contaminated(docs, bench).collect()] == ["clean text"]
    assert decontam.contaminated(docs, bench.limit(0)).collect() == []
    assert decontam.contaminated(docs.limit(0), bench).collect() == []
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == 4


@pytest.mark.parametrize("most", [licenses.BROADCAST_BYTES, 0])
def test_licenses(spark, docs_of, monkeypatch, most):
    """With the known digests sent to every task, and joined in parts."""
    monkeypatch.setattr(licenses, "BROADCAST_BYTES", most)
    mit = dict(reversed(licenses.KNOWN))["MIT"] and licenses.KNOWN[0][1]
    dressed = "/* Copyright (c) 2020 Someone\n * All rights reserved. */\n" + mit.upper().replace("SUBLICENSE", "sublicense").replace("\n", "\n * ")
    rows = [(1, dressed), (2, "text\nLicenced under CC-BY-NC 4.0\nmore\nreleased under the MIT Licence."), (3, None), (3, ""),
            (4, "Copyright 2001 X"), (5, "copyrighted matter stays"), (6, "Released under the MIT license\n" * 2), (7, "plain " * 50_000),
            (None, "SPDX-License-Identifier: MIT")]
    got = {(r.doc_id, r.text_license, r.line_licenses, r.n_license_lines) for r in licenses.scan(docs_of(rows), licenses.known_licenses(spark)).collect()}
    assert got == {(1, "MIT", "", 0), (2, "", "CC-BY-NC-4.0,MIT", 2), (3, "", "", 0), (4, "", "", 0), (5, "", "", 0), (6, "", "MIT", 2),
                   (7, "", "", 0), (None, "MIT", "MIT", 1)}
    assert licenses.scan(docs_of(rows), licenses.known_licenses(spark)).count() == len(rows)
    assert licenses.scan(docs_of([]), licenses.known_licenses(spark)).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf_small, name):
    from tidemark.checks.compare import compare, duckdb_connection
    con = duckdb_connection(sf_small)
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create or replace view {t} as select * from '{sf_small}/{t}.parquet'")
    r = compare(spark, con, sf_small, name, queries.QUERIES[name], queries.ORACLE[name])
    assert r["columns_match"] and r["values_match"], r

"""Concatenate and cut: ids equal the library's, pieces cover them once, sequences are full, windows come back whole."""
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import concat

WORD = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(WORD)
TEXTS = [(1, None), (2, ""), (3, "ok then"), (None, "no id, twice"), (None, "no id, twice"), (4, "long " * 900 + "end."),
         (5, "Ünïcode “quotes” — 日本語 Σίσυφος İstanbul ﬁ ½ <|endoftext|> it's 1999!"), (6, " \n\t "), (7, "I'LL don't 'tis")]


def library(text):
    return np.array([*LIB.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def check(rows, texts, capacity):
    """Every document's ids once, windows gapless from 0 and full, but for the last one."""
    want = sorted((str(i), library(t).tobytes()) for i, t in texts)
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert 0 < r.length and r.offset + r.length <= capacity and len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
        by_doc.setdefault(r.doc_id, []).append(r)
    found = []
    for i, parts in by_doc.items():
        # rows of one id: pieces in the order of their places are copies one after another
        parts.sort(key=lambda r: (r.sequence_id, r.offset))
        held, at = b"", 0
        for r in parts:
            assert r.start == at
            held, at = held + r.ids, at + r.length
            if at == r.doc_tokens:
                found.append((str(i), bytes(held)))
                held, at = b"", 0
        assert not held
    assert sorted(found) == want
    total = sum(len(x) // 4 for _, x in want)
    assert sorted(by_sequence) == list(range(-(-total // capacity)))
    whole = {}
    for s, parts in by_sequence.items():
        at = 0
        for offset, length, ids in sorted(parts):
            assert offset == at
            at += length
            whole[s] = whole.get(s, b"") + ids
        assert at == min(capacity, total - s * capacity)
    return whole


def test_part_tokenizer_equals_the_library():
    tok, rng = concat.part_tokenizer(WORD), random.Random(3)
    assert tok.parts is not None
    letters = "aAbBzZ'sStTlLdDvVmMrReE0199.,!?-_<|>()[]éÉßÿŸſŉŁłİı×÷ \n\t\"#$%^&*~`@/\\{}=+:;“Σσ日́\x85\xa0½²"
    for _ in range(20_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 25)))
        assert tok.ids(text) == library(text)[:-1].tobytes(), text
    for _, text in TEXTS:
        assert tok.ids(text or "") == library(text)[:-1].tobytes()


def test_pieces_and_sequences_over_many_partitions(docs_of):
    rng = random.Random(5)
    texts = TEXTS + [(100 + i, " ".join(rng.choice(["the", "Cat,", "über", "x1", "don't"]) for _ in range(rng.randrange(0, 40))))
                     for i in range(400)] + [(9, "a hot document")] * 300
    docs = docs_of(texts).repartition(13)
    for capacity in (64, 7, 1, 1 << 20):
        pieces = concat.written(concat.concatenate_and_cut(docs, WORD, capacity, with_ids=True), "pieces")
        whole = check(pieces.collect(), texts, capacity)
        back = {r.sequence_id: bytes(r.ids) for r in concat.sequences(pieces, capacity).collect()}
        assert back == whole


def test_boundary_tells_windows_of_several_partitions(docs_of):
    docs = docs_of([(i, "a b c") for i in range(64)]).repartition(4)
    rows = concat.cut(concat.written(concat.counted(docs, WORD), "ids"), concat.stored_ids(WORD), 10).collect()
    edges = {r.sequence_id for r in rows if r.boundary}
    counts = concat.counted(docs, WORD).groupBy("part").sum("tokens").orderBy("part").collect()
    at, want = 0, set()
    for r in counts[:-1]:
        at += r[1]
        if at % 10:
            want.add(at // 10)
    assert edges == want


def test_vocabularies_beyond_two_bytes_and_other_tokenizers(docs_of, monkeypatch):
    assert concat.stored_ids(WORD) == "<u2"
    monkeypatch.setattr(concat, "stored_ids", lambda path: "<u4")
    check(concat.concatenate_and_cut(docs_of(TEXTS), WORD, 32, with_ids=True).collect(), TEXTS, 32)
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert concat.PartTokenizer(other).parts is None
    lib = Tokenizer.from_file(other)
    for _, t in TEXTS:
        assert concat.PartTokenizer(other).ids(t or "") == np.array(lib.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_empty_table(docs_of):
    assert concat.concatenate_and_cut(docs_of([]), WORD).collect() == []
    assert concat.sequences(concat.concatenate_and_cut(docs_of([]), WORD, with_ids=True)).collect() == []


def test_packing_of_the_documents(spark, sf_small):
    from tidemark.llm.common import read
    from tidemark.llm.queries import QUERIES
    docs = read(spark, sf_small, "documents")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(concat.concatenate_and_cut(docs, WORD, with_ids=True).collect(), texts, concat.CAPACITY)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert QUERIES["op12_concat_packing"](spark, sf_small).columns[:7] == names

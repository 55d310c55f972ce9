"""Operators 10 and 1: token counts and packing against the tokenizer libraries themselves."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import packing, token_counts

PIECE, WORD = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = ["a", "Th", "ß", "œ", "Œ", "ÿ", "Ÿ", "à", "a!?", "#", "'", "e", " ", "  ", "\n", "\n\n", "É", "İ", "Σ", "▁", "x.", "9", "&&&", "\t", "漢", "</s>", "<s>", "a.,", ",",
            "́", "\x1c", "\xa0", "it's", "<|endoftext|>", "<|ENDOFTEXT|>"]
EDGES = [(1, None), (2, ""), (3, " "), (4, "\n"), (5, "one"), (5, "one"), (None, "no id"), (7, "x" * 300), (8, "a b\n" * 4000)]


def mixed(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def test_counts_equal_the_library_and_maps_compose_in_any_order():
    rng, tr = random.Random(5), token_counts.CountTransducer(PIECE)
    assert tr.lexical
    for _ in range(4000):
        text = mixed(rng, rng.randint(0, 14))
        want = len(tr.sp.encode(text))
        assert tr.count(text, True) == want
        if text:
            size = rng.randint(1, 4)
            maps = [tr.map_of(text[i:i + size]) for i in range(0, len(text), size)]
            while len(maps) > 1:
                i = rng.randrange(len(maps) - 1)
                maps[i:i + 2] = [tr.compose(maps[i], maps[i + 1])]
            assert tr.total(maps[0]) == want, (text, size)


def test_a_model_without_borders_counts_whole_texts():
    tr = token_counts.CountTransducer(PIECE)
    text = "over the border\nand back"
    want = tr.count(text, True)
    tr.lexical, tr.border = False, None
    a, b = tr.map_of(text[:9]), tr.map_of(text[9:])
    assert tr.total(tr.compose(a, b)) == want


@pytest.mark.parametrize("chunk", [7, 65_536])
def test_token_counts_table(docs_of, chunk):
    rng = random.Random(6)
    rows = EDGES + [(100 + i, mixed(rng, 200)) for i in range(20)]
    tr = token_counts.CountTransducer(PIECE)
    got = sorted(map(tuple, token_counts.count_tokens(docs_of(rows), PIECE, 40, chunk).drop("n_chunks").collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(tr.sp.encode(t or "")), n > 40) for i, t in rows]
    assert got == sorted(want, key=str)


def test_token_counts_empty_table(docs_of):
    assert token_counts.count_tokens(docs_of([]), PIECE).collect() == []


def test_word_ids_equal_the_library():
    rng, tok = random.Random(7), packing.tokenizer(WORD)
    assert tok.by_word and tok.parted and tok.lower and len(tok.spelling) > 50
    for _ in range(4000):
        text = mixed(rng, rng.randint(0, 12))
        assert tok.ids(text) == tok.encode(text), repr(text)


def checked_plan(lengths, capacity=4096):
    counts = Counter(lengths)
    found = packing.plan(counts, capacity)
    used = Counter()
    for many, items in found:
        assert many > 0 and sum(items) <= capacity
        for n in items:
            used[n] += many
    assert used == counts
    return sum(many for many, _ in found), -(-sum(lengths) // capacity)


def test_plan_is_complete_and_near_the_lower_bound():
    rng = np.random.default_rng(1)
    for lengths in ([int(x) for x in np.clip(rng.lognormal(6.3, 1.1, 20_000), 1, 4096)], [1] * 5000 + [4096] * 7 + [4095] * 3,
                    [int(x) for x in rng.integers(1, 60, 20_000)]):
        n, least = checked_plan(lengths)
        assert n == least
    n, least = checked_plan([int(x) for x in rng.integers(1, 4097, 30_000)])
    assert n <= 1.02 * least
    assert checked_plan([]) == (0, 0)


def test_plan_equals_exhaustive_search_on_small_cases():
    def best(items, capacity):
        bins = []

        def place(i):
            if i == len(items):
                return len(bins)
            found, seen = len(items), set()
            for b in range(len(bins)):
                if bins[b] + items[i] <= capacity and bins[b] not in seen:
                    seen.add(bins[b])
                    bins[b] += items[i]
                    found = min(found, place(i + 1))
                    bins[b] -= items[i]
            bins.append(items[i])
            found = min(found, place(i + 1))
            bins.pop()
            return found
        return place(0)

    rng, over = random.Random(3), 0
    for _ in range(60):
        items = [rng.randint(1, 20) for _ in range(8)]
        n, _ = checked_plan(items, 20)
        over += n - best(items, 20)
    assert over <= 2


def check_packed(rows, texts, capacity):
    tok = packing.tokenizer(WORD)
    end = np.array([1], dtype="<u4").tobytes()
    want = Counter()
    for i, t in texts:
        data = tok.encode(t or "") + end
        for no, at in enumerate(range(0, len(data), 4 * capacity)):
            part = data[at:at + 4 * capacity]
            want[(i, no, at // 4, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(r.length for r in rows) // capacity)


def test_packing_edges_and_hot_length(docs_of):
    hot = [(1000 + i, "same length text here") for i in range(700)] + [(1000, "same length text here")] * 3
    texts = EDGES + hot
    check_packed(packing.pack_documents(docs_of(texts), WORD, 64).collect(), texts, 64)


def test_packing_with_many_salts(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "SALT_ROWS", 50)
    texts = [(i, "a b c" if i % 3 else f"w{i} " * (i % 50)) for i in range(1500)]
    n, least = check_packed(packing.pack_documents(docs_of(texts), WORD, 256).collect(), texts, 256)
    assert n <= least + 1


def test_packing_empty_table_and_ids(docs_of):
    assert packing.pack_documents(docs_of([]), WORD).collect() == []
    row = packing.pack_documents(docs_of([(1, "ok then")]), WORD, with_ids=True).first()
    assert zlib.crc32(row.ids) == row.ids_crc32 and len(row.ids) == 4 * row.length


def test_packing_of_the_documents(spark, sf_small):
    from tidemark.llm.common import read
    docs = read(spark, sf_small, "documents")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    n, least = check_packed(packing.pack_documents(docs, WORD).collect(), texts, 4096)
    assert n <= least + 1

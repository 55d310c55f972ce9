"""Best-fit packing of documents into sequences by exact-complement hashing (operator 1).

1. Documents become token ids (one pass in Arrow batches) and pieces of at most `capacity` ids; pieces are written.
2. All that the plan needs is how many pieces there are of each length: `capacity` counters at most, however many
   documents. On these, `plan` consumes combinations that fill a sequence exactly: for each length, from the
   longest, the rest of the sequence is looked up among single lengths, sums of two and sums of three that are still
   available. What has no exact complement is packed by best fit, the longest piece first and then the longest that
   fits, with the same look-up for each rest. Equal sequences are planned once with a multiplicity, so the plan has a
   bounded number of patterns.
3. Pieces are numbered within their length, in parallel: a salt of the row splits each length (a length may hold
   any share of the rows), counts of (length, salt) give every salt its first number. Number and length say which
   pattern, copy and offset a piece takes; the table of that is bounded by the plan.

Cases: a null or empty text has the end id alone; repeated rows are packed each; a null doc_id is kept; an empty
table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Memo, lean, written

CAPACITY = 4096
END_ID = 1
SALT_ROWS = 20_000       # pieces for each salt, about
WORDS_KEPT = 150_000     # words of one generation of the table, per Python worker
PUNCTUATION = ",.*#$%&!?;:"


class WordTokenizer:
    """Ids of whole texts by a tokenizer that never joins text over white space: words are looked up.

    Only blanks and line breaks are split at here; the tokenizer drops both and sees every word once. A word is
    taken apart where the tokenizer does so too: punctuation behind letters is a token run of its own, and capital
    Latin letters count as small ones. A run of small Latin letters goes straight to the tokenizer's merge model, in the
    spelling that its own pre-tokenizer gives each letter; anything else is encoded whole. These short cuts are used
    only if the tokenizer shows on loading that it works so.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        whole = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        split = lambda x: [i for w in x for i in whole(w)]
        self.by_word = all(whole("".join(x)) == split(y) for x, y in (
            (("a", " ", "b"), "ab"), (("a", "\n", "b"), "ab"), ((" ", "A.", " ", "b", "\n\n", " ", "c"), ("A.", "b", "c"))))
        self.parted = self.by_word and all(whole(x + "ab" + p) == split((x + "ab", p)) for x in "\u00e9z" for p in PUNCTUATION)
        self.lower = self.by_word and all(whole(c) == whole(c.lower()) for c in map(chr, range(0x41, 0x100)) if c.isupper())
        spelt = {}
        for c in map(chr, range(0x61, 0x180)):
            if self.by_word and c.isalpha() and c.islower():
                found = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(c)) if (
                    self.tokenizer.pre_tokenizer and self.tokenizer.normalizer) else []
                if len(found) == 1 and [t.id for t in self.model.tokenize(found[0][0])] == whole(c):
                    spelt[ord(c)] = found[0][0]
        self.spelling = spelt
        self.small = re.compile(f"[{''.join(map(chr, spelt))}]+").fullmatch if spelt else lambda w: None
        self.words = Memo(self.word, WORDS_KEPT)

    def encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, word: str) -> bytes:
        if self.small(word):
            return array("I", [t.id for t in self.model.tokenize(word.translate(self.spelling))]).tobytes()
        if self.parted:
            base = word.rstrip(PUNCTUATION)
            if len(base) < len(word) and base and base.lower()[-1].isalpha():
                return self.words[base] + self.words[word[len(base):]]
        if self.lower and word.isalpha() and max(word) < "\u0100" and not word.islower():
            return self.words[word.lower()]
        return self.encode(word)

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not self.by_word:
            return self.encode(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """Once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit) of every piece."""
    schema = _PIECES if with_ids else _PIECES.remove(5)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_path)
        for b in batches:
            rows: list[tuple] = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                data = tok.ids(text or "") + end
                for no, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    rows.append((doc, no, at // 4, len(part) // 4, zlib.crc32(part), part)[:len(schema)])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        lean(run), "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class _Stock:
    """Counts of lengths with an index of those still there, as bits of an integer and reversed."""

    def __init__(self, counts: dict[int, int], capacity: int, most: int):
        self.left, self.capacity = dict(counts), capacity
        self.complements = (self.single, self.pair, self.triple)[:most]
        self.bits = sum(1 << n for n, c in counts.items() if c)
        self.back = sum(1 << capacity - n for n, c in counts.items() if c)

    def take(self, n: int, k: int) -> None:
        was = self.left.get(n, 0)
        self.left[n] = was - k
        if (was > 0) != (was > k):
            self.bits ^= 1 << n
            self.back ^= 1 << self.capacity - n

    def single(self, gap: int) -> tuple | None:
        return (gap,) if self.left.get(gap, 0) > 0 else None

    def pair(self, gap: int) -> tuple | None:
        """The available pair of this sum with the longest member."""
        both = self.bits & (self.back >> self.capacity - gap)    # bit n: n and gap - n are there
        while both:
            n = both.bit_length() - 1
            if 2 * n != gap or self.left[n] > 1:
                return n, gap - n
            both ^= 1 << n
        return None

    def triple(self, gap: int) -> tuple | None:
        there = self.bits & ((1 << max(gap - 1, 0)) - 1)
        while there:
            n = there.bit_length() - 1
            if 3 * n < gap:
                return None
            there ^= 1 << n
            self.take(n, 1)
            rest = self.pair(gap - n)
            self.take(n, -1)
            if rest:
                return n, *rest
        return None

    def exact(self, gap: int) -> tuple | None:
        if gap == 0:
            return ()
        return next(filter(None, (complement(gap) for complement in self.complements)), None)

    def longest(self, gap: int) -> int:
        return (self.bits & ((1 << gap + 1) - 1)).bit_length() - 1


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how many sequences, lengths in each): every piece is used once.

    Complements of up to three pieces use up short pieces, which costs more than it saves where lengths are spread
    evenly; so the plan with single complements only is made too, and the one with fewer sequences is taken.
    """
    return min((_plan(counts, capacity, most) for most in (3, 1)), key=lambda found: sum(many for many, _ in found))


def _plan(counts: dict[int, int], capacity: int, most: int) -> list[tuple[int, list[int]]]:
    """The plan with exact complements of up to `most` pieces."""
    stock, out = _Stock(counts, capacity, most), []

    def commit(items: list[int]) -> None:
        need = Counter(items)
        many = min(stock.left[n] // k for n, k in need.items())
        for n, k in need.items():
            stock.take(n, many * k)
        out.append((many, sorted(items, reverse=True)))

    lengths = sorted(counts, reverse=True)
    # exact complements: singles for all lengths, then pairs, then triples, so that short pieces are kept for last
    for complement in stock.complements:
        for n in lengths:
            while stock.left[n] > 0:
                stock.take(n, 1)
                rest = complement(capacity - n) if n < capacity else ()
                stock.take(n, -1)
                if rest is None:
                    break
                commit([n, *rest])
    for n in lengths:                               # residuals by best fit
        while stock.left[n] > 0:
            items, gap = [n], capacity - n
            stock.take(n, 1)
            while gap > 0:
                rest = stock.exact(gap)
                if rest is not None:
                    for x in rest:
                        stock.take(x, 1)
                    items.extend(rest)
                    break
                x = stock.longest(gap)
                if x <= 0:
                    break
                stock.take(x, 1)
                items.append(x)
                gap -= x
            for x in items:
                stock.take(x, -1)
            commit(items)
    return out


def _slots(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """For each pattern and length in it: first number, copies in a sequence, first sequence, offsets of the copies."""
    used: Counter = Counter()
    keys, copies, base, at, offsets = [], [], [], [], []
    sequence = 0
    for many, items in patterns:
        places: dict[int, list[int]] = {}
        offset = 0
        for n in items:
            places.setdefault(n, []).append(offset)
            offset += n
        for n, offs in places.items():
            keys.append((n, used[n]))
            used[n] += many * len(offs)
            copies.append(len(offs))
            base.append(sequence)
            at.append(len(offsets))
            offsets.extend(offs)
        sequence += many
    order = sorted(range(len(keys)), key=keys.__getitem__)
    pick = lambda x: np.array([x[i] for i in order], dtype=np.int64)
    return {"length": pick([k[0] for k in keys]), "first": pick([k[1] for k in keys]), "copies": pick(copies),
            "base": pick(base), "at": pick(at), "offsets": np.array(offsets, dtype=np.int64)}


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """rows (a written table with a column length, from pieces()) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}   # at most `capacity` rows
    slots = rows.sparkSession.sparkContext.broadcast(_slots(plan(counts, capacity)))
    salts = max(1, sum(counts.values()) // SALT_ROWS)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_no"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = (salted.join(firsts, ["length", "salt"])
                .withColumn("no", F.col("first_no") + F.row_number().over(within) - 1).drop("salt", "first_no"))
    names = [c for c in numbered.columns if c != "no"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        starts = np.searchsorted(s["length"], np.arange(capacity + 2))
        # numbers of one length are ranges one after another: one sorted key for both
        span = np.int64(int(s["first"].max()) + 1) if len(s["first"]) else np.int64(1)
        key = s["length"] * span + s["first"]
        for b in batches:
            length, no = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "no"))
            i = np.searchsorted(key, length * span + np.minimum(no, span - 1), side="right") - 1
            i = np.clip(i, starts[length], starts[length + 1] - 1)
            q = no - s["first"][i]
            seq = s["base"][i] + q // s["copies"][i]
            off = s["offsets"][s["at"][i] + q % s["copies"][i]]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(seq), pa.array(off)],
                                             names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.select(*names).schema) + ", sequence_id long, offset long"
    return numbered.mapInArrow(lean(run), schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset of every piece."""
    packed = pack(written(pieces(docs, tokenizer_path, capacity, with_ids), "pieces"), capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "sequence_id", "offset")

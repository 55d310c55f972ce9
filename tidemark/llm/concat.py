"""Packing by concatenating and cutting (operator 12): prefix sums in two passes, fixed windows, boundary records.

1. Texts become token ids, an end id after each, in one pass. A task counts along its rows, so every document knows
   how many ids of its own partition lie before it; the ids are written with the partition's number.
2. One total for each partition (of the narrow columns), summed up in the order of partitions, tells where each partition
   begins among all ids. That is all that meets in one place: two numbers for each partition.
3. Windows of `capacity` ids cut the one long sequence of all ids. Each document is cut where a window ends, by its
   own place alone: no shuffle, no key, so no row can be hot. All windows but the very last are full.
4. `sequences` puts windows together. Runs of pieces that one task reads in a row are joined there; only what is left
   over at the edges of tasks, the boundary records, meets by sequence, at most `capacity` ids for each.

Cases: a null or empty text has the end id alone; a very long text is one row of one task and is cut into as many pieces as
windows it reaches; repeated rows and rows of one doc_id or without any are packed each; there are no ties, since
places are unique; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Memo, written
from tidemark.llm.packing import tokenizer

CAPACITY = 2048
END_ID = 1
PARTS_KEPT = 200_000     # parts of words of one generation of the table, per Python worker

# What the short cut below knows of normalisers and pre-tokenizers, and its letters.
KNOWN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
KNOWN_SPLITS = ["Split", "ByteLevel"]
LETTERS, DIGITS = "a-zß-öø-įı-ſ", "0-9"
PLAIN = "\n -~À-įı-ſ"


class PartTokenizer:
    """Ids of whole texts; texts in plain Latin letters are split by the tokenizer's own pattern, part by part.

    Parts repeat far more than words with their capitals and punctuation do, and a part goes straight to the merge
    model. This holds for a tokenizer that lower-cases, splits by one pattern and spells bytes; any other, and any
    text with other letters or with a string of an added token, is left to the tokenizer word by word.
    """

    def __init__(self, path: str):
        self.words = tokenizer(path)
        own = self.words.tokenizer
        self.model = own.model
        rules = json.loads(own.to_str())
        normal = [x["type"] for x in (rules["normalizer"] or {}).get("normalizers", [])]
        splits = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.added = [x["content"] for x in rules["added_tokens"]]
        self.parts = None
        if normal == KNOWN_NORMALIZERS and [x["type"] for x in splits] == KNOWN_SPLITS and "Regex" in splits[0]["pattern"]:
            pattern = splits[0]["pattern"]["Regex"].replace(r"\p{L}", LETTERS).replace(r"\p{N}", DIGITS)
            if "\\p" not in pattern and splits[0]["invert"] and not splits[1]["add_prefix_space"]:
                plain = [c for c in map(chr, range(0x21, 0x180)) if re.fullmatch(f"[{PLAIN}]", c) and c == c.lower()]
                self.spelling = {ord(c): own.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in plain}
                self.parts = re.compile(pattern).findall
                self.plain = re.compile(f"[{PLAIN}]*").fullmatch
                self.known = Memo(self.part, PARTS_KEPT)

    def part(self, part: str) -> bytes:
        spelt = part if part.isascii() else part.translate(self.spelling)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.parts is None or not self.plain(text) or any(x in text for x in self.added):
            return self.words.ids(text)
        return b"".join(map(self.known.__getitem__, self.parts(text.lower())))


_LOADED: dict[str, PartTokenizer] = {}


def part_tokenizer(path: str) -> PartTokenizer:
    """Once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PartTokenizer(path)
    return _LOADED[path]


def stored_ids(tokenizer_path: str) -> str:
    """How ids are kept between the passes: two bytes each where the vocabulary allows it."""
    return "<u2" if max(tokenizer(tokenizer_path).tokenizer.get_vocab_size(with_added_tokens=True), END_ID + 1) <= 1 << 16 else "<u4"


def counted(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """First pass: doc_id, before (ids of the same partition before it), tokens, ids and part, the partition's number."""
    kind = stored_ids(tokenizer_path)
    end = np.array([END_ID], dtype="<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("before", pa.int64()), ("tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, before = part_tokenizer(tokenizer_path), 0
        for b in batches:
            found = [tok.ids(text or "") + end for text in b.column("text").to_pylist()]
            if not found:
                continue
            tokens = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
            upto = before + np.cumsum(tokens)
            before = int(upto[-1])
            if kind != "<u4":
                found = [np.frombuffer(x, dtype="<u4").astype(kind).tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(upto - tokens), pa.array(tokens),
                                              pa.array(found, pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, before long, tokens long, ids binary").withColumn("part", F.spark_partition_id())


def partition_starts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Place among all ids at which each partition begins (by number), and their total as a last entry."""
    totals = dict(rows.groupBy("part").agg(F.sum("tokens")).collect())      # one row for each partition
    of = np.zeros(max(totals, default=-1) + 1, dtype=np.int64)
    of[list(totals)] = list(totals.values())
    return np.concatenate([[0], np.cumsum(of)]).astype(np.int64)


def cut(rows: DataFrame, kind: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Second pass over the written table of `counted`: one row for each document and window that it reaches."""
    starts = rows.sparkSession.sparkContext.broadcast(partition_starts(rows))     # eight bytes for each partition
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "boundary"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = starts.value
        for b in batches:
            if not b.num_rows:
                continue
            tokens, part, before = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                                    for c in ("tokens", "part", "before"))
            place = begins[part] + before
            first, last = place // capacity, (place + tokens - 1) // capacity
            many = last - first + 1
            row = np.repeat(np.arange(b.num_rows), many)
            window = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            lo = np.maximum(place[row], window * capacity)
            hi = np.minimum((place + tokens)[row], (window + 1) * capacity)
            start = lo - place[row]
            edge = (window * capacity < begins[part][row]) | (
                np.minimum((window + 1) * capacity, begins[-1]) > begins[part + 1][row])
            data = memoryview(np.frombuffer(b"".join(b.column("ids").to_pylist()), dtype=kind).astype("<u4").tobytes())
            a = ((np.cumsum(tokens) - tokens)[row] + start) * 4
            z = a + (hi - lo) * 4
            spans = [data[i:j] for i, j in zip(a.tolist(), z.tolist())]
            columns = [b.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(hi - lo),
                       pa.array([zlib.crc32(x) for x in spans], pa.int64()), pa.array(tokens[row]),
                       pa.array(window), pa.array(lo - window * capacity), pa.array(edge)]
            if with_ids:
                columns.append(pa.array([bytes(x) for x in spans], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select("doc_id", "part", "before", "tokens", "ids").mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "boundary boolean" + ", ids binary" * with_ids)


def concatenate_and_cut(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, boundary (does the sequence reach into
    another partition?) and, if asked for, ids of every piece."""
    return cut(written(counted(docs, tokenizer_path), "ids"), stored_ids(tokenizer_path), capacity, with_ids)


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and ids (little-endian unsigned 32-bit) of every sequence, from pieces with ids."""
    schema = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, upto, held = None, 0, 0, []
        for b in batches:
            out: list[tuple] = []
            for seq, off, ids in zip(*(b.column(c).to_pylist() for c in ("sequence_id", "offset", "ids"))):
                if seq != now or off != upto:
                    if held:
                        out.append((now, at, b"".join(held)))
                    now, at, upto, held = seq, off, off, []
                held.append(ids)
                upto += len(ids) // 4
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((now, at, b"".join(held)), schema)], schema=schema)

    runs = written(pieces.select("sequence_id", "offset", "ids").mapInArrow(run, "sequence_id long, offset long, ids binary"), "runs")
    full = F.octet_length("ids") == 4 * capacity
    joined = (runs.filter(~full).groupBy("sequence_id")
              .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("runs"))
              .select("sequence_id", F.aggregate("runs", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids")))
    return runs.filter(full).select("sequence_id", "ids").unionByName(joined)

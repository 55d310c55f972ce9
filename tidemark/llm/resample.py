"""Target-distribution importance resampling by an Aho-Corasick dictionary of words (operator 11).

1. Texts become bytes in which A-Z are small and every byte that no word holds is a blank. A dictionary has words
   bounded by blanks on both sides; each carries its length and the CRC-32 of its bytes. The automaton scans many
   texts at once and emits one payload for each word that it knows; neighbours share the blank between them.
2. A word that the dictionary lacks is a gap between two payloads. It is hashed there and joins the dictionary, which
   is built again when enough words wait and starts afresh beyond `DICTIONARY_WORDS`: memory is bounded, every word
   is counted. Each worker has its own dictionary, so nothing about words is collected or broadcast.
3. CRCs of adjacent payloads compose: the CRC of "a b" follows from that of "a ", that of "b" and the length of
   "b". So runs of 1 to n words get their buckets without being spelled out.
4. Texts are scanned once: each document's buckets are written as whole numbers of two bytes (four beyond 65,536 buckets),
   a third of a text of common words. Counting: each task sums its features by bucket, and these rows are summed, for
   documents and target texts. That makes `buckets` gains. Scoring: what was written is read again, and the gains are summed
   over each document; Gumbel noise from its id is added.
5. Drawing: an approximate quantile, checked by an exact count, leaves the rows that can be drawn; they are sorted in ranges,
   and one total for each range gives the ranks. Rows get a number when they are written, so that equal ones lie in order.

Cases: a null text has no words; an empty one neither; a very long text is one row of one task, scanned in stretches of
`STRETCH` bytes; equal scores go by the smaller doc_id (null last), then by row number; repeated rows are scored and
drawn each; a null doc_id counts as empty text in the noise; empty tables give empty results, an empty target has zero
counts; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.quantiles import range_count
from tidemark.llm.common import slices, written

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
DICTIONARY_WORDS = 200_000   # words of a worker's dictionary at most
WORD_BYTES = 64              # longer words stay out of the dictionary
STRETCH = 1 << 20            # bytes scanned at once, about: the automaton's working copy has four times as many
GROWTH = 0.5                 # the dictionary is built again when this share of its words waits

BLANK = 32
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else BLANK
              for c in range(256))


def _zeros_operators() -> np.ndarray:
    """[k, byte place, byte]: what 2^k zero bytes make of a CRC register with this byte in this place."""
    table = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], dtype=np.uint32)
    step = np.zeros((4, 256), dtype=np.uint32)         # one zero byte: r -> table[r & 255] ^ (r >> 8)
    for place in range(4):
        r = np.arange(256, dtype=np.uint32) << np.uint32(8 * place)
        step[place] = table[r & 255] ^ (r >> np.uint32(8))
    out = [step]
    for _ in range(31):
        out.append(_apply(out[-1], out[-1].ravel()).reshape(4, 256))
    return np.stack(out)


def _apply(operator: np.ndarray, r: np.ndarray) -> np.ndarray:
    return (operator[0][r & 255] ^ operator[1][r >> np.uint32(8) & 255] ^ operator[2][r >> np.uint32(16) & 255]
            ^ operator[3][r >> np.uint32(24)])


_ZEROS = _zeros_operators()
_CRC_BLANK = np.uint32(zlib.crc32(b" "))


def compose(crc: np.ndarray, after: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of x + y from those of x and y and the number of bytes of y."""
    out = crc.astype(np.uint32)
    for k in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero(length >> k & 1)
        out[at] = _apply(_ZEROS[k], out[at])
    return out ^ after.astype(np.uint32)


class Dictionary:
    """Words with their CRCs and lengths behind an automaton; it learns what it meets."""

    def __init__(self, most: int = DICTIONARY_WORDS):
        self.most = most
        self.reset()

    def reset(self) -> None:
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.crc, self.length = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        self.waiting: dict[bytes, int] = {}

    def learn(self) -> None:
        if len(self.crc) + len(self.waiting) > self.most:
            new = self.waiting
            self.reset()
            self.waiting = dict(list(new.items())[:self.most])
        first = len(self.crc)
        for i, word in enumerate(self.waiting, first):
            self.automaton.add_word(f" {word.decode('latin-1')} ", i)
        self.automaton.make_automaton()
        self.crc = np.concatenate([self.crc, np.fromiter(self.waiting.values(), dtype=np.uint32, count=len(self.waiting))])
        self.length = np.concatenate([self.length, np.fromiter(map(len, self.waiting), dtype=np.int64, count=len(self.waiting))])
        self.waiting = {}

    def scan(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, CRC and length of every word of a folded text that begins and ends with a blank."""
        found = list(zip(*self.automaton.iter(text.decode("latin-1")))) if len(self.crc) else []
        ends = np.array(found[0] if found else (), dtype=np.int64)       # of the blank behind the word
        which = np.array(found[1] if found else (), dtype=np.int64)
        crc, length = self.crc[which], self.length[which]
        start = ends - length
        lo = np.concatenate([[0], ends])                                 # gaps: from a blank to a blank
        hi = np.concatenate([start - 1, [len(text) - 1]])
        inked = np.concatenate([[0], np.cumsum(np.frombuffer(text, dtype=np.uint8) != BLANK)])
        more: list[tuple[int, int, int]] = []
        for g in np.flatnonzero(inked[hi] > inked[lo]).tolist():
            at = int(lo[g])
            gap = text[at:int(hi[g]) + 1]
            upto = 0
            for word in gap.split():
                upto = gap.index(word, upto)
                value = self.waiting.get(word)
                if value is None:
                    value = zlib.crc32(word)
                    if len(word) <= WORD_BYTES and len(self.waiting) < self.most:
                        self.waiting[word] = value
                more.append((at + upto, value, len(word)))
                upto += len(word)
        if more:
            s, c, n = map(np.array, zip(*more))
            start, crc, length = np.concatenate([start, s]), np.concatenate([crc, c.astype(np.uint32)]), np.concatenate([length, n])
            order = np.argsort(start, kind="stable")
            start, crc, length = start[order], crc[order], length[order]
        if len(self.waiting) > max(4096, GROWTH * len(self.crc)):
            self.learn()
        return start, crc, length


_DICTIONARY = Dictionary()       # of this worker


def stretches(text: bytes) -> Iterator[tuple[int, bytes]]:
    """Stretches of a folded text with blanks at both ends, cut at blanks."""
    at = 0
    while at < len(text):
        end = at + STRETCH
        end = len(text) if end >= len(text) else text.find(b" ", end)
        end = len(text) if end < 0 else end
        yield at, b" " + text[at:end] + b" "
        at = end + 1


def features(texts: list[bytes], buckets: int, runs: tuple[int, int], words: Dictionary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; text number and bucket of every feature: runs[0] to runs[1] consecutive words."""
    lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(lens + 1) - lens - 1
    found = [(at + s - 1, c, n) for at, part in stretches(b" ".join(texts).translate(_FOLD)) for s, c, n in [words.scan(part)]]
    start, crc, length = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64),) * 3
    of = np.searchsorted(begins, start, side="right") - 1
    parts_of, parts = [], []
    now = crc.astype(np.uint32)
    for n in range(1, runs[1] + 1):
        if n > 1:                                       # one word more: adjacent payloads of one text compose
            if len(start) < n:
                break
            now = compose(compose(now[:-1], np.full(len(now) - 1, _CRC_BLANK), np.ones(len(now) - 1, dtype=np.int64)),
                          crc[n - 1:], length[n - 1:])
        if n >= runs[0]:
            ok = of[:len(of) - n + 1] == of[n - 1:]
            parts_of.append(of[:len(of) - n + 1][ok])
            parts.append(now[ok].astype(np.int64) % buckets)
    none = np.zeros(0, dtype=np.int64)
    return np.bincount(of, minlength=len(texts)), np.concatenate([none, *parts_of]), np.concatenate([none, *parts])


def _texts(b: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = b.column("text").cast(pa.binary()).to_pylist()
    for lo, hi in slices(texts, STRETCH):
        yield lo, hi, [x or b"" for x in texts[lo:hi]]


def number_type(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def featured(docs: DataFrame, buckets: int = BUCKETS, runs: tuple[int, int] = (1, 1)) -> DataFrame:
    """doc_id, n_words and features: the buckets of a text's features one behind the other, as `number_type` says."""
    number = number_type(buckets)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("features", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            for lo, hi, texts in _texts(b):
                n_words, of, bucket = features(texts, buckets, runs, _DICTIONARY)
                upto = np.cumsum(np.bincount(of, minlength=len(texts))).tolist()
                own = bucket[np.argsort(of, kind="stable")].astype(number)
                parts = [own[i:k].tobytes() for i, k in zip([0, *upto], upto)]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(n_words), pa.array(parts, pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, features binary")


def _numbers(values: pa.Array, number: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all rows of `featured`, and how many each row has."""
    rows = values.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=number), np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)) // number.itemsize


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows of `featured`."""
    number = number_type(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            total += np.bincount(_numbers(b.column("features"), number)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = rows.select("features").mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():       # `buckets` rows at most
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, rounded down."""
    buckets = len(source)
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of the rows of `featured`."""
    values = rows.sparkSession.sparkContext.broadcast(gain)         # one number for each bucket
    number = number_type(len(gain))
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = values.value
        for b in batches:
            ids, words = b.column("doc_id"), b.column("n_words")
            held = b.column("features").to_pylist()
            for lo, hi in slices(held, STRETCH):
                bucket, n = _numbers(pa.array(held[lo:hi], pa.binary()), number)
                before = np.concatenate([[0], np.cumsum(gain[bucket])])     # whole numbers
                upto = np.cumsum(n)
                weight = before[upto] - before[upto - n]
                own = ids.slice(lo, hi - lo)
                score = weight + np.array([noise(i, seed) for i in own.to_pylist()], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([own, words.slice(lo, hi - lo), *map(pa.array, (n, weight, score))], schema=schema)

    return rows.select("doc_id", "n_words", "features").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """The rows (with a unique column row) with their rank by descending score, null beyond `drawn`.

    An approximate quantile leaves out most rows that cannot be drawn, before anything is sorted.
    """
    n = rows.count()
    if not n or not drawn:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    cut = rows.agg(F.percentile_approx("score", max(0.0, 1 - 1.01 * drawn / n - 0.001), 10_000)).first()[0]
    above = F.col("score") >= cut
    if rows.filter(above).count() < drawn:
        above = F.lit(True)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    top = rows.filter(above)
    ranges = range_count(top.count())
    placed = written(top.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place")), "ranked")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("_part").agg(F.count("*").alias("n")).select(
        "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))          # one row for each range
    rank = F.col("_first") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    top = (placed.join(F.broadcast(firsts), "_part").withColumn("rank", F.when(rank <= drawn, rank))
           .drop("_part", "_place", "_first"))
    return top.unionByName(rows.filter(~above).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, runs: tuple[int, int] = (1, 1),
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document."""
    own = written(featured(docs, buckets, runs), "featured")
    wanted = featured(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, runs)
    gain = gains(bucket_counts(own, buckets), bucket_counts(wanted, buckets))
    rows = written(scored(own, gain, seed).withColumn("row", F.monotonically_increasing_id()), "scored")
    fit = F.col("n_words") >= min_words
    able = rows.filter(fit)
    out = ranked(able, percent * able.count() // 100).unionByName(
        rows.filter(~fit).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")

"""Document fingerprints by consistent weighted sampling (operator 8, built-in functions only).

A text is the multiset of its 5-word shingles (lower case; a text of fewer words is one shingle); a shingle's weight w
is its count. For each term, gamma-distributed r and c (shape 2) and a uniform b come from hashes of the term:

    t = floor(ln w / r + b),  y = exp(r (t - b)),  a = c / (y exp(r))

and the term with the least a is the consistent weighted sample; (term, t) of two texts' samples are equal with a
probability of their generalised Jaccard similarity. To draw BINS samples at the cost of one draw for each term, terms
are dealt into BINS bins by hash and each bin has its own sample. The sample is kept as its `a`, which no
other (term, t) shares; the fingerprint is the list of bins' samples. Likeness of two fingerprints is the number of
bins with equal samples over the number of bins that either fills.

All of it stays within a row: no text is exploded, nothing is grouped. The neighbour of a document, next in the order
of doc_id, is found by dealing documents to ranges of (doc_id, hash of the text) whose bounds are rows of the table;
the first document of a range is also sent to the range before, so that one shuffle of the texts serves all. A range
is one task's. Its text grows with the fourth root of the table (4 MB at 20 MB, 26 MB at 30 GB, 200 MB at 100 TB, which
the sort can spill), so that the bounds, 16 bytes each, stay below 10 MB there; nothing is capped.

Cases: a null text is empty and has an empty fingerprint; two empty fingerprints are alike (1), an empty and another
are not (0); rows of equal doc_id (ties, or many without one) are ordered by their text's hash and may lie in several
ranges; rows equal in both (repeated rows) are each other's neighbours and lie in one range, whose sort spills; a null
doc_id comes first; a very long text is one row, never cut, in arrays of its words; a table of one row is its own
neighbour; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_SPLIT, let, text_of
from tidemark.llm.decontam import SHINGLE

BINS = 64
RANGE_BYTES = 2 << 20  # of text in one range of a table of 1 MB; grows with the fourth root of the table's size
ROW_BYTES = 64         # that a row counts beside its text
_LOW = (1 << 26) - 1
_VALUE_BITS = 54       # of a sample; its bin is above


def _sample(term: Column, weight: Column | None, bins: int) -> Column:
    """One number for a term: its bin above its `a`, in steps of 2^-48. weight None: 1, where t is 0.

    The bits of a term, itself a hash, give its bin and r; two more hashes give c and b. Each is written once in the
    common case, because a lambda computes what is written twice two times.
    """
    own = bins.bit_length() - 1
    part = lambda x, skip: F.shiftright(x, skip).bitwiseAND(_LOW).cast("double") + 0.5 if skip else (
        x.bitwiseAND(_LOW).cast("double") + 0.5)
    gamma = lambda x, y: F.lit(52 * math.log(2)) - F.ln(x * y)
    r = gamma(part(term, own), part(term, own + 26))
    h = F.xxhash64(term, F.lit(1))
    c = gamma(part(h, 0), part(h, 26))
    b = part(F.xxhash64(term, F.lit(2)), 0) * (1.0 / (_LOW + 1))
    after = F.lit(1.0) - b if weight is None else F.floor(F.ln(weight.cast("double")) / r + b).cast("double") + (F.lit(1.0) - b)
    a = c * F.exp(-(r * after))
    value = F.least((a * float(1 << 48)).cast("long"), F.lit((1 << _VALUE_BITS) - 1))
    return F.coalesce(F.shiftleft(term.bitwiseAND(bins - 1), _VALUE_BITS).bitwiseOR(value), F.lit(0))


def with_fingerprint(df: DataFrame, text: str, name: str, bins: int = BINS) -> DataFrame:
    """df with the samples of a text column as a sorted array of longs, one for each bin that a term falls in.

    bins: a power of 2, 512 at most. The steps are columns of their own, so that sorting and hashing words stay
    outside of lambdas.
    """
    w, s, v = (F.col(f"_{name}_{x}") for x in "wsv")
    none = F.array().cast("array<long>")
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))
    terms = F.when(F.size(w) >= SHINGLE, runs).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(none)

    def repeated(s: Column) -> Column:
        n = F.size(s)
        first = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.get(s, i) != F.get(s, i - 1), F.lit(True)))
        weight = lambda at, i, k: F.coalesce(F.get(at, k + 1), n) - i
        return let(first, lambda at: F.transform(at, lambda i, k: F.when(
            weight(at, i, k) == 1, _sample(F.get(s, i), None, bins)).otherwise(_sample(F.get(s, i), weight(at, i, k), bins))))

    samples = F.when(F.size(F.array_distinct(s)) == F.size(s), F.transform(s, lambda x: _sample(x, None, bins))).otherwise(repeated(s))
    in_bins = F.filter(v, lambda x, i: F.coalesce(x.bitwiseXOR(F.get(v, i - 1)) >= (1 << _VALUE_BITS), F.lit(True)))
    return (df.withColumn(f"_{name}_w", F.array_remove(F.split(F.lower(F.col(text)), WORD_SPLIT), ""))
            .withColumn(f"_{name}_s", F.sort_array(terms)).drop(f"_{name}_w")
            .withColumn(f"_{name}_v", F.sort_array(samples)).drop(f"_{name}_s")
            .withColumn(name, in_bins).drop(f"_{name}_v"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples among the bins that either fingerprint fills; 1 for two empty ones."""
    bin_of = lambda x: F.transform(x, lambda v: F.shiftright(v, _VALUE_BITS))
    either = F.size(F.array_union(bin_of(a), bin_of(b)))
    return let(either, lambda n: F.when(n == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / n))


def as_text(samples: Column) -> Column:
    return F.array_join(F.transform(samples, lambda v: F.lower(F.hex(v))), ".")


def with_next(rows: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """rows (doc_id, t, more columns) with next: a struct of t and the further columns of the next document."""
    names = [c for c in rows.columns if c != "doc_id"]
    rows = rows.withColumns({"k": F.coalesce("doc_id", F.lit(-(1 << 63))), "h": F.xxhash64("t")})
    size = rows.agg(F.sum(F.octet_length("t") + ROW_BYTES)).first()[0] or 0
    # bounds are places (id, hash of the text) of the table, so a range is known to begin with its bound
    parts = max(1, math.ceil(size / (range_bytes * max(1, size / (1 << 20)) ** 0.25)))
    bounds = [(r.k, r.h) for r in rows.select("k", "h").repartitionByRange(parts, "k", "h").groupBy(F.spark_partition_id())
              .agg(F.min(F.struct("k", "h")).alias("b")).select("b.*").orderBy("k", "h").collect()]
    bounds = bounds or [(0, 0)]
    number = _range_of(F.col("k"), F.col("h"), bounds)
    parted = rows.withColumn("at", number).select(
        "*", F.col("at.number").alias("range"), F.pmod(F.col("at.number") - 1, F.lit(len(bounds))).alias("before"))
    own = F.struct(F.col("range").alias("to"), F.lit(False).alias("guest"))
    sent = F.when(F.col("at.first"), F.array(own, F.struct(F.col("before").alias("to"), F.lit(True).alias("guest")))).otherwise(F.array(own))
    dealt = parted.select("doc_id", "k", "h", *names, F.inline(sent))
    order = Window.partitionBy("to").orderBy("guest", "k", "h")
    return (dealt.repartitionById(len(bounds), "to").withColumn("next", F.lead(F.struct(*names)).over(order))
            .where("not guest").select("doc_id", *names, "next"))


def _range_of(k: Column, h: Column, bounds: list[tuple[int, int]]) -> Column:
    """(number of the range that holds (k, h), whether it is the range's bound), by halves.

    The bounds are two arrays, each written as one text that is folded into a constant once: neither the plan nor
    the code of a row grows with their number.
    """
    longs = lambda i: F.split(F.lit(",".join(str(b[i]) for b in bounds)), ",").cast("array<bigint>")
    ks, hs = longs(0), longs(1)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    after = lambda i: (F.get(ks, i) < k) | ((F.get(ks, i) == k) & (F.get(hs, i) <= h))
    # beyond the last bound the comparison is null, so the step is not taken
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(after(at + step), at + step).otherwise(at))
    return let(found, lambda i: F.struct(i.alias("number"), ((F.get(ks, i) == k) & (F.get(hs, i) == h)).alias("first")))


def fingerprints(docs: DataFrame, bins: int = BINS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    texts = docs.select(F.col("doc_id").cast("long"), text_of().alias("t"))
    rows = with_next(with_fingerprint(texts, "t", "own", bins))
    n = F.char_length("t")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.left(F.col("t"), n - quarter), F.left(F.col("next.t"), quarter))
    rows = with_fingerprint(rows.withColumn("n_chars", n.cast("long")).withColumn("e", edited), "e", "other", bins)
    return rows.select(
        "doc_id", "n_chars", F.sha2("e", 256).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next.own")).alias("near_next"))

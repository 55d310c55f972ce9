"""Benchmark decontamination by size-partitioned MinHash containment search (operator 4, built-in functions only).

A document contains a test item if it holds at least `threshold` of the item's distinct 5-word shingles anywhere in its
whole text; an item of one to four words is one shingle of that many words.

1. An item's sketch is its floor((1 - threshold) * n) + 1 least shingle hashes (bottom-k MinHash, k by its number n of
   shingles). A document that contains the item can miss at most floor((1 - threshold) * n) of its shingles, so it holds
   at least one of the sketch: the search loses nothing.
2. Sketches are partitioned by size: items of 1, 2 to 7, 8 to 31, ... shingles are classes, items of 1 to 4 words are
   classes of their own. Each class has a cut, the largest hash in its sketches. A document looks up a hash in a class
   only up to the class's cut, and the class is part of the join key. So an item of few shingles, whose hash may
   lie anywhere, makes its own class look up much, and no other.
3. What looked-up hashes meet are candidates, and these are verified by exact containment of the shingles themselves, not hashes.

Work and rows grow with documents plus matches, whatever their number; documents and items are joined by key only. Only
one cut for each class (some twenty numbers) goes through the driver.

Cases: texts are compared by lower-case runs of letters and digits; null or empty texts hold nothing, an item without any
word is never found; a very long text is one row, exploded as a stream; there are no ties, since every item that is
contained gives a row; repeated item rows count once, items of one id with different texts are told apart by text, an item
without an id counts; repeated documents are one document; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, text_of, word_array, written

SHINGLE = 5
THRESHOLD = 0.8


def _runs(words: Column, size: int, of: Callable[[list[Column]], Column]) -> Column:
    """of() the words of every run of `size` words, in order; none if there are fewer words."""
    def runs(w: Column) -> Column:
        at = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: of([F.get(w, i + j) for j in range(size)]))
    return let(words, runs)


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Hashes of the runs of `size` words, in order."""
    return _runs(words, size, lambda run: F.xxhash64(*run))


def shingles(words: Column, size: int = SHINGLE) -> Column:
    """The distinct runs of `size` words themselves, each as one string."""
    return F.array_distinct(_runs(words, size, lambda run: F.concat_ws(" ", *run)))


def size_class(n_words: Column, n: Column) -> Column:
    """0, 1, 2, ... for items of 1, 2 to 7, 8 to 31, ... shingles; -1 to -4 for those of so many words."""
    return F.when(n_words < SHINGLE, -n_words).otherwise(F.floor((F.log2(n.cast("double")) + 1) / 2)).cast("int")


def sketches(items: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(item_id, item_key, shingles, n) of each item, and (size_class, h, item_id, item_key) of the sketches."""
    words = items.select(F.col("item_id").cast("long"), word_array(text_of()).alias("w")).where(F.size("w") > 0)
    own = F.when(F.size("w") < SHINGLE, F.array(F.concat_ws(" ", "w"))).otherwise(shingles(F.col("w")))
    base = (words.select("item_id", F.size("w").alias("n_words"), own.alias("shingles"))
            .withColumn("item_key", F.xxhash64("shingles")).dropDuplicates(["item_id", "item_key"])
            .withColumn("n", F.size("shingles")))
    hashes = F.array_sort(F.array_distinct(F.transform("shingles", _of_string)))
    k = (F.floor(F.round((1 - threshold) * F.col("n"), 9)) + 1).cast("int")
    rows = base.select("item_id", "item_key", size_class(F.col("n_words"), F.col("n")).alias("size_class"),
                       F.explode(F.slice(hashes, F.lit(1), k)).alias("h"))
    return base.drop("n_words"), rows


def _of_string(shingle: Column) -> Column:
    """The hash that shingle_hashes gives for the shingle with this text, by its number of words."""
    def hashed(w: Column) -> Column:
        out = F.xxhash64(*[F.get(w, F.lit(j)) for j in range(SHINGLE)])
        for size in range(1, SHINGLE):
            out = F.when(F.size(w) == size, F.xxhash64(*[F.get(w, F.lit(j)) for j in range(size)])).otherwise(out)
        return out
    return let(F.split(shingle, " "), hashed)


def cuts_of(sketch: DataFrame) -> dict[int, int]:
    """The largest hash in the sketches of each size class: two numbers for each class."""
    return dict(sketch.groupBy("size_class").agg(F.max("h")).collect())


def lookups(words: Column, cuts: dict[int, int]) -> Column:
    """(size_class, h) of every hash that a document of these words looks up: in each class up to its cut."""
    entry = "array<struct<size_class:int,h:bigint>>"

    def upto(hashes: Column, c: int) -> Column:
        return F.transform(F.filter(hashes, lambda h: h <= F.lit(cuts[c])), lambda h: F.struct(F.lit(c).alias("size_class"), h.alias("h")))

    def of(hashes: Column, classes: list[int]) -> Column:
        return F.concat(*[upto(hashes, c) for c in classes])

    long = [c for c in sorted(cuts) if c >= 0]
    short = [c for c in sorted(cuts) if c < 0]
    parts = [let(shingle_hashes(words), lambda hashes: of(hashes, long))] if long else []
    parts += [of(shingle_hashes(words, -c), [c]) for c in short]
    return F.concat(F.array().cast(entry), *[p.cast(entry) for p in parts])


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_key, item_id, n_shared, n_item, containment of every document row's text and item contained in it."""
    base, sketch = sketches(items, threshold)
    base, sketch = written(base, "items"), written(sketch, "sketches")
    cuts = cuts_of(sketch)
    sizes = [SHINGLE, *(-c for c in cuts if c < 0)]           # words of the shingles that items have

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("t")).withColumn("text_key", F.xxhash64("t"))
    mine = rows.select("doc_id", "text_key", F.inline(lookups(word_array(F.col("t")), cuts)))
    candidates = written(mine.join(sketch, ["size_class", "h"]).select("doc_id", "text_key", "item_id", "item_key").distinct(), "candidates")

    # exact containment: only documents that met a sketch are shingled again
    met = candidates.select(F.coalesce("doc_id", F.lit(-1)).alias("k"), "text_key").distinct()
    whole = (rows.withColumn("k", F.coalesce("doc_id", F.lit(-1))).join(met, ["k", "text_key"], "left_semi")
             .dropDuplicates(["k", "text_key"])
             .select("k", "text_key", let(word_array(F.col("t")), lambda w: F.concat(*[shingles(w, n) for n in sizes])).alias("held")))
    shared = F.size(F.array_intersect("shingles", "held"))
    item = base.withColumnRenamed("item_id", "own_id")
    same = (candidates["item_key"] == item["item_key"]) & candidates["item_id"].eqNullSafe(item["own_id"])
    return (candidates.withColumn("k", F.coalesce("doc_id", F.lit(-1))).join(whole, ["k", "text_key"]).join(item, same)
            .select("doc_id", "text_key", "item_id", shared.cast("long").alias("n_shared"), F.col("n").cast("long").alias("n_item"))
            .withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("containment") >= threshold))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document (rows of equal doc_id and text are one) and item: doc_id, item_id, n_shared, n_item, containment."""
    found = contained_items(docs, items, threshold)
    return found.select("doc_id", "item_id", "n_shared", "n_item", "containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that contain no item."""
    bad = contained_items(docs, items, threshold).select(F.coalesce("doc_id", F.lit(-1)).alias("k"), "text_key").distinct()
    keyed = docs.withColumns({"k": F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), "text_key": F.xxhash64(text_of())})
    return keyed.join(bad, ["k", "text_key"], "left_anti").select(*docs.columns)

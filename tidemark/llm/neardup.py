"""Near-duplicate classes by DartMinHash signatures, banded joins and exact checks (operator 7).

A text is the multiset of its 5-word shingles (lower case; a text of fewer words is one shingle), weighted by their
counts; two texts are near duplicates if the generalised Jaccard similarity of these is at least `threshold`.

1. One pass over whole texts gives each row a digest of its words and, for the digest, `K` DartMinHash coordinates
   (tidemark.llm.dart) and their bands. Rows of equal digests are copies: a map-side aggregate makes one of them.
2. Bands are joined by key. No pairs within a bucket are listed: each bucket's *pivot*, its member met most often
   in all buckets, is compared with the others. Pairs whose signatures agree in less than `threshold` - 0.2 of
   their coordinates (six standard deviations) go; the rest are compared exactly on their texts.
3. Links make components. Buckets that still hold different components beside their pivot get another pivot, and so
   on while a round leaves at most half of their rows. For the rest, tiles of SIGNATURE_TILE rows of signatures tell
   which members of a bucket have anyone of another component near them by size and signature; only these meet with
   their texts, in tiles of TILE by TILE rows, and are compared exactly inside the tile: it gives links, never pairs.
   So no link is lost that shares a band: at similarity 0.8 that misses 2 links in 100,000, and nothing is capped.
4. All links make the classes; a row's class is the least doc_id among them.

Cases: a null text counts as empty; texts without any word are classed by their raw text; repeated rows are in one
class, and so are texts equal word for word (ties); a very long text is signed and compared whole;
a class of rows without doc_id has class_id null (class_key tells classes apart); an empty table gives an
empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, Memo, attached, emit, groups, lean, slices, text_of, written
from tidemark.llm.components import components
from tidemark.llm.dart import mix, signatures

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 28, 5
K = BANDS * ROWS
SLACK = 0.2                # six standard deviations of the estimate from K coordinates at 0.8
TILE = 256                 # members of a bucket, with their texts, in one side of a tile
SIGNATURE_TILE = 2048      # and with their signatures only
BATCH_CHARS = 1_500_000    # code points a task works on at once
BATCH_ROWS = 500           # and texts: each throws about K ln K + 2 K darts
WORDS_KEPT = 100_000       # hashes of words kept per Python worker


_WORD_HASH = Memo(xxhash.xxh3_64_intdigest, WORDS_KEPT)


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(text number, shingle hash, count) of every distinct shingle, and each text's digest."""
    hashes: list[int] = []
    lens = np.zeros(len(texts), dtype=np.int64)
    digests = []
    get = _WORD_HASH.__getitem__
    for i, t in enumerate(texts):
        words = WORD.findall(t.lower())
        lens[i] = len(words)
        if words:
            hashes.extend(map(get, words))
            digests.append(hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest())
        else:
            digests.append(hashlib.blake2b(b"\0" + t.encode("utf-8", "surrogatepass"), digest_size=16).digest())
    w = mix(np.array(hashes, dtype=np.uint64))
    of = np.repeat(np.arange(len(texts)), lens)
    starts = np.cumsum(lens) - lens
    parts_of, parts = [], []
    n = len(w)
    step = np.uint64(0x9FB21C651E98DF25)
    if n >= SHINGLE:
        h = w[:n - SHINGLE + 1].copy()
        for j in range(1, SHINGLE):
            h = h * step + w[j:n - SHINGLE + 1 + j]
        ok = of[:n - SHINGLE + 1] == of[SHINGLE - 1:]
        parts_of.append(of[:n - SHINGLE + 1][ok])
        parts.append(mix(h[ok]))
    for i in np.flatnonzero((lens > 0) & (lens < SHINGLE)):
        h = np.uint64(lens[i])
        with np.errstate(over="ignore"):
            for x in w[starts[i]:starts[i] + lens[i]]:
                h = h * step + x
        parts_of.append(np.array([i]))
        parts.append(mix(np.array([h], dtype=np.uint64)))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0), digests
    of, h = np.concatenate(parts_of), np.concatenate(parts)
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (h[1:] != h[:-1]))))
    counts = np.diff(np.append(new, len(h)))
    return of[new], h[new], counts.astype(np.float64), digests


def similarity(a: str, b: str) -> float:
    """Generalised Jaccard similarity of the shingle counts of two texts; 1 for equal texts without words."""
    of, h, n, digests = shingle_sets([a, b])
    if digests[0] == digests[1]:
        return 1.0
    left, right = of == 0, of == 1
    return _jaccard((h[left], n[left]), (h[right], n[right]))


def _jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Generalised Jaccard similarity of two (sorted hashes, counts)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    hit = b[0][at] == a[0]
    both = np.minimum(a[1][hit], b[1][at[hit]]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("digest", pa.binary()),
                     ("bands", pa.list_(pa.int64())), ("sig", pa.binary()), ("size", pa.int64())])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    band_step = np.uint64(0xD6E8FEB86659FD93)
    for b in batches:
        all_texts = b.column("t").to_pylist()
        for lo, hi in slices(all_texts, BATCH_CHARS, BATCH_ROWS):
            texts = all_texts[lo:hi]
            of, h, n, digests = shingle_sets(texts)
            full = np.unique(of)
            back = np.full(len(texts), -1)
            back[full] = np.arange(len(full))
            sig = signatures(back[of], h, n, len(full), K) if len(full) else np.zeros((0, K), np.uint64)
            keys = np.zeros((len(full), BANDS), dtype=np.uint64)
            for r in range(ROWS):
                keys = (keys * band_step) ^ mix(sig[:, r::ROWS] + np.uint64(r))
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            short = (sig >> np.uint64(48)).astype(np.uint16)
            bands = [keys[back[i]].tolist() if back[i] >= 0 else [] for i in range(len(texts))]
            sigs = [short[back[i]].tobytes() if back[i] >= 0 else b"" for i in range(len(texts))]
            sizes = np.bincount(of, weights=n, minlength=len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).slice(lo, hi - lo) for c in ("doc_id", "k1", "k2")),
                 pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary()),
                 pa.array(sizes)], schema=_SIGNED)


def row_keys(docs: DataFrame) -> DataFrame:
    """docs with k1, k2: 128 bits that tell rows of another doc_id or text apart, never null."""
    seen = (F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.col("doc_id").isNull(), F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumns({"k1": F.xxhash64(*seen), "k2": F.xxhash64(F.lit(17), *seen)})


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def _estimated(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of digests whose signatures agree in a share of at least `least` of the coordinates."""
    sig = lambda x: reps.select(F.col("digest").alias(x), F.col("sig").alias(f"sig_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                left, right = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, K) for c in ("sig_a", "sig_b"))
                yield b.select(["a", "b"]).filter(pa.array(_agree(left, right) >= least))

    return pairs.join(sig("a"), "a").join(sig("b"), "b").select("a", "b", "sig_a", "sig_b").mapInArrow(lean(run), "a binary, b binary")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose texts have at least this similarity."""
    text = lambda x: texts.select(F.col("digest").alias(x), F.col("t").alias(f"t_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near = [similarity(x, y) >= threshold for x, y in zip(b.column("t_a").to_pylist(), b.column("t_b").to_pylist())]
                yield b.select(["a", "b"]).filter(pa.array(near))

    return pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "t_a", "t_b").mapInArrow(lean(run), "a binary, b binary")


def _mixed(members: DataFrame, labels: DataFrame, pivots: DataFrame) -> DataFrame:
    """bucket, digest, comp of buckets whose members, but for their pivots so far, are of different components."""
    rest = (members.join(pivots.select("bucket", F.col("pivot").alias("digest")), ["bucket", "digest"], "left_anti")
            .join(labels.withColumnsRenamed({"node": "digest", "root": "comp"}), "digest", "left")
            .select("bucket", "digest", F.coalesce("comp", "digest").alias("comp")))
    name = F.xxhash64("comp")
    mixed = rest.groupBy("bucket").agg(F.min(name).alias("low"), F.max(name).alias("high")).where("low <> high")
    return written(rest.join(mixed, "bucket", "left_semi"), "mixed-buckets")


def _tiles(rows: DataFrame, reps: DataFrame, side: int) -> DataFrame:
    """rows of _mixed, with signatures, dealt to tiles (bucket, i, j) of `side` by `side` rows: each two of a bucket
    meet in a tile, but for two of its main component."""
    sizes = rows.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    main = (sizes.groupBy("bucket").agg(F.count("*").alias("comps"), F.sum("n").alias("all"),
                                        F.max(F.struct("n", "comp")).alias("main")).where("comps > 1")
            .select("bucket", F.col("main.comp").alias("main"),
                    F.ceil(F.col("main.n") / side).cast("int").alias("main_blocks"),
                    F.ceil((F.col("all") - F.col("main.n")) / side).cast("int").alias("rest_blocks")))
    rows = rows.join(main, "bucket").withColumn("is_main", F.col("comp") == F.col("main"))
    block = F.pmod(F.xxhash64("digest"), F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("rest_blocks"))).cast("int")
    x = F.col("x")
    return (rows.withColumn("block", block)
            .withColumn("x", F.explode(F.when(F.col("is_main"), F.sequence(F.lit(0), F.col("rest_blocks") - 1))
                                       .otherwise(F.sequence(-F.col("main_blocks"), F.col("rest_blocks") - 1))))
            # against the main component: (-1 - its block, own block); among the rest: (lower, higher block)
            .withColumn("i", F.when(F.col("is_main"), -1 - F.col("block")).when(x < 0, x).otherwise(F.least(x, F.col("block"))))
            .withColumn("j", F.when(F.col("is_main"), x).when(x < 0, F.col("block")).otherwise(F.greatest(x, F.col("block"))))
            .select("bucket", "i", "j", "digest", "comp", "is_main", "block")
            .join(reps.select("digest", "sig", "size", "bands"), "digest")
            # the bucket's place among the bands: a pair counts in the first band it shares
            .withColumn("band", F.array_position("bands", F.col("bucket")) - 1).drop("bands"))


def _meetings(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[tuple[dict, list[dict]]]:
    """A row of a tile, and rows of other components there that are near it by signature and size."""
    for (_, i, j), part in groups(batches, ["bucket", "i", "j"]):
        if i < 0:
            one, two = [r for r in part if r["is_main"]], [r for r in part if not r["is_main"]]
        else:
            one, two = [r for r in part if r["block"] == i], [r for r in part if r["block"] == j]
        if not one or not two:
            continue
        left, right = (np.frombuffer(b"".join(r["sig"] for r in s), np.uint16).reshape(-1, K) for s in (one, two))
        size = np.array([r["size"] for r in two])
        numbers: dict[bytes, int] = {}
        comp = np.array([numbers.setdefault(r["comp"], len(numbers)) for r in two])
        for p, row in zip(one, left):
            same = right == row
            near = (same.mean(axis=1) >= threshold - SLACK) & (comp != numbers.get(p["comp"], -1)) & (
                np.minimum(size, p["size"]) >= threshold * np.maximum(size, p["size"]))
            if near.any():
                near[near] = same[near].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == p["band"]
                yield p, [two[q] for q in np.flatnonzero(near)]


def _across(rows: DataFrame, reps: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links between different components of the buckets of _mixed: wide tiles of signatures tell who may have a
    partner at all, small tiles of texts compare these exactly."""
    def meets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            tile, told = None, set()
            for p, others in _meetings(batches, threshold):
                if (p["bucket"], p["i"], p["j"]) != tile:
                    tile = p["bucket"], p["i"], p["j"]
                    told.clear()
                for r in (p, *others) if others else ():
                    if r["digest"] not in told:     # once a tile, however many partners
                        told.add(r["digest"])
                        yield {"bucket": r["bucket"], "digest": r["digest"]}
        yield from emit(found(), pa.schema([("bucket", pa.int64()), ("digest", pa.binary())]))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[bytes, tuple] = {}

        def set_of(r):
            if r["digest"] not in sets:
                sets[r["digest"]] = shingle_sets([r["t"]])[1:3]
            return sets[r["digest"]]

        def found():
            tile = None
            for p, others in _meetings(batches, threshold):
                if (p["bucket"], p["i"], p["j"]) != tile:
                    tile = p["bucket"], p["i"], p["j"]
                    sets.clear()
                for other in others:
                    if _jaccard(set_of(p), set_of(other)) >= threshold:
                        a, b = sorted((p["digest"], other["digest"]))
                        yield {"a": a, "b": b}
        yield from emit(found(), pa.schema([("a", pa.binary()), ("b", pa.binary())]))

    def by_tile(tiles: DataFrame) -> DataFrame:
        return tiles.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    may = written(by_tile(_tiles(rows, reps, SIGNATURE_TILE)).mapInArrow(lean(meets), "bucket long, digest binary").distinct(), "may-link")
    few = rows.join(may, ["bucket", "digest"], "left_semi")
    return by_tile(_tiles(few, reps, TILE).join(texts, "digest")).mapInArrow(lean(links), "a binary, b binary").distinct()


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, k1, k2, digest, root (digest that names the class): one row per input row, a written table's join."""
    rows = row_keys(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    signed = written(rows.select(F.col("doc_id").cast("long"), "k1", "k2", text_of().alias("t")).mapInArrow(
        lean(_sign), "doc_id long, k1 long, k2 long, digest binary, bands array<long>, sig binary, size long"), "signed")
    reps = written(signed.where(F.size("bands") > 0).groupBy("digest").agg(
        F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig"), F.any_value("size").alias("size"),
        F.min("k1").alias("k1")), "distinct-texts")
    buckets = reps.select("digest", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = written(buckets.join(shared, "bucket"), "buckets")

    # texts of everything that meets anything, once
    wanted = members.select("digest").distinct().join(reps.select("digest", "k1"), "digest")
    texts = written(rows.join(wanted.select("k1").distinct(), "k1", "left_semi").select(text_of().alias("t"))
                    .mapInArrow(lean(_with_digest), "digest binary, t string").dropDuplicates(["digest"]), "met-texts")

    met = members.groupBy("digest").agg(F.sum("n").alias("met"))
    rows, used, links = members.select("bucket", "digest", F.col("digest").alias("comp")), None, None
    left = rows.count()
    while left:
        pivots = written(rows.join(met, "digest").groupBy("bucket").agg(F.max(F.struct("met", "digest", "comp")).alias("p"))
                         .select("bucket", F.col("p.digest").alias("pivot"), F.col("p.comp").alias("pivot_comp")), "pivots")
        pairs = (rows.join(pivots, "bucket").where("comp <> pivot_comp")
                 .select(F.least("digest", "pivot").alias("a"), F.greatest("digest", "pivot").alias("b")).distinct())
        found = written(_verified(_estimated(pairs, reps, threshold - SLACK), texts, threshold), "links")
        used = pivots if used is None else used.union(pivots)
        links = found if links is None else links.union(found)
        labels = components(links)
        rows, before = _mixed(members, labels, used), left
        left = rows.count()
        if 2 * left > before:
            break
    if left:
        more = written(_across(rows, reps, texts, threshold), "links")
        links = links.union(more)
        labels = components(links)
    if links is None:       # nothing meets anything
        labels = members.select(F.col("digest").alias("node"), F.col("digest").alias("root"))
    return attached(signed.select("doc_id", "k1", "k2", "digest"), labels.withColumnRenamed("node", "digest"), "digest", F.col("k1"),
                    "left").withColumn("root", F.coalesce("root", "digest"))


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            texts = b.column("t")
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(texts.to_pylist())[3], pa.binary()), texts], names=["digest", "t"])


def class_of_rows(found: DataFrame) -> DataFrame:
    """doc_id, class_id, class_key, class_size of every row of classes()."""
    # by digest first: copies of one text are one row before classes are joined back
    by_text = found.groupBy("digest", "root").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    by_class = by_text.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"))
    return attached(found.select("doc_id", "k1", "root"), by_class, "root", F.col("k1")).select(
        "doc_id", "class_id", F.lower(F.hex("root")).alias("class_key"), "class_size")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, one of each class: that with the least doc_id (null last), ties by row key."""
    found = written(classes(docs, threshold), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k1", "k2")
    by_text = found.groupBy("digest", "root").agg(F.min(order).alias("o"))
    kept = by_text.groupBy("root").agg(F.min("o").alias("o")).select("o.k1", "o.k2")
    return row_keys(docs).join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select(*docs.columns)

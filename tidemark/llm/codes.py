"""Vector code compression by cover-tree Lloyd (operator 13).

1. Components become whole numbers, floor(4096 x). Vectors are cut into `PARTS` equal parts; each task builds, for blocks of
   up to `BLOCK` vectors and each part position, a cover tree of the different parts: levels of halving radius, every node a
   point that covers its subtree. The trees are written once, with their points in tree order, so a subtree is a range.
2. A round of Lloyd's algorithm reads the trees. From the root down, a node whose nearest entry beats every other by more than
   twice the node's radius gives its whole subtree to that entry: by the triangle inequality no point of it can be nearer
   to another, and cumulative sums over the tree order give count and sum at once. The entries that stay possible go
   down with the ambiguous nodes, in the end to exact comparisons of points. All sums are whole numbers, so
   the partial sums of the blocks add up to the same codebook in any order.
3. Only codebooks (`PARTS` x `ENTRIES` entries) go to the driver and back; trees, sums and codes stay with Spark.
4. After the rounds the same descent gives each vector its codes, its error, and its label the sum of errors.

Cases: rows whose vector is null or has null or non-finite components are dropped; so no vector is left of an all-null
table or an empty one, and the result is empty. Vectors that do not divide into equal parts, or are shorter than the longest,
count as filled up with zeros. Components that would make squared distances leave 64 bits (beyond about 10,000 for 64
dimensions) are brought back to the bound. Of equal vec_ids, that with the smaller vector comes first (null
vec_id last); fewer than `ENTRIES` vectors give as many entries. Equal distances go to the lower index; repeated rows
are coded each; a null label is a label of its own; columns other than vec_id, embedding and label are ignored. Very
long texts and empty texts do not occur here; a very long vector is one row of one block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 2048             # vectors of one cover tree at most
BLOCK_COMPONENTS = 1 << 20   # and their components
LEAF = 64                # nodes of no more points are not divided further
LABELS_BROADCAST = 200_000   # labels whose sums are sent to every task; beyond, rows meet by label and a salt
SALT_ROWS = 100_000


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label and whole-number components v of the rows that have a finite vector."""
    x = F.col("embedding").cast("array<double>")
    fine = F.col("embedding").isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    return vectors.filter(fine).select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), x.alias("x"))


def dimensions(rows: DataFrame) -> int:
    """The length of the longest vector, rounded up to whole parts."""
    longest = rows.agg(F.max(F.size("x"))).first()[0] or 0
    return -(-longest // PARTS) * PARTS


def whole(x: list[np.ndarray], dims: int) -> np.ndarray:
    """floor(SCALE x), filled up with zeros; the bound keeps dims * (2 bound)^2 below 2^62."""
    out = np.zeros((len(x), dims), dtype=np.float64)
    for i, v in enumerate(x):
        out[i, :len(v)] = v
    bound = float(math.isqrt((1 << 60) // max(dims, 1)))
    return np.clip(np.floor(out * SCALE), -bound, bound).astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a from all of b, exact: by products of doubles where they hold them."""
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * most * most * max(a.shape[1], 1) < 1 << 53:
        x, y = a.astype(np.float64), b.astype(np.float64)
        d = (x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)
        return d.astype(np.int64)
    return np.stack([((a - c) ** 2).sum(axis=1) for c in b], axis=1) if len(b) else np.zeros((len(a), 0), dtype=np.int64)


class CoverTree:
    """Nodes level by level; points in tree order, so that a node's subtree is order[first:last]."""

    def __init__(self, order, center, radius, first, last, child, children):
        self.order, self.center, self.radius = order, center, radius
        self.first, self.last, self.child, self.children = first, last, child, children

    FIELDS = (("order", "<i4"), ("center", "<i4"), ("radius", "<f8"), ("first", "<i4"), ("last", "<i4"), ("child", "<i4"), ("children", "<i4"))

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        """A node covers its points within its level's radius; its children are a net of half that radius, itself first."""
        n, x = len(points), points.astype(np.float64)
        away_from = lambda net, rows: np.sqrt(((rows - x[net]) ** 2).sum(axis=1))
        order, dist = np.arange(n), away_from(0, x)     # dist: of a point (in tree order) from its lowest node's center
        center, radius, first, last, child, children = [0], [float(dist.max())], [0], [n], [0], [0]
        node = 0
        while node < len(center):
            lo, hi = first[node], last[node]
            if hi - lo > LEAF and radius[node] > 0:
                own, d = order[lo:hi].copy(), dist[lo:hi].copy()
                rows, net, groups, away = x[own], center[node], [], []
                half = radius[node] / 2
                while True:
                    near = d <= half
                    groups.append((net, own[near]))
                    away.append(d[near])
                    own, rows = own[~near], rows[~near]
                    if not len(own):
                        break
                    net = int(own[0])
                    d = away_from(net, rows)
                child[node], children[node] = len(center), len(groups)
                at = lo
                for (net, members), d in zip(groups, away):
                    order[at:at + len(members)], dist[at:at + len(members)] = members, d
                    center.append(net)
                    radius.append(float(d.max()))
                    first.append(at)
                    last.append(at + len(members))
                    child.append(0)
                    children.append(0)
                    at += len(members)
            node += 1
        return cls(*(np.array(x) for x in (order, center, radius, first, last, child, children)))

    def pack(self) -> dict[str, bytes]:
        return {name: getattr(self, name).astype(kind).tobytes() for name, kind in self.FIELDS}

    @classmethod
    def unpack(cls, data: dict[str, bytes]) -> CoverTree:
        return cls(*(np.frombuffer(data[name], dtype=kind) for name, kind in cls.FIELDS))

    def assign(self, points: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Index of the nearest entry of each point (in tree order), ties to the lower index; points in tree order.

        A node's own distances are exact. Doubles only decide whether a subtree may be given away, with a margin.
        """
        n, k = len(points), len(book)
        out = np.zeros(n, dtype=np.int64)
        place = np.empty(n, dtype=np.int64)
        place[self.order] = np.arange(n)
        nodes, possible = np.zeros(1, dtype=np.int64), np.ones((1, k), dtype=bool)
        while len(nodes):
            d = np.sqrt(squared(points[place[self.center[nodes]]], book).astype(np.float64))
            d[~possible] = np.inf
            nearest = d.argmin(axis=1)
            reach = d.min(axis=1) + 2 * self.radius[nodes] * (1 + 1e-9) + 1e-6
            possible = d <= reach[:, None]
            sure = possible.sum(axis=1) == 1
            for i, j, e in zip(self.first[nodes[sure]].tolist(), self.last[nodes[sure]].tolist(), nearest[sure].tolist()):
                out[i:j] = e
            nodes, possible = nodes[~sure], possible[~sure]
            inner = self.children[nodes] > 0
            leaves = nodes[~inner]
            if len(leaves):                                   # exact comparisons, all points of ambiguous leaves at once
                many = self.last[leaves] - self.first[leaves]
                at = np.repeat(self.first[leaves] - np.cumsum(many) + many, many) + np.arange(many.sum())
                exact = squared(points[at], book)
                exact[~np.repeat(possible[~inner], many, axis=0)] = np.iinfo(np.int64).max
                out[at] = exact.argmin(axis=1)
            nodes, possible = nodes[inner], possible[inner]
            many = self.children[nodes]
            possible = np.repeat(possible, many, axis=0)
            nodes = np.repeat(self.child[nodes] - np.cumsum(many) + many, many) + np.arange(many.sum())
        return out


_PART = pa.struct([("points", pa.binary()), *((name, pa.binary()) for name, _ in CoverTree.FIELDS)])
_PART_DDL = f"struct<points:binary,{','.join(f'{name}:binary' for name, _ in CoverTree.FIELDS)}>"


def _packed(points: np.ndarray, tree: CoverTree) -> dict[str, bytes]:
    kind = "<i4" if np.abs(points).max(initial=0) < 1 << 31 else "<i8"
    return {"points": points[tree.order].astype(kind).tobytes(), **tree.pack()}


def _unpacked(part: dict[str, bytes], n: int, width: int) -> tuple[np.ndarray, CoverTree]:
    kind = "<i4" if len(part["points"]) == 4 * n * width else "<i8"
    return np.frombuffer(part["points"], dtype=kind).astype(np.int64).reshape(n, width), CoverTree.unpack(part)


def trees(rows: DataFrame, dims: int) -> DataFrame:
    """One row for each block: how many vectors, their ids and labels, and for each part position points and tree."""
    schema = pa.schema([("n", pa.int32()), ("vec_id", pa.list_(pa.int64())), ("label", pa.list_(pa.string())), ("parts", pa.list_(_PART))])
    width = dims // PARTS
    size = max(1, min(BLOCK, BLOCK_COMPONENTS // max(dims, 1)))

    def block(ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        v = whole(vectors, dims)
        cut = [v[:, p * width:(p + 1) * width] for p in range(PARTS)]
        row = (len(v), ids, labels, [_packed(own, CoverTree.build(own)) for own in cut])
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []
        for b in batches:
            ids += b.column("vec_id").to_pylist()
            labels += b.column("label").to_pylist()
            x = b.column("x")
            flat, at = x.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(x.value_lengths().to_numpy())])
            vectors += [flat[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            while len(ids) >= size:
                yield block(ids[:size], labels[:size], vectors[:size])
                del ids[:size], labels[:size], vectors[:size]
        if ids:
            yield block(ids, labels, vectors)

    return rows.select("vec_id", "label", "x").mapInArrow(
        run, f"n int, vec_id array<long>, label array<string>, parts array<{_PART_DDL}>")


def first_entries(rows: DataFrame, dims: int) -> list[np.ndarray]:
    """The codebooks to begin with: parts of the ENTRIES smallest vec_ids."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()
    v = whole([np.array(r.x) for r in least], dims)
    width = dims // PARTS
    return [v[:, p * width:(p + 1) * width] for p in range(PARTS)]


def one_round(forest: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Each entry becomes the mean of its parts, rounded down; an unused one stays."""
    shared = forest.sparkSession.sparkContext.broadcast(books)       # PARTS x ENTRIES entries
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("value", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, total = shared.value, {}
        for b in batches:
            for row in range(b.num_rows):
                n, parts = b.column("n")[row].as_py(), b.column("parts")[row].as_py()
                for part, (packed, book) in enumerate(zip(parts, books)):
                    points, tree = _unpacked(packed, n, book.shape[1])
                    code = tree.assign(points, book)
                    # ranges of one code are ranges of the tree order: cumulative sums at their ends
                    ends = np.concatenate([np.flatnonzero(np.diff(code)) + 1, [n]])
                    begins = np.concatenate([[0], ends[:-1]])
                    sums = np.concatenate([np.zeros((1, book.shape[1]), dtype=np.int64), np.cumsum(points, axis=0)])
                    many, moved, entry = ends - begins, sums[ends] - sums[begins], code[begins]
                    for e in np.unique(entry).tolist():
                        own = entry == e
                        was = total.setdefault((part, e), [0] * (1 + book.shape[1]))
                        total[part, e] = [x + y for x, y in zip(was, [int(many[own].sum()), *moved[own].sum(axis=0).tolist()])]
        rows = [(p, e, i - 1, Decimal(x)) for (p, e), found in total.items() for i, x in enumerate(found)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    found = forest.select("n", "parts").mapInArrow(run, "part int, entry int, place int, value decimal(38,0)")
    out = [b.copy() for b in books]
    sums: dict[tuple[int, int], dict[int, int]] = {}
    for r in found.groupBy("part", "entry", "place").agg(F.sum("value").alias("value")).collect():     # the codebooks' numbers, once
        sums.setdefault((r.part, r.entry), {})[r.place] = int(r.value)
    for (part, entry), s in sums.items():
        n = s.pop(-1)
        out[part][entry] = [s[i] // n for i in range(len(s))]
    return out


def coded(forest: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error of every vector, from the trees of its block."""
    shared = forest.sparkSession.sparkContext.broadcast(books)
    wide = 2 * PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for b in batches:
            for row in range(b.num_rows):
                n, parts = b.column("n")[row].as_py(), b.column("parts")[row].as_py()
                codes, error = np.empty((n, PARTS), dtype="u1"), np.zeros(n, dtype=np.int64)
                for part, (packed, book) in enumerate(zip(parts, books)):
                    points, tree = _unpacked(packed, n, book.shape[1])
                    code = tree.assign(points, book)
                    codes[tree.order, part] = code
                    error[tree.order] += ((points - book[code]) ** 2).sum(axis=1)
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays([
                    b.column("vec_id")[row].values, b.column("label")[row].values,
                    pa.array([text[i:i + wide] for i in range(0, len(text), wide)]), pa.array(error)],
                    names=["vec_id", "label", "code", "error"])

    return forest.select("n", "vec_id", "label", "parts").mapInArrow(run, "vec_id long, label string, code string, error long")


def with_label_error(rows: DataFrame) -> DataFrame:
    """label_error: the sum of error over the rows of equal label. A label may hold any share of the rows."""
    sums = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"),
                                     F.count("*").alias("n"))
    sums = written(sums, "labels")
    labels, most = sums.agg(F.count("*"), F.max("n")).first()
    key = lambda side: F.struct(F.col(f"{side}.label").isNull(), F.coalesce(F.col(f"{side}.label"), F.lit("")))
    sums = sums.drop("n")
    if labels <= LABELS_BROADCAST:
        return rows.alias("a").join(F.broadcast(sums.alias("b")), key("a") == key("b")).select("a.*", "b.label_error")
    salts = max(1, (most or 0) // SALT_ROWS)
    salted = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    own = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    return own.alias("a").join(salted.alias("b"), (key("a") == key("b")) & (F.col("a.salt") == F.col("b.salt"))).select(
        *(f"a.{c}" for c in rows.columns), "b.label_error")


def codebooks_text(books: list[np.ndarray]) -> str:
    return ",".join(str(x) for book in books for entry in book.tolist() for x in entry)


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label (as text), code, error, label_error of every vector that is kept, and the codebooks."""
    rows = kept(vectors)
    dims = dimensions(rows)
    books = first_entries(rows, dims)
    forest = written(trees(rows, dims), "trees")
    for _ in range(rounds):
        books = one_round(forest, books)
    return with_label_error(written(coded(forest, books), "codes")), books


def codes(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    out, books = compress(vectors, rounds)
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))

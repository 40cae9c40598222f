"""Jaccard join of documents on word n-grams by vertical partitioning.

The global order of the n-grams is that of their 64-bit hashes; it is cut into fragments, which cut each document's set into segments.

Candidates: two sets of which the smaller has m n-grams and whose similarity is p % or more differ in at most (100 - p) m / p of them. With more
fragments than that, at least one segment is equal in both. So sets meet by (fragment, segment). Each cell of sizes has its own number
of fragments, one more than needed, so that a few empty segments take no link away; sets with more empty segments than that
meet by these as well. Sets of a size that may link with the cell below meet there too.

Counting: pairs of candidates are counted fragment by fragment. In each fragment of the n-grams that two chunks of sets share, the
partial overlaps of all their pairs are one product of two 0/1 matrices; the products are summed per pair, and the counting ends once no
pair can reach the similarity any more. The sum is exact.

Scale: documents with equal sets are one class. A group of sets that agree on a segment sends on a star to its least member, and an Arrow batch sends on
each segment once, so neither hot segments nor groups of near copies make pairs of rows. What is shuffled: about a fifth of a
number for each n-gram. Candidate groups, which are components of those stars, are dealt by size to chunks of about `BUDGET` n-grams; a task
holds two chunks and sends on one edge for each linked set, never all pairs. Partial counts are summed in the task that compares two chunks: to send them by pair would make a
row for each pair of a group.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, materialise
from .similar import SEED, mixed, shingle_sets, small
from .simhash import components, forest

WORDS, PERCENT = 3, 90
#: Each cell of sizes ends at this many times its beginning.
WIDTH = 1.4
#: N-grams in a chunk of a candidate group, sets and numbers in a matrix.
BUDGET, ROWS, CELLS = 1 << 18, 2048, 1 << 22


@cache
def edges(percent: int) -> tuple[int, ...]:
    """Where the cells of sizes begin; sets smaller than the first link with equal ones only."""
    out = [-(-percent // (100 - percent))] if percent < 100 else [1 << 62]
    while out[-1] < 1 << 40:
        out.append(int(out[-1] * WIDTH) + 1)
    return tuple(out)


def cells(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(cell, fragments, differences at most) of the one or two cells in which a set of n n-grams meets others."""
    e = edges(percent)
    c = bisect_right(e, n) - 1
    out = []
    for k in (c, c - 1):
        if k < 0 or k < c and 100 * (e[c] - 1) < percent * n:
            continue
        most = (100 - percent) * (e[k + 1] - 1) // percent
        out.append((k, most + 2, (100 - percent) * min(n, e[k + 1] - 1) // percent))
    return out


def segment_keys(h: np.ndarray, percent: int) -> np.ndarray:
    """A number for each (cell, fragment, segment) by which the sorted hashes of a set meet others."""
    out = []
    for cell, fragments, differ in cells(len(h), percent):
        at = ((h >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        here = at[begin]
        place = lambda f, cell=cell: mixed(f + np.uint64(cell << 40), 1)
        out.append(mixed(np.add.reduceat(mixed(h, 0), begin) + place(here), 1))
        if len(here) <= differ:  # so many are empty that no other segment need be equal
            empty = np.setdiff1d(np.arange(fragments, dtype=np.uint64), here)
            out.append(mixed(place(empty), 1))
    return np.concatenate(out) if out else h[:0]


def _kind(h: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(h.tobytes(), SEED)).view(np.int64))


def sets(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, t, kind, n) of docs(doc_id, text): hash of the text, hash and size of its set of n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(_kind(h), len(h)) for h in shingle_sets(b.column("text").to_pylist(), k)]
            kind, n = (pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 2))
            yield batch(doc_id=b.column("doc_id"), t=b.column("t"), kind=kind, n=n)

    name = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, f"doc_id {name}, t bigint, kind bigint, n bigint")


def candidates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(u, v): stars of the sets that share a segment.

    Of the sets of an Arrow batch that share a segment only the least is sent on with it; the others are sent once, as pairs
    with that one under a number of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, keys = [], []
            for h in shingle_sets(b.column("text").to_pylist(), k):
                keys.append(segment_keys(h, percent))
                kinds.append(np.full(len(keys[-1]), _kind(h), dtype=np.int64))
            key, kind = np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(kinds or [np.zeros(0, np.int64)])
            order = np.lexsort((kind, key))
            key, kind = key[order], kind[order]
            first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=bool)
            u, v = forest(kind, kind[first][np.cumsum(first) - 1]) if len(key) else (kind, kind)
            own = mixed(mixed(u.view(np.uint64), 0) + v.view(np.uint64), 1)
            yield batch(key=pa.array(np.concatenate([key[first], own, own]).view(np.int64)), kind=pa.array(np.concatenate([kind[first], u, v])))

    rows = docs.select("text").where("text is not null").mapInArrow(run, "key bigint, kind bigint")
    least = F.min("kind").over(Window.partitionBy("key"))
    return rows.select(F.col("kind").alias("u"), least.alias("v")).where("u != v")


class Chunk:
    """Sets of a candidate group: their kinds, sizes, and (row, n-gram) of all their n-grams."""

    def __init__(self, items: pa.StructArray):
        self.kind = items.field(0).to_numpy(zero_copy_only=False)
        lists = items.field(1)
        ends = lists.offsets.to_numpy()  # into the values of the whole batch
        self.hashes = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].view(np.uint64)
        self.n = np.diff(ends).astype(np.int64)
        self.row = np.repeat(np.arange(len(self.n)), self.n)


def shared(a: Chunk, b: Chunk) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], int]:
    """(row, place in the global order) of the n-grams that stand in both chunks, in that order, and their number."""
    _, at = np.unique(np.concatenate([a.hashes, b.hashes]), return_inverse=True)
    of_a, of_b = at[: len(a.hashes)], at[len(a.hashes) :]
    size = int(at.max()) + 1 if len(at) else 0
    both = (np.bincount(of_a, minlength=size) > 0) & (np.bincount(of_b, minlength=size) > 0)
    if a is b:
        both &= np.bincount(of_a, minlength=size) > 1
    place = np.cumsum(both) - 1
    out = []
    for row, of in ((a.row, of_a), (b.row, of_b)):
        row, of = row[both[of]], place[of[both[of]]]
        order = np.argsort(of, kind="stable")
        out.append((row[order], of[order]))
    return out[0], out[1], int(both.sum())


def overlaps(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], rows: tuple[int, int], size: int, need: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Sums per pair of the partial overlaps by fragment; sums that can't reach `need` may be left unfinished."""
    total = np.zeros(rows, dtype=np.float32)
    width = max(1, cells // max(1, sum(rows)))
    rest = [np.bincount(x[0], minlength=m).astype(np.float32) for x, m in zip((a, b), rows)]
    for begin in range(0, size, width):
        part = []
        for (row, place), m, left in zip((a, b), rows, rest):
            lo, hi = np.searchsorted(place, (begin, begin + width))
            segment = np.zeros((m, min(width, size - begin)), dtype=np.float32)
            segment[row[lo:hi], place[lo:hi] - begin] = 1
            left -= np.bincount(row[lo:hi], minlength=m)
            part.append(segment)
        total += part[0] @ part[1].T
        if not (total + np.minimum(rest[0][:, None], rest[1][None, :]) >= need).any():
            break
    return total


def spanning(linked: np.ndarray, kind_a: np.ndarray, kind_b: np.ndarray) -> tuple[list[int], list[int]]:
    """Pairs of kinds with the same components as the links of a matrix: one for each set but the first of a component."""
    us, vs = [], []
    fresh_a, fresh_b = linked.any(axis=1), linked.any(axis=0)
    for i in np.flatnonzero(fresh_a).tolist():
        if not fresh_a[i]:
            continue
        fresh_a[i] = False
        hub, front = int(kind_a[i]), np.array([i])
        while len(front):
            to_b = np.flatnonzero(linked[front].any(axis=0) & fresh_b)
            fresh_b[to_b] = False
            front = np.flatnonzero(linked[:, to_b].any(axis=1) & fresh_a)
            fresh_a[front] = False
            new = np.concatenate([kind_b[to_b], kind_a[front]])
            us += new.tolist()
            vs += [hub] * len(new)
    return us, vs


def chunk_links(a: Chunk, b: Chunk | None, percent: int, rows: int = ROWS, cells: int = CELLS) -> tuple[list[int], list[int]]:
    """Pairs of kinds with the same components as all links between two chunks (b None: inside one)."""
    inside = b is None
    b = a if inside else b
    of_a, of_b, size = shared(a, b)
    us, vs = [], []
    for s in range(0, len(a.n), rows):
        for t in range(s if inside else 0, len(b.n), rows):
            n, m = a.n[s : s + rows], b.n[t : t + rows]
            some = []
            for (row, place), begin, count in ((of_a, s, len(n)), (of_b, t, len(m))):
                here = (row >= begin) & (row < begin + count)
                some.append((row[here] - begin, place[here]))
            need = percent * (n[:, None] + m[None, :]) / (100 + percent)
            if inside and s == t:
                need[np.diag_indices(len(n))] = np.inf
            total = overlaps(*some, (len(n), len(m)), size, need - 0.5, cells)
            linked = (100 + percent) * np.rint(total).astype(np.int64) >= percent * (n[:, None] + m[None, :])
            if inside and s == t:
                linked[np.diag_indices(len(n))] = linked.any(axis=1)  # so that a row and its column are one set
            u, v = spanning(linked, a.kind[s : s + rows], b.kind[t : t + rows])
            us += u
            vs += v
    return us, vs


def links(docs: DataFrame, members: DataFrame, k: int = WORDS, percent: int = PERCENT, budget: int = BUDGET) -> DataFrame:
    """(u, v): links among members(kind, group, n, doc_id, t), whose texts are read from docs again; one edge for each set of two chunks at most."""
    # Sizes that may link are in the same cell or in neighbouring ones.
    cell = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int") if percent < 100 else F.lit(0)
    members = members.withColumn("cell", cell)
    total = materialise(members.groupBy("group", "cell").agg(F.ceil(F.sum("n") / budget).cast("int").alias("chunks")))
    wanted = members.join(total, ["group", "cell"]).withColumn("chunk", F.expr("cast(pmod(xxhash64(kind), chunks) as int)"))
    wanted = small(materialise(wanted.select("kind", "group", "cell", "chunk", F.col("doc_id").alias("of_doc"), "t")))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("t")).join(wanted, "t").where(F.col("doc_id").eqNullSafe(F.col("of_doc")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = list(shingle_sets(b.column("text").to_pylist(), k))
            right = pa.array([_kind(h) == want for h, want in zip(found, b.column("kind").to_pylist())], pa.bool_())
            grams = pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))
            yield batch(**{c: b.column(c) for c in ("group", "cell", "chunk", "kind")}, grams=grams).filter(right)

    rows = texts.select("text", "group", "cell", "chunk", "kind").mapInArrow(read, "group bigint, cell int, chunk int, kind bigint, grams array<bigint>")
    # A class stands for one row of docs; where rows are repeated, any of them will do.
    rows = rows.groupBy("group", "cell", "chunk", "kind").agg(F.first("grams").alias("grams"))
    tiles = materialise(rows.groupBy("group", "cell", "chunk").agg(F.collect_list(F.struct("kind", "grams")).alias("a")))
    alone = tiles.select("a", F.lit(None).cast(tiles.schema["a"].dataType).alias("b"))
    right = tiles.select("group", F.col("cell").alias("cell_b"), F.col("chunk").alias("chunk_b"), F.col("a").alias("b"))
    there = total.select("group", F.col("cell").alias("cell_b"), F.col("chunks").alias("chunks_b"))
    left = tiles.withColumn("step", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("cell_b", F.col("cell") + F.col("step"))
    left = left.join(there, ["group", "cell_b"]).withColumn("first_b", F.expr("if(step = 0, chunk + 1, 0)")).where("first_b < chunks_b")
    left = left.withColumn("chunk_b", F.explode(F.expr("sequence(first_b, chunks_b - 1)")))
    pairs = alone.union(left.join(right, ["group", "cell_b", "chunk_b"]).select("a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for r in range(len(some)):
                b = some.column("b")[r]
                u, v = chunk_links(Chunk(some.column("a")[r].values), Chunk(b.values) if b.is_valid else None, percent)
                yield batch(u=pa.array(u, pa.int64()), v=pa.array(v, pa.int64()))

    return pairs.mapInArrow(run, "u bigint, v bigint")


def join(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, budget: int = BUDGET) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs(doc_id, text; other columns are ignored).

    A document's set holds its distinct k-word n-grams, A-Z lower-cased, words between ASCII white space; fewer words are one. Documents link if
    100 * intersection >= percent * union. component_id: the smallest doc_id that can be reached by links, itself included. Null texts and
    texts without a word have empty sets and link with nothing, not even each other: each is its own component. Repeated rows stay. Rows with a null doc_id get the
    component of their links, null if all of it lacks an id. An empty table gives no row.
    """
    if not 100 / WIDTH < percent <= 100:
        raise ValueError(f"percent must be over {100 / WIDTH:.0f}, so that sets link with those of neighbouring cells only, and 100 at most")
    rows = materialise(sets(docs, k))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")).alias("first")
    classes = rows.where("n > 0").groupBy("kind").agg(F.first("n").alias("n"), first)
    classes = materialise(classes.select("kind", "n", "first.doc_id", "first.t"))
    found = components(candidates(docs, k, percent))
    members = materialise(classes.join(found.select(F.col("node").alias("kind"), F.col("root").alias("group")), "kind"))
    roots = components(links(docs, members, k, percent, budget))
    ids = classes.join(roots, F.col("kind") == F.col("node"), "left").select("kind", "doc_id", F.coalesce("root", "kind").alias("root"))
    least = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = materialise(ids.join(least, "root").select("kind", "component_id"))
    # Stored on both sides, so that Spark can split a class that holds a large share of the rows.
    told = rows.where("n > 0").join(ids, "kind").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return told.union(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))

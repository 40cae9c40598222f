"""Near-duplicate documents: SimHash by tiled exact comparison, then exact similarity of word shingles.

Documents are linked if the Jaccard similarity of their sets of 5-word shingles is 0.8 or more. Candidates come from 128-bit
SimHash fingerprints of the sets: tiles of fingerprints are compared whole, by numpy exclusive-or and bit counts, but for pairs of
tiles whose population counts differ beyond the radius or whose set sizes rule the similarity out. Candidates are verified by their
shingles. At a similarity of 0.8 two fingerprints differ in 19 of 128 bits on average (standard deviation 4) and in more than the radius
of 32 in about 1 of 1,000 cases, unrelated ones in fewer than that in about 1 of 10^8; population counts alone skip little at such a radius, sizes most.

Scale: documents with the same set are one class before anything is compared. A tile pair sends on a spanning forest of
its candidates and, once verified, of its links, never all pairs. A group of candidates is dealt to chunks of about `BUDGET` shingles, so a
task holds two chunks however many near copies a group has. Lists of ids are broadcast up to `BROADCAST_ROWS` rows, else shuffled.
Comparisons grow with the square of the distinct sets of like size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, materialise
from .simhash import BLOCK, SEED, components, forest

WORDS = 5
SIMILARITY = 0.8
RADIUS = 32
#: Fingerprints in a tile, and shingles in a chunk of a candidate group.
TILE, BUDGET = 8192, 1 << 18
#: Ids that are broadcast at most: some 50 MB.
BROADCAST_ROWS = 500_000

BASE = np.uint64(0x9E3779B97F4A7C15)
_MIXERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def shingle_sets(texts: list[str | None], k: int, group: int = 500) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of its k-word shingles: A-Z lower-cased, words between ASCII white space.

    Fewer words are one shingle; no word: an empty set. Arrow splits a group of texts and finds its different words, which are hashed
    once a group; nothing is kept from one group to the next.
    """
    for s in range(0, len(texts), group):
        split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array([t or "" for t in texts[s : s + group]], pa.large_string())))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), dtype=np.uint64, count=len(words))
        at = coded.indices.to_numpy()
        filled = np.fromiter(map(len, words), dtype=np.int64, count=len(words))[at] > 0
        ends = np.concatenate([[0], np.cumsum(filled)])[split.offsets.to_numpy()].tolist()
        x = hashes[at[filled]]
        for a, b in zip(ends, ends[1:]):
            yield _shingles(x[a:b], k)


def _shingles(x: np.ndarray, k: int) -> np.ndarray:
    if not len(x):
        return x
    k = min(k, len(x))
    h = np.full(len(x) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        h = h * BASE + x[i : len(x) - k + 1 + i]
    return np.unique(mixed(h, 0))


def mixed(h: np.ndarray, which: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIXERS[which]
    return h ^ (h >> np.uint64(31))


def fingerprint(h: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers; a bit is set if it is set in over half of the hashes."""
    out = []
    for which in (0, 1):
        bits = np.zeros(64, dtype=np.int64)
        for s in range(0, len(h), 1 << 16):
            x = mixed(h[s : s + (1 << 16)] + BASE, which).astype("<u8")
            bits += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * bits > len(h), bitorder="little").view("<i8")[0]))
    return out[0], out[1]


def _kind(h: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(h.tobytes(), SEED)).view(np.int64))


def sketches(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, t, kind, n, f0, f1) of docs(doc_id, text): hash of the text, hash and size of its set of shingles, fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(_kind(h), len(h), *fingerprint(h)) for h in shingle_sets(b.column("text").to_pylist(), k)]
            kind, n, f0, f1 = (pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 4))
            yield batch(doc_id=b.column("doc_id"), t=b.column("t"), kind=kind, n=n, f0=f0, f1=f1)

    name = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, f"doc_id {name}, t bigint, kind bigint, n bigint, f0 bigint, f1 bigint")


def near(a: np.ndarray, b: np.ndarray, radius: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two tiles with rows (n, f0, f1): fingerprints within the radius, and sizes that don't rule the similarity out."""
    distance = np.bitwise_count(a[:, 1, None] ^ b[None, :, 1])
    distance += np.bitwise_count(a[:, 2, None] ^ b[None, :, 2])
    i, j = np.nonzero(distance <= radius)
    n, m = a[i, 0].astype(np.int64), b[j, 0].astype(np.int64)
    fits = np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9
    return i[fits], j[fits]


def candidate_links(classes: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """(u, v): a spanning forest, tile pair by tile pair, of the candidates among classes(kind, n, f0, f1)."""
    counts = F.bit_count("f0") + F.bit_count("f1")
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / similarity)) + 1e-9).cast("int")
    cells = classes.where("n > 0").select("kind", "n", "f0", "f1", size.alias("size"), F.floor(counts / (radius + 1)).cast("int").alias("bits"))
    chunks = cells.groupBy("size", "bits").agg(F.ceil(F.count("*") / tile).cast("int").alias("chunks"))  # a few hundred cells
    dealt = cells.join(F.broadcast(chunks), ["size", "bits"]).withColumn("chunk", F.expr("pmod(xxhash64(kind), chunks)"))
    tiles = dealt.groupBy("size", "bits", "chunk").agg(F.collect_list(F.struct("kind", "n", "f0", "f1")).alias("a"))
    # Sizes whose quotient is over the similarity, and counts within the radius, are in the same cell or in neighbouring ones.
    steps = F.array(*[F.struct(F.lit(s).alias("ds"), F.lit(b).alias("db")) for s, b in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    left = tiles.select("*", F.inline(steps)).join(F.broadcast(chunks.select(F.col("size").alias("s2"), F.col("bits").alias("b2"), "chunks")), F.expr("s2 = size + ds and b2 = bits + db"))
    left = left.withColumn("c2", F.explode(F.expr("if(ds = 0 and db = 0, sequence(chunk, chunks - 1), sequence(0, chunks - 1))")))
    right = tiles.select(F.col("size").alias("s2"), F.col("bits").alias("b2"), F.col("chunk").alias("c2"), F.col("a").alias("b"))
    pairs = left.join(right, ["s2", "b2", "c2"])
    same = (F.col("ds") == 0) & (F.col("db") == 0) & (F.col("chunk") == F.col("c2"))
    pairs = pairs.select("a", F.when(~same, F.col("b")).alias("b"))

    def table(items: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
        kind, *rest = (items.field(k).to_numpy(zero_copy_only=False) for k in range(4))
        return kind, np.stack(rest, axis=1).astype(np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for r in range(len(some)):
                kind, a = table(some.column("a")[r].values)
                inside = not some.column("b")[r].is_valid
                other, b = (kind, a) if inside else table(some.column("b")[r].values)
                us, vs = [kind[:0]], [kind[:0]]
                step = max(1, BLOCK // len(b))
                for s in range(0, len(a), step):
                    i, j = near(a[s : s + step], b, radius, similarity)
                    if inside:
                        i, j = i[i + s < j], j[i + s < j]
                    if len(i):
                        u, v = forest(kind[s + i], other[j])
                        us.append(u)
                        vs.append(v)
                u, v = forest(np.concatenate(us), np.concatenate(vs)) if len(us) > 1 else (us[0], vs[0])
                yield batch(u=pa.array(u, pa.int64()), v=pa.array(v, pa.int64()))

    return pairs.mapInArrow(run, "u bigint, v bigint")


class Chunk:
    """Members of a candidate group with their shingles."""

    def __init__(self, items: pa.StructArray):
        self.kind = items.field(0).to_numpy(zero_copy_only=False)
        lists = items.field(1)
        ends = lists.offsets.to_numpy()  # into the values of the whole batch
        self.hashes = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].view(np.uint64)
        self.ends = (ends - ends[0]).astype(np.int64)
        self.prints = np.array([(self.ends[k + 1] - self.ends[k], *fingerprint(self.of(k))) for k in range(len(self.kind))], dtype=np.int64).view(np.uint64)

    def of(self, k: int) -> np.ndarray:
        return self.hashes[self.ends[k] : self.ends[k + 1]]

    def common(self, h: np.ndarray, some: np.ndarray) -> np.ndarray:
        """How many of the sorted hashes h each of some members has."""
        size = self.ends[some + 1] - self.ends[some]
        begin = np.cumsum(size) - size
        x = self.hashes[np.repeat(self.ends[some] - begin, size) + np.arange(size.sum())]
        at = np.minimum(np.searchsorted(h, x), len(h) - 1)
        return np.add.reduceat((h[at] == x).astype(np.int64), begin)


def chunk_links(a: Chunk, b: Chunk | None, radius: int, similarity: float) -> tuple[list[int], list[int]]:
    """Verified links (kinds) with the same components as all links between two chunks (b None: inside one)."""
    inside = b is None
    b = a if inside else b
    label = np.arange(len(b.kind)) if inside else np.arange(len(a.kind) + len(b.kind))
    shift = 0 if inside else len(a.kind)
    us, vs = [], []
    for p in range(len(a.kind)):
        _, j = near(a.prints[p : p + 1], b.prints, radius, similarity)
        j = j[(label[shift + j] != label[p]) & (j > (p if inside else -1))]
        if not len(j):
            continue
        h = a.of(p)
        both = b.common(h, j)
        n = len(h) + b.ends[j + 1] - b.ends[j] - both
        for q in j[both >= similarity * n - 1e-9].tolist():
            if label[shift + q] != label[p]:
                label[label == label[shift + q]] = label[p]
                us.append(int(a.kind[p]))
                vs.append(int(b.kind[q]))
    return us, vs


def small(df: DataFrame) -> DataFrame:
    """df, stored, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def verified_links(docs: DataFrame, members: DataFrame, k: int, radius: int, similarity: float, budget: int = BUDGET) -> DataFrame:
    """(u, v): links among members(kind, group, n, doc_id, t), whose shingles are read from docs again; a spanning forest of each chunk pair."""
    total = members.groupBy("group").agg(F.ceil(F.sum("n") / budget).cast("int").alias("chunks"))
    wanted = members.join(total, "group").withColumn("chunk", F.expr("pmod(xxhash64(kind), chunks)"))
    wanted = small(materialise(wanted.select("kind", "group", "chunks", "chunk", F.col("doc_id").alias("of_doc"), "t")))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("t")).join(wanted, "t").where(F.col("doc_id").eqNullSafe(F.col("of_doc")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(shingle_sets(b.column("text").to_pylist(), k))
            right = pa.array([_kind(h) == want for h, want in zip(sets, b.column("kind").to_pylist())], pa.bool_())
            shingles = pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))
            yield batch(**{c: b.column(c) for c in ("group", "chunks", "chunk", "kind")}, shingles=shingles).filter(right)

    rows = texts.select("text", "group", "chunks", "chunk", "kind").mapInArrow(read, "group bigint, chunks int, chunk bigint, kind bigint, shingles array<bigint>")
    tiles = materialise(rows.groupBy("group", "chunks", "chunk").agg(F.collect_list(F.struct("kind", "shingles")).alias("a")))
    alone = tiles.select("a", F.lit(None).cast(tiles.schema["a"].dataType).alias("b"))
    more = tiles.where("chunk < chunks - 1").withColumn("other", F.explode(F.expr("sequence(chunk + 1, cast(chunks - 1 as bigint))")))
    right = tiles.where("chunk > 0").select("group", F.col("chunk").alias("other"), F.col("a").alias("b"))
    pairs = alone.union(more.join(right, ["group", "other"]).select("a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for r in range(len(some)):
                b = some.column("b")[r]
                u, v = chunk_links(Chunk(some.column("a")[r].values), Chunk(b.values) if b.is_valid else None, radius, similarity)
                yield batch(u=pa.array(u, pa.int64()), v=pa.array(v, pa.int64()))

    return pairs.mapInArrow(run, "u bigint, v bigint")


def groups(docs: DataFrame, k: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS, tile: int = TILE, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """Stored sketches of docs, and (kind, component_id) for each class of equal sets: the smallest doc_id that can be reached by links."""
    rows = materialise(sketches(docs, k))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")).alias("first")
    classes = rows.groupBy("kind").agg(F.first("n").alias("n"), F.first("f0").alias("f0"), F.first("f1").alias("f1"), first)
    classes = materialise(classes.select("kind", "n", "f0", "f1", "first.doc_id", "first.t"))
    found = components(candidate_links(classes, radius, similarity, tile))
    members = materialise(classes.join(found.select(F.col("node").alias("kind"), F.col("root").alias("group")), "kind"))
    roots = components(verified_links(docs, members, k, radius, similarity, budget))
    ids = classes.join(roots, F.col("kind") == F.col("node"), "left").select("kind", "doc_id", F.coalesce("root", "kind").alias("root"))
    least = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows, materialise(ids.join(least, "root").select("kind", "component_id"))


def near_duplicates(docs: DataFrame, k: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS, tile: int = TILE, budget: int = BUDGET) -> DataFrame:
    """(doc_id, component_id) for every row of docs(doc_id, text; other columns are ignored).

    component_id is the smallest doc_id that can be reached by links. Null texts and texts without a word are equal to each other and
    to nothing else. Repeated rows stay. Rows with a null doc_id get the component of their group, null if all of it has none. An empty table gives no row.
    """
    rows, ids = groups(docs, k, similarity, radius, tile, budget)
    return rows.join(ids, "kind").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, k: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS, tile: int = TILE, budget: int = BUDGET) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its group; all columns stay as they were.

    Rows with equal doc_id and text all stay or all go. Rows with a null doc_id go if their group has a row with an id, else stay.
    """
    rows, ids = groups(docs, k, similarity, radius, tile, budget)
    # A class whose own least id is its component's loses only its other rows; most classes are one row.
    go = rows.join(ids.where("component_id is not null"), "kind").where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    go = small(materialise(go.select(F.col("doc_id").alias("of_doc"), F.col("t").alias("of_text")).distinct()))
    text: Column = F.xxhash64(docs["text"])
    return docs.join(go, (text == go["of_text"]) & docs["doc_id"].eqNullSafe(go["of_doc"]), "left_anti")

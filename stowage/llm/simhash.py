"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are put in cells by the population counts of their four 16-bit words. Two fingerprints whose Hamming
distance is at most r have counts that differ by at most r in sum over the words, so only tiles of cells within that
distance are compared, each pair of tiles as one numpy exclusive-or with bit counts. No pair within the radius is lost.

Scale: texts are read once and never shuffled; what moves is one (fingerprint, doc_id) pair per document and one copy
of each distinct fingerprint for each of the 65 neighbouring cells. Cells above `tile` fingerprints are dealt to several
tiles by hash, so a task holds two tiles at most. A tile pair sends on a spanning forest of its links (at most one edge
a fingerprint), never all pairs. Comparisons grow with the square of the distinct fingerprints at about 4 % of the full
matrix: that is the price of an exact tiled comparison.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, discard, materialise

SEED = 42
TILE = 16384
#: Comparisons held in memory at once.
BLOCK = 1 << 21


def fingerprint(text: str | None, k: int = 3) -> int:
    """SimHash of the k-word shingles of `text`, repeats included.

    A-Z are lower-cased, words are separated by ASCII white space. Fewer than k words: the whole sequence is the one
    shingle. No word (also null): 0. A bit is set if it is set in over half of the shingles' XXH64 values.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:-1]]
    k = min(k, len(words))
    hashes = np.array([xxhash.xxh64_intdigest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[k - 1 :])], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, fingerprint long: the 64 bits as a signed number) for every row of docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(t.as_py(), k) for t in b.column("text")], dtype=np.uint64).view(np.int64)
            yield batch(doc_id=b.column("doc_id"), fingerprint=pa.array(prints))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint bigint")


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) with the same components as the edges u-v: one for each node that is not its root."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    i, j = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links between two tiles (b None: inside one tile) of distinct uint64 fingerprints."""
    inside = b is None
    b = a if inside else b
    us, vs = [a[:0]], [a[:0]]
    step = max(1, BLOCK // len(b))
    for s in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[s : s + step, None] ^ b[None, :]) <= radius)
        if inside:
            i, j = i[i + s < j], j[i + s < j]
        if len(i):
            u, v = (a[s + i], b[j]) if len(i) < 64 else forest(a[s + i], b[j])
            us.append(u)
            vs.append(v)
    u, v = np.concatenate(us), np.concatenate(vs)
    return forest(u, v) if len(u) >= 64 else (u, v)


def _offsets(radius: int) -> list[int]:
    """Cell distances of half of the neighbours and the cell itself, for cell keys in base 32."""
    near = [d for d in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius]
    return [((d[0] * 32 + d[1]) * 32 + d[2]) * 32 + d[3] for d in near if d >= (0, 0, 0, 0)]


def links(prints: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(u, v): a spanning forest, tile pair by tile pair, of the links among distinct fingerprints prints(fingerprint)."""
    if not 0 <= radius <= 7:
        raise ValueError("radius must be from 0 to 7: cell keys leave no room for more")
    word = lambda k: F.bit_count(F.shiftrightunsigned("fingerprint", 16 * k).bitwiseAND(F.lit(0xFFFF)))
    cell = ((word(3) + 7) * 32 + word(2) + 7) * 32 * 32 + (word(1) + 7) * 32 + word(0) + 7
    cells = prints.select("fingerprint", cell.cast("int").alias("cell"))
    size = cells.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("chunks"))  # 17^4 cells at most
    dealt = cells.join(F.broadcast(size), "cell").withColumn("chunk", F.expr("pmod(xxhash64(fingerprint), chunks)"))
    tiles = dealt.groupBy("cell", "chunk").agg(F.collect_list("fingerprint").alias("a"))
    near = tiles.withColumn("step", F.explode(F.array(*[F.lit(d) for d in _offsets(radius)])))
    near = near.withColumn("other", F.col("cell") + F.col("step")).drop("step")
    there = F.broadcast(size.select(F.col("cell").alias("other"), F.col("chunks").alias("others")))
    same = F.col("cell") == F.col("other")
    near = near.join(there, "other").withColumn("chunk_b", F.explode(F.sequence(F.when(same, F.col("chunk")).otherwise(0), F.col("others").cast("bigint") - 1)))
    right = tiles.select(F.col("cell").alias("other"), F.col("chunk").alias("chunk_b"), F.col("a").alias("b"))
    pairs = near.join(right, ["other", "chunk_b"])
    pairs = pairs.select("a", F.when(~same | (F.col("chunk") < F.col("chunk_b")), F.col("b")).alias("b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for a, b in zip(batch["a"], batch["b"]):
                u, v = tile_links(np.asarray(a).view(np.uint64), None if b is None else np.asarray(b).view(np.uint64), radius)
                if len(u):
                    found.append((u, v))
            if found:
                yield pd.DataFrame({"u": np.concatenate([x[0] for x in found]).view(np.int64), "v": np.concatenate([x[1] for x in found]).view(np.int64)})

    return pairs.mapInPandas(run, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root: the least node that can be reached) for every node of edges(u, v).

    Each round takes the least label among the neighbours and then the label of that label, so chains shorten to half or
    less; every round's labels are written to the shared folder. Nothing but the count of changes reaches the driver.
    """
    both = materialise(edges.select("u", "v").union(edges.select("v", "u")).where("u != v").distinct())
    labels = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("root"))
    labels = materialise(labels)
    while True:
        low = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("root").alias("low"))
        step = labels.join(low, F.col("u") == F.col("node")).select("node", F.least("root", "low").alias("next"), "root")
        jump = labels.select(F.col("node").alias("at"), F.col("root").alias("then"))
        step = step.join(jump, F.col("next") == F.col("at"), "left")
        step = materialise(step.select("node", F.least("next", "then").alias("root"), (F.least("next", "then") != F.col("root")).alias("moved")))
        labels = step.select("node", "root")
        if step.where("moved").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, k: int = 3, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(doc_id, fingerprint long, component_id) for every row of docs(doc_id, text; other columns are ignored).

    Documents are linked if their fingerprints differ in `radius` bits or fewer; component_id is the smallest doc_id
    that can be reached. Null and empty texts have fingerprint 0 and are linked like others. Rows with equal doc_id and
    text both stay. Rows with a null doc_id keep their fingerprint; their component is null if no other row is in it.
    An empty table gives no row.
    """
    prints = materialise(with_fingerprint(docs, k))
    classes = materialise(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes, radius, tile))
    classes = classes.join(roots, F.col("fingerprint") == F.col("node"), "left")
    classes = classes.select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = classes.join(least, "root").select("fingerprint", "component_id")
    return prints.join(ids, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, k: int = 3, radius: int = 3) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its group; all columns stay as they were.

    Of rows that share a doc_id all stay or all go. Rows with a null doc_id go if their group has another row, else stay.
    """
    ids = near_duplicates(docs, k, radius)
    go = ids.where("component_id is not null and (doc_id is null or doc_id != component_id)").select("doc_id").distinct()
    return docs.join(go, docs["doc_id"].eqNullSafe(go["doc_id"]), "left_anti")

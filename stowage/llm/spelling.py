"""Spelling variants by a trie of letter-group counts.

Each word is the vector of its length and of how often it has the letters of each group. A trie holds the vectors, a count to a level. A change of one code
point adds one to at most one group's count and takes one from at most one, so a search for the words near to others goes down with
a budget of one surplus and one deficit; words at the leaves it reaches are verified code point by code point. The search goes down with
blocks of (word, node) at once, depth first: of a block that grew too large, one half waits.

Scale: the vocabulary is cut into subtries by the counts of the trie's first levels, as many as its size asks for, and subtries
above `TILE` words are dealt to several tiles by hash. A tile meets those of the subtries that the budget reaches, each pair of
tiles once, in one task that holds the two. A task sends on counts and the best near word for each word, not pairs.
A word of any frequency is one row from the first count on, which is partly summed before its shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, materialise

RUNS = r"[A-Za-zÀ-ÿ]+"
LETTERS = 7
OCCURRENCES = 2
RATIO = 10
TILE = 1 << 14
#: Words at which a subtree is compared whole, (word, node) pairs in a block, and code points of a word's ends that are compared in blocks.
LEAF, BLOCK, ENDS = 8, 1 << 18, 32
#: The letters of each level of the trie after the first, which has the length; the last level has all others.
GROUPS = ("e", "a", "i", "n", "r", "t", "s", "o", "l", "u", "d", "c", "m", "p", "g", "b", "h", "v", "fz", "kw", "xyqj")
#: A form has RATIO times its word's count, and counts are below 2^63: no chain has more steps than 2^5.
DOUBLINGS = 5


def ascii_lower(c: str | Column) -> Column:
    """A-Z alone lower-cased."""
    c = F.col(c) if isinstance(c, str) else c
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))


def words_of(docs: DataFrame, pattern: str = RUNS) -> DataFrame:
    """(doc_id, word): every maximal run of letters of docs(doc_id, text), A-Z lower-cased; null texts have none."""
    rows = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("word"))
    return rows.select("doc_id", ascii_lower("word").alias("word"))


def vocabulary(words: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n) of words(word) with enough code points and occurrences."""
    counts = words.where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= occurrences)


def vectors(words: list[str]) -> np.ndarray:
    """Length and counts of the letters of each group, a row for each word."""
    of = np.full(1 << 16, len(GROUPS), dtype=np.int64)
    for g, letters in enumerate(GROUPS):
        of[[ord(c) for c in letters]] = g
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    group = of[np.minimum(points, (1 << 16) - 1)]
    size, length = len(GROUPS) + 1, np.array([len(w) for w in words], dtype=np.int64)
    row = np.repeat(np.arange(len(words)), length)
    counts = np.bincount(row * size + group, minlength=len(words) * size).reshape(-1, size)
    return np.column_stack([length, counts]).astype(np.int32)


class Trie:
    """Vectors by their counts, level by level: the children of a node are told by the number (node, count) and hold a stretch of the sorted vectors."""

    SHIFT = 36

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1])
        self.vectors = vectors[self.order]
        n = len(vectors)
        new, node = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
        new[:1] = True
        self.children, self.first, self.many = [], [], []
        for count in self.vectors.T:
            new[1:] |= count[1:] != count[:-1]
            begin = np.flatnonzero(new)
            self.children.append((node[begin] << self.SHIFT) | count[begin])
            self.first.append(begin)
            self.many.append(np.diff(np.append(begin, n)))
            node = np.cumsum(new) - 1

    def reached(self, queries: np.ndarray, leaf: int = LEAF, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, word) whose lengths differ by one at most and whose counts by one surplus and one deficit at most."""
        last = queries.shape[1] - 1
        none = np.zeros(len(queries), dtype=np.int8)
        stack = [(0, np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64), none, none)]
        while stack:
            level, who, node, up, down = stack.pop()
            if len(who) > block:
                half = len(who) // 2
                stack += [(level, *(x[s] for x in (who, node, up, down))) for s in (slice(half, None), slice(half))]
                continue
            who, node, up, down = self._down(level, who, node, up, down, queries)
            small = self.many[level][node] <= leaf if level < last else np.ones(len(who), dtype=bool)
            if small.any():
                yield from self._leaves(level, *(x[small] for x in (who, node, up, down)), queries, block)
            if not small.all():
                stack.append((level + 1, *(x[~small] for x in (who, node, up, down))))

    def _down(self, level: int, who, node, up, down, queries) -> list[np.ndarray]:
        children = self.children[level]
        wanted = (node << self.SHIFT) + queries[who, level]
        at = np.searchsorted(children, wanted - 1)
        out = []
        for d in (-1, 0, 1):
            place = np.minimum(at, len(children) - 1)
            there = (at < len(children)) & (children[place] == wanted + d)
            at = at + there
            if level and d:  # the length has no budget of its own
                there &= (up if d > 0 else down) == 0
            i = np.flatnonzero(there)
            out.append((who[i], place[i], up[i] + np.int8(level > 0 and d > 0), down[i] + np.int8(level > 0 and d < 0)))
        return [np.concatenate(x) for x in zip(*out)]

    def _leaves(self, level: int, who, node, up, down, queries, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, block // int(self.many[level][node].max()))
        for s in range(0, len(who), step):
            many = self.many[level][node[s : s + step]]
            of = np.repeat(np.arange(s, s + len(many)), many)
            place = np.arange(len(of)) - np.repeat(np.cumsum(many) - many - self.first[level][node[s : s + step]], many)
            d = self.vectors[place, level + 1 :] - queries[who[of], level + 1 :]
            fits = (up[of] + np.maximum(d, 0).sum(axis=1) <= 1) & (down[of] - np.minimum(d, 0).sum(axis=1) <= 1)
            yield who[of[fits]], self.order[place[fits]]


def one_apart(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    lo, hi = 0, len(a)  # the length of the common prefix, by halving: words may be very long
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return a[lo:] == b[lo + 1 :] if len(a) < len(b) else a[lo + 1 :] == b[lo + 1 :]


class Tile:
    """Words with their counts, vectors, and first and last code points."""

    def __init__(self, items: pa.StructArray):
        self.words, self.n = items.field(0).to_pylist(), items.field(1).to_numpy(zero_copy_only=False)
        self.vectors = vectors(self.words)
        self.length = self.vectors[:, 0].astype(np.int64)
        points = np.frombuffer("".join(self.words).encode("utf-32-le"), dtype=np.uint32)
        row = np.repeat(np.arange(len(self.words)), self.length)
        column = np.arange(len(points)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.ends = []
        for place in (column, np.repeat(self.length, self.length) - 1 - column):
            some = np.zeros((len(self.words), ENDS), dtype=np.uint32)
            near = place < ENDS
            some[row[near], place[near]] = points[near]
            self.ends.append(some)

    def apart(self, i: np.ndarray, other: Tile, j: np.ndarray) -> np.ndarray:
        """Whether exactly one code point is inserted, deleted or replaced between words i of this tile and j of the other."""
        n, m = self.length[i], other.length[j]
        width = int(min(ENDS, max(n.max(), m.max())))
        short, total = np.minimum(n, m), np.zeros(len(i), dtype=np.int64)
        for a, b in zip(self.ends, other.ends):
            differ = a[i, :width] != b[j, :width]
            total += np.minimum(short, np.where(differ.any(axis=1), differ.argmax(axis=1), width))
        out = (np.abs(n - m) <= 1) & (total >= short - (n == m)) & ~((n == m) & (total >= 2 * n))
        for k in np.flatnonzero(np.maximum(n, m) > ENDS).tolist():
            out[k] = one_apart(self.words[i[k]], other.words[j[k]])
        return out


def near_in_tiles(a: Tile, b: Tile | None, leaf: int = LEAF) -> list[tuple[str, int, int, str]]:
    """(word, how many near words, the count of the most frequent, that word) of words with near ones in the other tile (b None: in their own)."""
    inside = b is None
    b = a if inside else b
    many, best, order = [], [], []
    for t in (a, b):
        order.append(sorted(range(len(t.words)), key=lambda k, t=t: (-t.n[k], t.words[k])))
        many.append(np.zeros(len(t.words), dtype=np.int64))
        best.append(np.full(len(t.words), 1 << 62, dtype=np.int64))
    place = [np.argsort(np.array(o, dtype=np.int64)) for o in order]
    for i, j in Trie(b.vectors).reached(a.vectors, leaf):
        keep = i < j if inside else np.ones(len(i), dtype=bool)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        near = a.apart(i, b, j)
        i, j = i[near], j[near]
        for k, x, y in ((0, i, j), (1, j, i)):
            np.add.at(many[k], x, 1)
            np.minimum.at(best[k], x, place[1 - k][y])
    out = []
    if inside:
        many, best = [many[0] + many[1]], [np.minimum(best[0], best[1])]
    for t, own, at, of, names in zip((a, b), many, best, (b, a), (order[1], order[0])):
        for k in np.flatnonzero(own).tolist():
            other = names[at[k]]
            out.append((t.words[k], int(own[k]), int(of.n[other]), of.words[other]))
    return out


def steps(levels: int) -> list[tuple[int, ...]]:
    """How the lengths and first counts of two near words may differ; of each difference and its opposite, one."""
    which = (None, *range(levels))
    near = set()
    for longer in (-1, 0, 1):
        for up in which if longer >= 0 else (None,):
            for down in which if longer <= 0 else (None,):
                near.add((longer, *((k == up) - (k == down) for k in range(levels))))
    return sorted(d for d in near if d >= (0,) * (levels + 1))


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best) of each of words(word, n), which are distinct, that has near words."""
    many = words.count()
    # Each level multiplies the pairs of tiles; a quarter of the words to each is where more and smaller tiles cost more than they save.
    levels = min(len(GROUPS), max(1, int(math.log2(max(1, many / tile)) / 2)))
    count = lambda letters: F.length("word") - F.length(F.translate("word", letters, ""))
    keyed = words.select("word", "n", F.array(F.length("word"), *[count(g) for g in GROUPS[:levels]]).alias("key"))
    size = keyed.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("chunks"))
    dealt = keyed.join(size, "key").withColumn("chunk", F.expr("cast(pmod(xxhash64(word), chunks) as int)"))
    dealt = dealt.repartition("key", "chunk")  # else all tiles of a large subtrie stay in one task
    tiles = materialise(dealt.groupBy("key", "chunk").agg(F.collect_list(F.struct("word", "n")).alias("a"), F.first("chunks").alias("chunks")))
    alone = tiles.select("a", F.lit(None).cast(tiles.schema["a"].dataType).alias("b"))
    step = F.explode(F.array(*[F.array(*map(F.lit, d)) for d in steps(levels)])).alias("step")
    left = tiles.select("key", "chunk", "a", step)
    left = left.select("key", "chunk", "a", F.zip_with("key", "step", lambda x, y: x + y).alias("other"))
    there = tiles.select(F.col("key").alias("other"), "chunks").distinct()
    left = left.join(there, "other").withColumn("first_b", F.expr("if(key = other, chunk + 1, 0)")).where("first_b < chunks")
    left = left.withColumn("chunk_b", F.explode(F.expr("sequence(first_b, chunks - 1)")))
    right = tiles.select(F.col("key").alias("other"), F.col("chunk").alias("chunk_b"), F.col("a").alias("b"))
    pairs = left.join(right, ["other", "chunk_b"]).select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for r in range(len(some)):
                b = some.column("b")[r]
                found = near_in_tiles(Tile(some.column("a")[r].values), Tile(b.values) if b.is_valid else None)
                word, n_near, best_n, best = zip(*found) if found else ((),) * 4
                yield batch(word=pa.array(word, pa.string()), n_near=pa.array(n_near, pa.int64()), best_n=pa.array(best_n, pa.int64()), best=pa.array(best, pa.string()))

    told = alone.union(pairs).mapInArrow(run, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    return told.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms lead from each of forms(word, form), by doubling the steps."""
    paths = materialise(forms.select("word", F.col("form").alias("root")))
    for _ in range(DOUBLINGS):
        then = paths.select(F.col("word").alias("at"), F.col("root").alias("then"))
        step = materialise(paths.join(then, F.col("root") == F.col("at"), "left").select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")))
        paths = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return paths


def variants(words: DataFrame, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of words(word, n; other columns are ignored), which are distinct.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word of largest n (ties: the smallest in
    code-point order) if that n is at least `ratio` times its own, else null, as form_n then is; root follows the forms to the last, or is the word. Null words are
    left out; a word of repeated rows counts with the sum of their n. An empty table gives no row.
    """
    words = materialise(words.where("word is not null and n is not null").groupBy("word").agg(F.sum("n").alias("n")))
    near = near_words(words, tile)
    rows = words.join(near, "word", "left")
    enough = F.col("best_n") >= ratio * F.col("n")
    rows = materialise(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")))
    led = roots(rows.where("form is not null"))
    told = rows.join(led, "word", "left")
    return told.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Benchmark decontamination by SimHash windows.

Windows of documents that are as long as a benchmark item get SimHash fingerprints. Fingerprints are cut into six blocks; two
within the radius of 17 bits differ by two bits or fewer in one block at least, so an item is entered under all values within
two bits of each of its blocks, and a window that has one of them meets it (only windows and items of equal length meet). What is
within the radius is verified by the exact weighted similarity of 5-word shingles.

Where windows are laid: of m shingles in a window and as many in the item, a similarity of 0.8 needs 8/9 in common. A document's hits are
the places of shingles that the item has anywhere, so moved passages count. Moving a window to the right until it begins with a hit or
meets the text's end never loses a common shingle, so the best window is among those that begin with a hit, and only those
with enough hits are laid. Texts of similarity 0.8 differ in 10 of 64 bits on average and in more than 17 in about 3 of 1,000 cases.

DataFrame functions only. Scale: one pass over the texts finds the hits without a shuffle of the texts, one more cuts the windows out; equal texts are one
row from the hits on, and equal windows one row from the fingerprints on. The items' shingles, and the list of windows, are broadcast if they have
at most `BROADCAST_ROWS` rows, else joined by a shuffle, of hashes for the hits and of the texts once for the windows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

K = 5
RADIUS = 17
BLOCKS = 6
SIMILARITY = 0.8
#: Item shingles, or texts and windows together, that are broadcast at most: some 50 MB.
BROADCAST_ROWS = 1_000_000


def normal(text: str) -> Column:
    """Lower-cased letters and digits, everything else as one space; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]++", " "))


def grams(text: Column) -> Column:
    """All runs of K words of a normal text, in order; none if it has fewer."""
    word = "[^ ]++"
    return F.regexp_extract_all(text, F.lit(f"(?<![^ ])(?=({' '.join([word] * K)}))"), F.lit(1))


def simhash(shingles: str) -> Column:
    """64-bit SimHash of an array of strings, by XXH64; a bit is set if it is set in over half of them."""
    one = "aggregate(h, 0, (n, x) -> n + cast(shiftrightunsigned(x, b) & 1L as int))"
    bits = f"aggregate(sequence(0, 63), 0L, (a, b) -> a | if(2 * {one} > size(h), shiftleft(1L, b), 0L))"
    return F.expr(f"transform(array(transform({shingles}, s -> xxhash64(s))), h -> {bits})[0]")


def _cut(fingerprint: str, count: int) -> list[tuple[int, Column, int]]:
    """(number, bits, width) of the nearly equal blocks of a fingerprint."""
    ends = [64 * k // count for k in range(count + 1)]
    return [(k, F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)), b - a) for k, (a, b) in enumerate(zip(ends, ends[1:]))]


def blocks(fingerprint: str, count: int = BLOCKS) -> Column:
    """The fingerprint's blocks as an array of (block, bits)."""
    return F.array(*[F.struct(F.lit(k).alias("block"), bits.alias("bits")) for k, bits, _ in _cut(fingerprint, count)])


def neighbours(fingerprint: str, radius: int = RADIUS, count: int = BLOCKS) -> Column:
    """(block, bits) for all values of each block within radius // count bits: one is among the blocks() of any fingerprint within the radius."""

    def near(k: int, bits: Column, width: int) -> Column:
        flips = [sum(1 << b for b in some) for n in range(radius // count + 1) for some in combinations(range(width), n)]
        masks = F.array(*[F.lit(f).cast("long") for f in flips])
        return F.transform(masks, lambda m: F.struct(F.lit(k).alias("block"), bits.bitwiseXOR(m).alias("bits")))

    return F.concat(*[near(*cut) for cut in _cut(fingerprint, count)])


def similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles; a shingle's weight is how often it occurs."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    counted = F.expr(f"aggregate(array_distinct({a}), 0, (n, s) -> n + least(size(filter({a}, x -> x = s)), size(filter({b}, x -> x = s))))")
    common = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)
    return common / (F.size(a) + F.size(b) - common)


def _small(df: DataFrame, weight: str = "1") -> DataFrame:
    """df, broadcast if the sum of its rows' weights is small."""
    return F.broadcast(df) if (df.agg(F.expr(f"sum({weight})").alias("n")).first().n or 0) <= BROADCAST_ROWS else df


def starts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(t, n, starts): for each text, by the hash of its normal words, and each item length where windows begin that can reach the threshold."""
    places = items.selectExpr("item", "n", "size(shingles) as m", "explode(array_distinct(shingles)) as gram")
    places = materialise(places.select(F.xxhash64("gram").alias("h"), "item", "n", "m").distinct())
    words = docs.select(normal("text").alias("words"))
    length = F.length("words") - F.length(F.replace("words", F.lit(" "))) + 1
    hits = words.select(F.xxhash64("words").alias("t"), length.alias("l"), F.posexplode(grams(F.col("words"))).alias("pos", "gram"))
    hits = hits.select("t", "l", "pos", F.xxhash64("gram").alias("h")).join(_small(places), "h")
    hits = hits.groupBy("t", "item").agg(F.first("l").alias("l"), F.first("n").alias("n"), F.first("m").alias("m"), F.sort_array(F.collect_set("pos")).alias("at"))
    # At least so many of the window's and the item's shingles must be equal; the need-th hit from a hit on must be in its window.
    need = "cast(ceil(4 * (m + least(m, l - 4)) / 9) as int)"
    first = f"filter(at, (p, i) -> get(at, i + {need} - 1) <= p + m - 1)"
    hits = hits.select("t", "n", F.expr(f"array_distinct(transform({first}, p -> greatest(0, least(p, l - n))))").alias("starts")).where("size(starts) > 0")
    return hits.groupBy("t", "n").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"))


def windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, start, n, window): the windows of docs(doc_id, text) that can reach the threshold with one of items(item, n, shingles)."""
    places = _small(materialise(starts(docs, items)), "1 + size(starts)")
    words = docs.select("doc_id", normal("text").alias("words")).withColumn("t", F.xxhash64("words"))
    cut = "transform(array(split(words, ' ')), w -> transform(starts, s -> struct(s as start, array_join(slice(w, s + 1, n), ' ') as window)))[0]"
    return words.join(places, "t").selectExpr("doc_id", "n", f"inline({cut})").distinct()


def candidates(each: DataFrame, texts: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(n, id, item): windows each(n, id, fingerprint) and texts(n, item, fingerprint) of equal length that are within the radius."""
    left = each.select("n", "id", "fingerprint", F.inline(blocks("fingerprint")))
    right = texts.select("n", "item", F.col("fingerprint").alias("of_item"), F.inline(neighbours("fingerprint", radius)))
    near = left.join(right, ["n", "block", "bits"]).where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("of_item"))) <= radius)
    return near.select("n", "id", "item").distinct()


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start, similarity): each document and item of which a window is similar enough, with its best window.

    docs(doc_id, text) and benchmark(item_id, text); other columns are ignored. start counts words before the window, the first of the
    best ones. Thresholds under 0.8 find only what has the hits for 0.8. Items of fewer than five words can't identify a passage and match nothing,
    nor do null or empty texts. A document that is shorter than an item is one window. Rows that share a doc_id count as one document; null ids give rows like others.
    """
    items = benchmark.select("item_id", normal("text").alias("words"))
    # Items meet by a key of their words, for their ids may be null or shared.
    items = items.select("item_id", F.xxhash64("words").alias("item"), F.size(F.split("words", " ")).alias("n"), grams(F.col("words")).alias("shingles"))
    items = items.where("size(shingles) > 0").distinct()
    items = materialise(items.withColumn("fingerprint", simhash("shingles")))
    texts = items.drop("item_id").distinct()
    laid = materialise(windows(docs, texts))
    each = laid.select("n", "window").distinct().withColumns({"id": F.xxhash64("window"), "shingles": grams(F.col("window"))})
    each = materialise(each.where("size(shingles) > 0").withColumn("fingerprint", simhash("shingles")))
    near = candidates(each, texts, radius).join(each.select("n", "id", "window", "shingles"), ["n", "id"])
    near = near.join(texts.select("item", F.col("shingles").alias("of_item")), "item")
    near = near.withColumn("similarity", similarity("shingles", "of_item")).where(F.col("similarity") >= threshold)
    near = near.join(items.select("item", "item_id"), "item")
    near = materialise(near.select("n", "window", "item_id", "similarity"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back")))
    rows = laid.join(near, ["n", "window"]).groupBy("doc_id", "item_id").agg(best.alias("b"))
    return rows.select("doc_id", "item_id", (-F.col("b.back")).alias("start"), F.col("b.similarity").alias("similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of `docs` that match no item, with all their columns."""
    hit = matches(docs, benchmark, threshold, radius).select(F.col("doc_id").alias("hit")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["hit"]), "left_anti")

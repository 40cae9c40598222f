"""Line dedup by a log-template tree.

Each line is parsed down a tree of fixed depth: token count, then its first three tokens, with variable tokens (any that holds a digit)
as wildcards. In a leaf, lines agree on a template if enough of their tokens are equal to those of the leaf's most frequent
line; the places where they differ are wildcards too. Lines that agree less meet others of the leaf by each third of their
further tokens, and agree with the most frequent line of such a family, if with any; else they are templates of their own. A template found in
`min_docs` documents or more is boilerplate: its lines are dropped but for those of the first document that has it. Leaves and lines are told
apart by 64-bit hashes.

DataFrame functions only. Scale: leaves and lines are counted by hash, with partial sums before each shuffle; of the lines' texts only
those of recurring leaves are shuffled, for the comparison with the leaf's line, which is salted, as a leaf may hold many lines. The texts of all documents are shuffled once, to
meet the list of their dropped lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

MIN_DOCS = 5
LEADING = 3
AGREEMENT = 0.8
PARTS = 3
SALT = 16


def parsed(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, leaf, masked): each line with a token, its place, its leaf's hash and its tokens with wildcards."""
    rows = docs.where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # Patterns run only where they can match.
    odd = F.lit(False)
    for blank in ("\t", "\r", "\f", "\x0b", "  "):
        odd = odd | F.contains("line", F.lit(blank))
    line = F.when(odd, F.regexp_replace("line", r"[ \t\r\f\x0B]++", " ")).otherwise(F.col("line"))
    rows = rows.select("doc_id", "pos", F.trim(line).alias("line")).where("line != ''")
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", "<*>")).otherwise(F.col("line"))
    rows = rows.select("doc_id", "pos", masked.alias("masked"))
    count = F.length("masked") - F.length(F.replace("masked", F.lit(" "))) + 1
    return rows.select("doc_id", "pos", F.xxhash64(count, F.substring_index("masked", " ", LEADING)).alias("leaf"), "masked")


def _led(rows: DataFrame, *keys: str) -> DataFrame:
    """rows(*keys, line, masked, docs) with the most frequent line of their key as leader, its count, and whether they agree enough with it."""
    first = rows.groupBy(*keys).agg(F.max(F.struct("docs", F.col("masked").alias("leader"))).alias("l"))
    first = first.select(*keys, F.col("l.leader").alias("leader"), F.col("l.docs").alias("leader_docs"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod("line", F.lit(SALT)).cast("int")).join(first, [*keys, "salt"]).drop("salt")
    a, b = F.split("masked", " "), F.split("leader", " ")
    return rows.withColumns({"equal": F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)), "size": F.size(a)})


def templates(lines: DataFrame, keys: DataFrame, min_docs: int, agreement: float) -> DataFrame:
    """(leaf, line, template): the template of each masked line (by hash) of leaves with lines in enough documents.

    keys(doc_id, leaf, line) holds the lines' hashes. Texts are needed only in leaves with several lines.
    """
    each = keys.select("leaf", "line", "doc_id").distinct().groupBy("leaf", "line").agg(F.count("doc_id").alias("docs"))
    each = materialise(each.where("docs > 0"))
    # The sum counts a document twice if it has two lines of the leaf: no leaf that has enough documents is left out.
    busy = each.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.count("*").alias("n")).where(F.col("docs") >= min_docs)
    busy = materialise(busy.select("leaf", "n"))
    alone = each.join(busy.where("n = 1"), "leaf", "left_semi").select("leaf", "line", F.col("line").alias("template"))
    some = lines.join(busy.where("n > 1"), "leaf", "left_semi").select("leaf", "masked").distinct()
    some = some.withColumn("line", F.xxhash64("masked")).join(each, ["leaf", "line"])
    some = materialise(some)
    agrees = F.col("equal") >= agreement * F.col("size")
    some = materialise(_led(some, "leaf").withColumn("agrees", agrees))
    rest = some.where("not agrees").select("leaf", "line", "masked", "docs", "size")
    tokens, n = F.split("masked", " "), F.col("size") - LEADING
    parts = [F.struct(F.lit(k).alias("part"), F.slice(tokens, (n * k / PARTS).cast("int") + LEADING + 1, (n * (k + 1) / PARTS).cast("int") - (n * k / PARTS).cast("int")).alias("of")) for k in range(PARTS)]
    families = rest.where(n >= PARTS).select("leaf", "line", "masked", "docs", F.inline(F.array(*parts)))
    families = families.select("leaf", "line", "masked", "docs", F.xxhash64("part", "of").alias("family"))
    families = _led(families, "leaf", "family").where(agrees).groupBy("leaf", "line").agg(F.max(F.struct("leader_docs", "leader")).alias("l"))
    families = families.select("leaf", "line", F.xxhash64("l.leader").alias("template"))
    short = rest.where(n < PARTS).select("leaf", "line", F.col("line").alias("template"))
    return alone.union(some.where("agrees").select("leaf", "line", F.xxhash64("leader"))).union(families).union(short)


def dropped(docs: DataFrame, min_docs: int = MIN_DOCS, agreement: float = AGREEMENT) -> DataFrame:
    """(doc_id, positions): the places of the lines of docs(doc_id, text) that are dropped, sorted; documents that lose none are absent."""
    lines = parsed(docs)
    keys = materialise(lines.select("doc_id", "pos", "leaf", F.xxhash64("masked").alias("line")))
    kinds = materialise(templates(lines, keys, min_docs, agreement))
    keyed = materialise(keys.join(kinds, ["leaf", "line"]).select("doc_id", "pos", "leaf", "template"))
    pairs = keyed.select("leaf", "template", "doc_id").distinct()
    found = pairs.groupBy("leaf", "template").agg(F.count("doc_id").alias("docs"), F.min("doc_id").alias("first"))
    # Stored, so that the join below reads plain shuffles, of which Spark can split the large partitions, or broadcasts it.
    found = materialise(found.where(F.col("docs") >= min_docs).select("leaf", "template", "first"))
    go = keyed.join(found, ["leaf", "template"]).where("doc_id != first")
    return go.groupBy("doc_id").agg(F.sort_array(F.collect_list("pos")).alias("positions"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, agreement: float = AGREEMENT) -> DataFrame:
    """`docs` with recurring lines cut out of `text`, and the counts n_lines and n_dropped (long); other columns stay.

    A null text stays null and has no lines; an empty text has one empty line. Empty lines are never dropped. Rows that
    share a doc_id count as one document and lose the lines at the same places. Rows with a null doc_id are not counted and
    lose nothing. Columns of docs named n_lines or n_dropped are replaced.
    """
    cut = dropped(docs.select("doc_id", "text"), min_docs, agreement).withColumnRenamed("doc_id", "of_doc")
    # The rows travel as one struct, so that no column of theirs can clash with those of the list.
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).join(cut, F.col("row.doc_id") == F.col("of_doc"), "left")
    text, gone = F.col("row.text"), F.col("positions")
    lines = F.split(text, "\n")
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("positions", i)), "\n")
    return rows.select(
        *[F.when(gone.isNull(), text).otherwise(kept).alias("text") if c == "text" else F.col(f"row.`{c}`") for c in names],
        F.coalesce(F.when(text.isNotNull(), F.size(lines)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(text.isNotNull() & gone.isNotNull(), F.size(gone)), F.lit(0)).cast("long").alias("n_dropped"),
    )

"""One query for each training-data operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, html, lines, media, ngram_join, packing, periodic, pii, quality, simhash, spelling, toxicity, urls
from .common import table

#: Where the tokenizer's file is on every node; a parameter of packing.pack().
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.read_back(media.store(table(spark, sf_dir, "documents")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(d,) for d in urls.LISTED], "key string")
    return urls.judge(table(spark, sf_dir, "pages"), listed)


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def misspelt(words: DataFrame) -> DataFrame:
    """words(doc_id, word) with one code point less in about one of 31, by a checksum of both."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "word"))
    rows = words.withColumn("h", h).withColumn("at", F.expr("cast(h % length(word) as int)"))
    return rows.select("doc_id", F.expr("if(h % 31 = 0, concat(substring(word, 1, at), substring(word, at + 2)), word)").alias("word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.words_of(table(spark, sf_dir, "documents")).where(F.length("word") >= spelling.LETTERS)
    return spelling.variants(spelling.vocabulary(misspelt(words)))


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of docs(doc_id, text), about one in ten with a passage that repeats up to the text's end, by a checksum of doc_id."""
    words = F.filter(F.split("text", "[ \\x09-\\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.expr("cast(if(n > 0, g % n, 0) as int)"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.expr("concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a))")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic.find(looped(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("less"), (-r["period"]).alias("least"))))
    told = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    rows = rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.less")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.least")).alias("period"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(told, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return rows.withColumn("exponent_milli", F.expr("1000 * length div period"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_decontamination,
        op3_html_extraction,
        op4_simhash_near_dedup,
        op5_packing,
        op6_media_columns,
        op7_toxicity,
        op8_line_dedup,
        op9_quality_resampling,
        op10_url_filter,
        op11_ngram_join,
        op12_spelling_variants,
        op13_periodic_runs,
    )
}

_LISTED = ", ".join(f"('{d}')" for d in urls.LISTED)

#: SQL where it can express the operator; the others are tested against brute-force versions.
ORACLES: dict[str, str] = {
    "op8_line_dedup": f"""
WITH split AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), raw AS (
    SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM split
), masked AS (
    SELECT doc_id, pos, regexp_replace(trim(regexp_replace(line, '[ \\t\\r\\f\\x0B]+', ' ', 'g')), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m FROM raw
), parsed AS (
    SELECT doc_id, pos, m, len(string_split(m, ' ')) AS n, array_to_string(string_split(m, ' ')[1:{lines.LEADING}], ' ') AS lead
    FROM masked WHERE m <> ''
), sizes AS (
    SELECT n, lead, m, count(DISTINCT doc_id) AS docs FROM parsed GROUP BY ALL
), leaders AS (
    SELECT n, lead, m AS leader FROM sizes QUALIFY row_number() OVER (PARTITION BY n, lead ORDER BY docs DESC, m DESC) = 1
), first AS (
    SELECT s.n, s.lead, s.m, s.docs, l.leader,
        len(list_filter(list_zip(string_split(s.m, ' '), string_split(l.leader, ' ')), lambda z: z[1] = z[2])) >= {lines.AGREEMENT} * s.n AS agrees
    FROM sizes s JOIN leaders l ON s.n = l.n AND s.lead = l.lead
), families AS (
    SELECT n, lead, m, docs, part, string_split(m, ' ')[{lines.LEADING} + 1 + (n - {lines.LEADING}) * part // {lines.PARTS} : {lines.LEADING} + (n - {lines.LEADING}) * (part + 1) // {lines.PARTS}] AS family
    FROM first, (SELECT unnest(range({lines.PARTS})) AS part) WHERE NOT agrees AND n - {lines.LEADING} >= {lines.PARTS}
), family_leaders AS (
    SELECT n, lead, part, family, m AS leader, docs AS leader_docs FROM families QUALIFY row_number() OVER (PARTITION BY n, lead, part, family ORDER BY docs DESC, m DESC) = 1
), second AS (
    SELECT f.n, f.lead, f.m, l.leader
    FROM families f JOIN family_leaders l ON f.n = l.n AND f.lead = l.lead AND f.part = l.part AND f.family = l.family
    WHERE len(list_filter(list_zip(string_split(f.m, ' '), string_split(l.leader, ' ')), lambda z: z[1] = z[2])) >= {lines.AGREEMENT} * f.n
    QUALIFY row_number() OVER (PARTITION BY f.n, f.lead, f.m ORDER BY l.leader_docs DESC, l.leader DESC) = 1
), kinds AS (
    SELECT f.n, f.lead, f.m, CASE WHEN f.agrees THEN f.leader ELSE coalesce(s.leader, f.m) END AS template
    FROM first f LEFT JOIN second s ON f.n = s.n AND f.lead = s.lead AND f.m = s.m
), keyed AS (
    SELECT p.doc_id, p.pos, p.n, p.lead, k.template FROM parsed p JOIN kinds k ON p.n = k.n AND p.lead = k.lead AND p.m = k.m
), found AS (
    SELECT n, lead, template, min(doc_id) AS first FROM keyed GROUP BY ALL HAVING count(DISTINCT doc_id) >= {lines.MIN_DOCS}
), gone AS (
    SELECT k.doc_id, list(k.pos) AS positions FROM keyed k JOIN found f ON k.n = f.n AND k.lead = f.lead AND k.template = f.template
    WHERE k.doc_id <> f.first GROUP BY k.doc_id
)
SELECT s.doc_id,
    CASE WHEN g.positions IS NULL THEN s.text ELSE coalesce(array_to_string(list_filter(s.ls, lambda x, i: NOT list_contains(g.positions, i - 1)), chr(10)), '') END AS text,
    CAST(coalesce(len(s.ls), 0) AS BIGINT) AS n_lines,
    CAST(coalesce(len(g.positions), 0) AS BIGINT) AS n_dropped
FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id
""",
    "op10_url_filter": f"""
WITH u AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
), rules(what, h, p) AS (
    VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in urls.RULES)}
), listed(key) AS (
    VALUES {_LISTED}
), fit AS (
    SELECT u.page_id, r.h || r.p AS rule, r.what FROM u JOIN rules r ON (u.host = r.h OR suffix(u.host, '.' || r.h)) AND starts_with(u.path, r.p)
    QUALIFY row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.h || r.p) DESC) = 1
), hit AS (
    SELECT DISTINCT u.page_id FROM u JOIN listed l ON u.host = l.key OR suffix(u.host, '.' || l.key)
)
SELECT u.page_id, u.host, u.path, f.rule,
    coalesce(f.what, CASE WHEN h.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM u LEFT JOIN fit f ON u.page_id = f.page_id LEFT JOIN hit h ON u.page_id = h.page_id
""",
    "op11_ngram_join": f"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents
), placed AS (
    SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM split
), each AS (
    SELECT DISTINCT doc_id, gram FROM (SELECT doc_id, w || ' ' || lead(w) OVER next || ' ' || lead(w, 2) OVER next AS gram FROM placed WINDOW next AS (PARTITION BY doc_id ORDER BY i)) WHERE gram IS NOT NULL
    UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM split WHERE len(ws) BETWEEN 1 AND {ngram_join.WORDS - 1}
), sets AS (
    SELECT s.doc_id, count(e.gram) AS n FROM split s LEFT JOIN each e ON s.doc_id = e.doc_id GROUP BY s.doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM each a JOIN each b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common c JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * c.n >= {ngram_join.PERCENT} * (x.n + y.n - c.n)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a
)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r ON s.doc_id = r.doc_id
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE divided AS (
    SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS rest
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
), bytes AS (
    SELECT run, n, list_transform(range(octet_length(encode(told))), lambda i: CAST('0x' || substr(hex(told), 2 * i + 1, 2) AS BIGINT)) AS bs
    FROM (SELECT run, n, CAST(doc_id AS VARCHAR) || ':' || run AS told FROM runs WHERE length(run) >= {spelling.LETTERS})
), summed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295, bs), lambda c, b: xor(c >> 8, rest[1 + (xor(c, b) & 255)])), 4294967295) AS h FROM bytes, divided
), changed AS (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM summed
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= {spelling.LETTERS} GROUP BY word HAVING sum(n) >= {spelling.OCCURRENCES}
), less AS (
    SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word AND length(a.word) = length(b.word)
    UNION SELECT l.word, w.word FROM less l JOIN words w ON l.rest = w.word
    UNION SELECT w.word, l.word FROM less l JOIN words w ON l.rest = w.word
), best AS (
    SELECT near.word, near.other, w.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near
    FROM near JOIN words w ON near.other = w.word QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, near.other) = 1
), told AS (
    SELECT w.word, w.n, CAST(coalesce(b.n_near, 0) AS BIGINT) AS n_near, CASE WHEN b.other_n >= {spelling.RATIO} * w.n THEN b.other END AS form, CASE WHEN b.other_n >= {spelling.RATIO} * w.n THEN b.other_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word
), led AS (
    SELECT word, word AS root FROM told
    UNION ALL SELECT led.word, t.form FROM led JOIN told t ON led.root = t.word WHERE t.form IS NOT NULL
)
SELECT t.word, t.form, l.root, t.n, t.n_near, t.form_n
FROM told t JOIN (SELECT led.word, led.root FROM led JOIN told ON led.root = told.word WHERE told.form IS NULL) l ON t.word = l.word
""",
}

"""Personal data by weak supervision.

Base spans (email, ip, card, phone) are defined by patterns with checks and always stay. Further candidates, keys and
identity numbers, are voted on by three labelers: a regex labeler on the shape, a gazetteer labeler on field words before
it, a context labeler on the signs around it; each says yes, no or nothing. Expectation-maximisation estimates the labelers'
reliabilities from how they agree over the whole corpus, and a logistic span classifier, trained on the labels it infers, decides.

DataFrame functions only. Scale: one pass over the texts and no shuffle of them; its spans are stored without the texts. What
meets in the driver is a count for each combination of votes and features, whose number is bounded by their few values.
Patterns can't backtrack over long runs: runs begin where none is before them, and repeats are possessive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

KINDS = ("email", "ip", "card", "phone")
ADDED = ("secret", "id")

#: Fixed values. The base patterns; a run of a class can only begin where no member is before it, or where the last
#: match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",  # shorter runs of digits fail anyway, and hold no longer one
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z])[A-Za-z0-9_/+-]{20,}+",
    "id": r"(?<![A-Za-z0-9-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})(?![A-Za-z0-9-])",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "phone": "+"}

#: Gazetteers of field words.
FIELDS = "token|tokens|key|apikey|secret|password|passwd|pwd|auth|bearer|credential|credentials|access|private|ssn|social|iban|account|acct|passport|tax"
OTHER_FIELDS = "commit|sha1|sha256|md5|checksum|digest|version|revision|isbn|doi|order|page|figure|build|model"
#: Forms of well-known keys; plain hexadecimal digests, which may be keys or checksums; names and paths in words.
KNOWN_FORMS = r"^(?:gh[pousr]_[A-Za-z0-9]{20,}|AKIA[A-Z0-9]{12,}|sk[-_][A-Za-z0-9_-]{16,}|xox[a-z]-[A-Za-z0-9-]{10,})$"
DIGESTS = r"^(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{64})$"
IN_WORDS = r"[/+_-].*[/+_-].*[/+_-]"
#: Social security numbers that are never given out.
NO_NUMBER = r"^(?:000|666|9)|-00-|-0000$"
BEFORE = 32
#: Matches that are numbered at a time.
BLOCK = 256
#: How often each labeler is thought to have been right before any candidate is seen.
TRUST = 3

_SPAN = "struct<start:int,end:int,kind:int,m:string,before:string>"


def located(text: Column, kind: int, name: str) -> Column:
    """The leftmost matches that don't overlap: start and end in code points, the match, and what stands before it."""
    pattern = PATTERNS[name]
    parts = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("s"))
    none = F.expr(f"cast(array() as array<{_SPAN}>)")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["s"])
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["m"].alias("m"), F.right(x["s"], F.lit(BEFORE)).alias("before"))
        return F.struct(F.coalesce(end, start).alias("at"), F.when(x["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    def joined(acc: Column, x: Column) -> Column:
        moved = F.transform(x["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"), s["kind"].alias("kind"), s["m"].alias("m"), s["before"].alias("before")))
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    def all_of(p: Column) -> Column:
        # An array is copied for each element that it gets: each block's places are counted from its own start, then the blocks are moved.
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")), lambda b: F.slice(p, b * BLOCK + 1, BLOCK))
        blocks = F.transform(blocks, lambda b: F.aggregate(b, F.struct(F.lit(0).alias("at"), none.alias("out")), step))
        several = F.expr(f"cast(array() as array<array<{_SPAN}>>)")
        return F.flatten(F.aggregate(blocks, F.struct(F.lit(0).alias("at"), several.alias("out")), joined, lambda acc: acc["out"]))

    found = F.transform(F.array(parts), all_of)[0]
    needed = F.contains(text, F.lit(NEEDS[name])) if name in NEEDS else text.rlike("[0-9]")
    return F.when(needed & text.rlike(pattern), found).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a digit string is a multiple of ten."""
    every = F.split(F.reverse(digits), "")

    def value(d: Column, i: Column) -> Column:
        twice = d.cast("int") * (1 + i % 2)
        return twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.transform(every, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def sound(m: Column) -> Column:
    """Whether an account number is right: its first four characters moved to the end and letters counted from ten, it is 1 more than a multiple of 97."""
    chars = F.split(F.concat(F.substr(m, F.lit(5)), F.left(m, F.lit(4))), "")
    value = lambda x: F.conv(x, 36, 10).cast("int")
    return F.aggregate(chars, F.lit(0), lambda acc, x: (acc * F.when(value(x) > 9, 100).otherwise(10) + value(x)) % 97) == 1


def valid(span: Column) -> Column:
    """The checks of the base kinds."""
    m, n = span["m"], F.length(_digits(span["m"]))
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return (
        F.when(span["kind"] == 1, m.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(span["kind"] == 2, n.between(12, 19) & F.when(n.between(12, 19), luhn(_digits(m))).otherwise(False))
        .when(span["kind"] == 3, n.between(9, 15))
        .otherwise(True)
    )


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, candidates): arrays of spans of docs(doc_id, text). Candidates inside a base span, and keys that are sound account numbers, are left out."""
    text = F.coalesce("text", F.lit(""))
    base = F.concat(*[F.filter(located(text, k, name), valid) for k, name in enumerate(KINDS)])
    more = F.concat(*[located(text, len(KINDS) + k, name) for k, name in enumerate(ADDED)])
    rows = docs.select("doc_id", F.array_sort(base).alias("base"), more.alias("more"))
    inside = lambda c: F.exists("base", lambda b: (b["start"] <= c["start"]) & (c["end"] <= b["end"]))
    numbers = lambda c: F.exists("more", lambda o: (o["kind"] > c["kind"]) & (o["start"] == c["start"]) & (o["end"] == c["end"]) & sound(o["m"]))
    clear = F.filter("more", lambda c: ~inside(c) & ~numbers(c))
    return rows.select("doc_id", "base", F.array_sort(clear).alias("candidates"))


def votes(c: Column) -> list[Column]:
    """Of a candidate: what the regex, the gazetteer and the context labeler say, each 1, -1 or 0.

    The gazetteer labeler goes by the last field word, with two short words after it at most; the context labeler by the sign before the candidate.
    """
    m, before = c["m"], c["before"]
    number = F.when(~m.rlike("^[0-9]"), F.when(sound(m), 1).otherwise(-1)).when(m.rlike(NO_NUMBER), -1).otherwise(0)
    shape = F.when(c["kind"] == len(KINDS) + 1, number).when(m.rlike(KNOWN_FORMS), 1).when(m.rlike(IN_WORDS), -1).otherwise(0)
    field = F.lower(F.regexp_extract(before, rf"(?i)(?:^|.*[^a-z])({FIELDS}|{OTHER_FIELDS})(?:[^a-z]+[a-z]{{1,4}}){{0,2}}[^a-z]*$", 1))
    field = F.when(field == "", 0).when(field.rlike(rf"^(?:{FIELDS})$"), 1).otherwise(-1)
    around = F.when(before.rlike("[=:] ?[\"']?$"), 1).when(before.rlike(r"[\p{L}0-9.,;] ?$"), -1).otherwise(0)
    return [shape.alias("v0"), field.alias("v1"), around.alias("v2")]


def features(c: Column) -> list[Column]:
    """Small numbers that describe a candidate for the classifier.

    Most are of the match alone: length, digits, case, variety of its characters, changes between letters and digits, its longest run
    of letters, a tag at its head. The line before it gives whether it holds a word of either gazetteer anywhere, and the last sign.
    """
    m, before = c["m"], c["before"]
    n = F.length(m)
    length = F.when(n < 16, 0).when(n < 32, 1).when(n == 32, 2).when(n < 40, 3).when(n == 40, 4).otherwise(5)
    share = F.least(F.lit(3), F.floor(4 * F.length(_digits(m)) / n)).cast("int")
    case = F.when(m.rlike("^[^A-Z]*$"), 0).when(m.rlike("^[^a-z]*$"), 1).otherwise(2)
    plain = m.rlike("^[0-9A-Fa-f]+$").cast("int")
    kinds = F.size(F.array_distinct(F.split(m, "")))
    variety = F.when(kinds <= 11, 0).when(kinds <= 16, 1).otherwise(2)
    turns = F.least(F.lit(3), F.floor(8 * F.size(F.regexp_extract_all(m, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), F.lit(0))) / n)).cast("int")
    run = F.array_max(F.transform(F.split(m, "[^A-Za-z]++"), F.length))
    letters = F.when(run <= 2, 0).when(run <= 5, 1).otherwise(2)
    tagged = m.rlike("^[A-Za-z]{2,4}[0-9_-]").cast("int")
    line = F.regexp_extract(before, "[^\n]*$", 0)
    word = F.when(line.rlike(rf"(?i)(?<![a-z])(?:{OTHER_FIELDS})(?![a-z])"), 1).when(line.rlike(rf"(?i)(?<![a-z])(?:{FIELDS})(?![a-z])"), 2).otherwise(0)
    sign = F.when(line.rlike("[\"']$"), 1).when(line.rlike("[=:>] *$"), 2).when(line.rlike(r"^\s*$"), 3).otherwise(0)
    return [x.alias(f"f{k}") for k, x in enumerate((c["kind"], length, share, case, plain, variety, turns, letters, tagged, word, sign))]


@dataclass
class Labelers:
    """prior of yes, and by labeler P(vote | no, it votes) and P(vote | yes, it votes); a labeler that says nothing tells nothing."""

    prior: float
    says: list[tuple[dict[int, float], dict[int, float]]]

    def posterior(self, vote: tuple[int, ...]) -> float:
        yes, no = self.prior, 1 - self.prior
        for (if_no, if_yes), v in zip(self.says, vote):
            if v:
                yes, no = yes * if_yes[v], no * if_no[v]
        return yes / (yes + no)


def estimate(patterns: dict[tuple[int, ...], int], rounds: int = 50) -> Labelers:
    """Expectation-maximisation over counts of vote patterns, begun from the votes' majority.

    Each labeler is thought to have been right `TRUST` times before, so that few candidates can't turn its votes round.
    """
    soft = {p: 1 / (1 + math.exp(-sum(p))) for p in patterns}
    total = sum(patterns.values())
    model = Labelers(0.5, [])
    for _ in range(rounds):
        yes = sum(n * soft[p] for p, n in patterns.items())
        says = []
        for k in range(3):
            by = [{v: 1 + TRUST * (v == right) for v in (-1, 1)} for right in (-1, 1)]
            for p, n in patterns.items():
                if p[k]:
                    by[1][p[k]] += n * soft[p]
                    by[0][p[k]] += n * (1 - soft[p])
            says.append(tuple({v: x / sum(b.values()) for v, x in b.items()} for b in by))
        model = Labelers((yes + 1) / (total + 2), says)
        soft = {p: model.posterior(p) for p in patterns}
    return model


def train_classifier(rows: list[tuple[tuple[int, ...], float, int]], rounds: int = 2000) -> dict[tuple[int, int], float]:
    """Logistic weights by (feature, value), and (-1, 0) for the constant, from (features, label in 0 to 1, count)."""
    names = [(-1, 0), *sorted({(k, v) for f, _, _ in rows for k, v in enumerate(f)})]
    place = {name: i for i, name in enumerate(names)}
    active = np.array([[0, *[place[w] for w in enumerate(f)]] for f, _, _ in rows])
    label, share = np.array([y for _, y, _ in rows]), np.array([n for *_, n in rows], dtype=float)
    share /= share.sum()
    weights = np.zeros(len(names))
    for _ in range(rounds):
        off = (1 / (1 + np.exp(-np.clip(weights[active].sum(axis=1), -30, 30))) - label) * share
        slope = np.bincount(active.ravel(), np.repeat(off, active.shape[1]), len(names))
        weights -= 2 / active.shape[1] * (slope + 1e-4 * weights)
    return dict(zip(names, weights.tolist()))


def learn(found: DataFrame) -> tuple[Labelers | None, dict[tuple[int, int], float]]:
    """The labelers' reliabilities and the classifier's weights from stored spans(); no candidate: nothing is accepted."""
    c = found.select(F.explode("candidates").alias("c"))
    described = c.select(*votes(F.col("c")), *features(F.col("c")))
    counts = described.groupBy(*described.columns).count().collect()  # one row for each combination of a few values
    if not counts:
        return None, {(-1, 0): -1.0}
    rows = [(tuple(r[:3]), tuple(r[3:-1]), r[-1]) for r in sorted(counts)]
    patterns: dict[tuple[int, ...], int] = {}
    for v, _, n in rows:
        patterns[v] = patterns.get(v, 0) + n
    labelers = estimate(patterns)
    return labelers, train_classifier([(f, labelers.posterior(v), n) for v, f, n in rows])


def accepted(c: Column, weights: dict[tuple[int, int], float]) -> Column:
    """Whether the classifier takes a candidate."""
    z = F.lit(weights[(-1, 0)])
    for k, f in enumerate(features(c)):
        known = [(v, w) for (feature, v), w in sorted(weights.items()) if feature == k]
        if known:
            value = F.lit(0.0)
            for v, w in known:
                value = F.when(f == v, w).otherwise(value)
            z = z + value
    return z > 0


def find(docs: DataFrame) -> DataFrame:
    """Personal data of every row of docs(doc_id, text; other columns are ignored).

    Columns: doc_id, n_email, n_ip, n_card, n_phone (base spans by kind), base_sha256 (of the base spans as
    kind:start:end, by start and then kind, comma-joined), spans (all spans, joined likewise), n_secret, n_id (added spans).
    Null and empty texts have no spans. Repeated rows each get a row.
    """
    found = materialise(spans(docs))
    _, weights = learn(found)
    rows = found.select("doc_id", "base", F.filter("candidates", lambda c: accepted(c, weights)).alias("added"))
    names = F.array(*[F.lit(k) for k in KINDS + ADDED])
    told = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    joined = lambda a: F.array_join(F.transform(a, told), ",")
    place = lambda a: F.transform(a, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    count = lambda a, k: F.size(F.filter(a, lambda s: s["kind"] == k)).cast("long")
    base, every = F.array_sort(place("base")), F.array_sort(place(F.concat("base", "added")))
    return rows.select(
        "doc_id",
        *[count("base", k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(every).alias("spans"),
        *[count("added", len(KINDS) + k).alias(f"n_{name}") for k, name in enumerate(ADDED)],
    )

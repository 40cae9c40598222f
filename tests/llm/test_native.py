"""PII, decontamination and line dedup against brute-force versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stowage.llm import decontamination, lines, pii, queries

from .fixtures import docs

#: The base patterns.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(v - 9 * (v > 9) for i, c in enumerate(reversed(digits)) for v in [int(c) * (1 + i % 2)]) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


PII_TEXTS = [
    None, "", "plain", "a@b.c a@b.cd@e.f x.y+z@q-r.st.uv. é😀 a@b.c", "a@b.c_d@e.f @x.y a@b a@.b",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.1 1.2.3 9.9.9.9.9", "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 5500000000000004",
    "+1 (743) 555-3824 +12 +1+2222222222 +44.20.7946.0958 +1 ( ) 2", "+" * 50 + "1" * 30, "7 " * 4000, "a" * 50_000 + "@b.c", "1." * 20_000, "+1(" * 5_000,
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ok', "commit 24be64439e3e49cf46b2d7c90f3602a3d0b907ff ok",
]


def test_many_matches_in_one_text_take_linear_time(spark):
    import time

    def seconds(n):
        text = " ".join(f"{4111111111111111 if k % 3 else k} 10.0.{k % 300}.1 u{k}@b.cd" for k in range(n))
        t = time.perf_counter()
        (r,) = pii.spans(docs(spark, text)).select("base").collect()
        took = time.perf_counter() - t
        want = [(s, e, list(BASE).index(kind)) for s, _, e, kind in base_spans(text)]
        assert [(x.start, x.end, x.kind) for x in r.base] == want
        return took

    seconds(100)
    assert seconds(16_000) < 3 * max(1.0, seconds(8_000))


def test_base_spans(spark):
    rng = random.Random(1)
    noise = ["".join(rng.choice("ab@.+-019 ()é%😀\n") for _ in range(300)) for _ in range(60)]
    texts = PII_TEXTS + noise
    got = {r.doc_id: r for r in pii.find(docs(spark, *texts)).collect()}
    for k, t in enumerate(texts):
        want = base_spans(t)
        told = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in want)
        assert got[k].base_sha256 == hashlib.sha256(told.encode()).hexdigest(), t
        assert [got[k][f"n_{kind}"] for kind in BASE] == [sum(w[3] == kind for w in want) for kind in BASE]
        assert set(filter(None, told.split(","))) <= set(got[k].spans.split(","))


def test_added_spans(spark):
    rng = random.Random(2)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    yes = [f'word word {n} = "{key()}" word' for n in ("token", "secret", "api_key") for _ in range(20)]
    no = [f"word word in-the-year-2024-we-went-{k}-times-out word" for k in range(60)]
    got = {r.doc_id: r for r in pii.find(docs(spark, *yes, *no)).collect()}
    assert all(got[k].n_secret == 1 for k in range(60))
    assert not any(got[k].n_secret for k in range(60, 120))
    s, e = got[0].spans.split(":")[1:]
    assert re.fullmatch("[0-9a-f]{40}", yes[0][int(s) : int(e)])


def account(rng):
    land, rest = rng.choice(["NL", "ES", "IT"]), "".join(rng.choice("0123456789") for _ in range(18))
    return f"{land}{98 - int(''.join(str(int(x, 36)) for x in rest + land + '00')) % 97:02d}{rest}"


def test_sound_account_numbers(spark):
    rng = random.Random(5)
    right = [account(rng) for _ in range(50)]
    wrong = [x[:-1] + str((int(x[-1]) + 1) % 10) for x in right]
    got = spark.createDataFrame([(x,) for x in right + wrong], "m string").select("m", pii.sound(F.col("m")).alias("ok")).collect()
    assert {r.m for r in got if r.ok} == set(right)


def test_planted_keys_and_numbers_are_found(spark):
    """Recall and precision over kinds of candidates of which one labeler or two, but not all, can tell."""
    rng = random.Random(77)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    hexa, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    word = lambda: rng.choice("stone water under seven lamps while green paper".split())
    keys = [lambda: some(hexa, 40), lambda: "q7" + some(mixed, 34), lambda: "xoxb-4" + some(mixed, 24), lambda: "gho_1k" + some(mixed, 30)]
    number = lambda: f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"
    slug = lambda: "-".join(word() for _ in range(5)) + f"-{rng.randint(1, 99)}"
    yes, no = [], []
    for _ in range(40):
        yes += [f"{word()} {rng.choice(['auth', 'password', 'secret'])} = '{rng.choice(keys)()}' {word()}" for _ in range(2)]
        yes += [f"{word()} the {rng.choice(['credential', 'token'])} is {rng.choice(keys)()} {word()}", f"{word()} {rng.choice(keys[2:])()} {word()}"]
        yes += [f"{word()} social: {number()}", f"{word()} tax no {number()} {word()}", f"{word()} {account(rng)} {word()}"]
        no += [f"{word()} revision {some(hexa, 40)} {word()}", f"sha256: {some(hexa, 64)} {word()}", f"{word()} {slug()} {word()}", f"see = {slug()}", f"order {number()} {word()}"]
    got = {r.doc_id: r.n_secret + r.n_id for r in pii.find(docs(spark, *yes, *no)).collect()}
    assert sum(got[k] == 1 for k in range(len(yes))) >= 0.95 * len(yes)
    assert sum(got[len(yes) + k] > 0 for k in range(len(no))) <= 0.02 * len(no)


def test_expectation_maximisation_finds_the_bad_labeler():
    rng = random.Random(3)
    counts = Counter()
    for _ in range(4000):
        y = rng.random() < 0.4
        counts[tuple(1 if (y if rng.random() < p else not y) else -1 for p in (0.95, 0.9, 0.55))] += 1
    m = pii.estimate(dict(counts))
    right = [m.says[k][1][1] for k in range(3)]
    assert right[0] > 0.85 and right[1] > 0.8 and right[2] < 0.7 and abs(m.prior - 0.4) < 0.08


def test_pii_repeats_and_empty_table(spark):
    assert pii.find(docs(spark)).count() == 0
    assert pii.find(docs(spark, extra=[(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c")])).agg(F.sum("n_email")).first()[0] == 3


def norm(t):
    return re.sub(r"[\W_]+", " ", (t or "").lower()).split()


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(texts, items):
    out = {}
    for d, t in texts:
        w = norm(t)
        for i, x in items:
            iw = norm(x)
            s, best = shingles(iw), 0.0
            if not s:
                continue
            for k in range(max(1, len(w) - len(iw) + 1)):
                a = shingles(w[k : k + len(iw)])
                common = sum((a & s).values())
                total = sum(a.values()) + sum(s.values()) - common
                best = max(best, common / total if total else 0)
            if best >= 0.8:
                out[d, i] = round(max(out.get((d, i), 0), best), 9)
    return out


def words(rng, n):
    return [rng.choice(["alpha", "beta", "gamma", "delta", "rho", "tau", "mu", "nu", "xi", "pi", "eta", "phi"]) + rng.choice(["", "s", "ed"]) for _ in range(n)]


def test_windows_against_all_windows(spark):
    rng = random.Random(4)
    items = [(k, " ".join(words(rng, n))) for k, n in enumerate([5, 6, 9, 13, 14, 22, 40, 70, 120, 3, 0])] + [(50, "la " * 30), (51, None), (7, "again " * 9)]
    texts = []
    for k, (_, item) in enumerate(items):
        w = norm(item)
        for edit in ("same", "replace", "insert", "delete", "many", "cut"):
            v = list(w)
            for _ in range({"same": 0, "cut": 0, "many": len(v) // 8}.get(edit, max(1, len(v) // 50))):
                p = rng.randrange(len(v)) if v else 0
                v[p : p + (edit != "insert")] = [] if edit == "delete" else ["changed"]
            if edit == "cut":
                v = v[1:]
            texts.append((100 * k + len(texts), " ".join(words(rng, rng.choice([0, 3, 40])) + v + words(rng, rng.choice([0, 5, 60]))).capitalize() + "."))
    texts += [(9001, None), (9002, ""), (9003, "one two"), (9004, "la " * 500), (9005, texts[0][1]), (9005, texts[3][1])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, words string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontamination.matches(docs(spark, extra=texts), bench).collect()}
    assert got == brute(texts, items)
    assert len(got) > 20
    kept = decontamination.drop_contaminated(docs(spark, extra=texts), bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in texts} - {d for d, _ in got}
    assert kept.columns == docs(spark).columns


def test_items_with_null_and_shared_ids(spark):
    rng = random.Random(11)
    short, long, other = (" ".join(words(rng, n)) for n in (12, 30, 20))
    bench = spark.createDataFrame([(None, short), (None, long), (None, short), (4, short), (5, other), (5, long)], "item_id bigint, text string")
    texts = docs(spark, f"before it {short} after it", f"x {long}", other, None, "none of the items is in here at all")
    got = sorted(((r.doc_id, r.item_id, r.start, r.similarity) for r in decontamination.matches(texts, bench).collect()), key=repr)
    assert got == [(0, 4, 2, 1.0), (0, None, 2, 1.0), (1, 5, 1, 1.0), (1, None, 1, 1.0), (2, 5, 0, 1.0)]
    assert sorted(r.doc_id for r in decontamination.drop_contaminated(texts, bench).collect()) == [3, 4]


def test_decontamination_of_nothing(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.matches(docs(spark, "a b c d e f g"), bench).count() == 0
    assert decontamination.matches(docs(spark), spark.createDataFrame([(1, "a b c d e f g")], "item_id bigint, text string")).count() == 0


def test_moved_passages_against_all_windows(spark):
    rng = random.Random(15)
    items = [(k, " ".join(f"w{k}x{i}" for i in range(n))) for k, n in enumerate([60, 90, 120, 120])] + [(9, " ".join(words(rng, 100)))]
    texts = []
    for _, item in items:
        w = item.split()
        for parts in (2, 3):
            cut = [w[len(w) * p // parts : len(w) * (p + 1) // parts] for p in range(parts)]
            for order in ([*reversed(cut)], [*cut[1:], cut[0]]):
                moved = [x for c in order for x in c]
                texts.append((len(texts), " ".join(moved)))
                texts.append((len(texts), " ".join([*words(rng, 30), *moved, *words(rng, 40)])))
                texts.append((len(texts), " ".join([*words(rng, 3), *moved[:-8]])))
        texts.append((len(texts), " ".join([*words(rng, 9), *w[4:], *words(rng, 2)])))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontamination.matches(docs(spark, extra=texts), bench).collect()}
    assert got == brute(texts, items) and len(got) >= 40


def flipped(rng, a, bits):
    for bit in rng.sample(range(64), bits):
        a ^= 1 << bit
    return a


signed = lambda a: a - (a >> 63 << 64)


def test_blocks_leave_no_pair_out_and_are_selective(spark):
    rng = random.Random(5)
    rows = [(k, signed(a), signed(flipped(rng, a, decontamination.RADIUS))) for k in range(300) for a in [rng.getrandbits(64)]]
    each = spark.createDataFrame([(20, k, a) for k, a, _ in rows], "n int, id bigint, fingerprint bigint")
    texts = spark.createDataFrame([(20, k, b) for k, _, b in rows], "n int, item bigint, fingerprint bigint")
    got = decontamination.candidates(each, texts)
    assert got.where("id = item").count() == 300 and got.count() < 400
    met = each.select("id", F.inline(decontamination.blocks("fingerprint"))).join(texts.select("item", F.inline(decontamination.neighbours("fingerprint"))), ["block", "bits"])
    assert met.select("id", "item").distinct().count() < 0.25 * 300 * 300


def test_the_radius_covers_the_similarity():
    """Recall of the radius at similarities of 0.8 and little more, on random words: at least 0.99."""
    rng, near, total = random.Random(16), 0, 0

    def fingerprint(w):
        hashes = [int.from_bytes(hashlib.blake2b(" ".join(w[i : i + 5]).encode(), digest_size=8).digest(), "big") for i in range(len(w) - 4)]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    while total < 500:
        w = [str(rng.getrandbits(40)) for _ in range(rng.choice([13, 22, 40, 90, 150]))]
        v = list(w)
        while True:
            u = list(v)
            at = rng.randrange(len(u))
            u[at] = "edited" + str(rng.getrandbits(30))
            a, b = shingles(w), shingles(u)
            common = sum((a & b).values())
            if common / (sum(a.values()) + sum(b.values()) - common) < 0.8:
                break
            v = u
        total += 1
        near += (fingerprint(w) ^ fingerprint(v)).bit_count() <= decontamination.RADIUS
    assert near >= 0.99 * total, near


@pytest.mark.parametrize("rows", [0, decontamination.BROADCAST_ROWS])
def test_shuffled_and_broadcast_lists_find_the_same(spark, monkeypatch, rows):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", rows)
    rng = random.Random(17)
    items = [(k, " ".join(words(rng, 30))) for k in range(6)]
    texts = [(k, " ".join([*words(rng, 20), *norm(items[k % 6][1]), *words(rng, 5)])) for k in range(18)] + [(3, "la " * 3000)]
    got = decontamination.matches(docs(spark, extra=texts), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id, r.start) for r in got} == {(k, k % 6, 20) for k in range(18)}


def brute_lines(texts, min_docs=lines.MIN_DOCS):
    mask = lambda line: re.sub(r"[^ ]*[0-9][^ ]*", "<*>", re.sub(r"[ \t\r\f\x0b]+", " ", line).strip())
    parsed = [(d, p, m.split(" ")) for d, t in texts if t is not None for p, line in enumerate(t.split("\n")) if (m := mask(line))]
    leaf = defaultdict(lambda: defaultdict(set))
    for d, _, m in parsed:
        leaf[len(m), tuple(m[:3])][" ".join(m)].add(d)
    kind = {}
    for key, by in leaf.items():
        agree = lambda m, leader, n=key[0]: sum(x == y for x, y in zip(m.split(" "), leader.split(" "))) >= lines.AGREEMENT * n
        order = lambda m, by=by: (len(by[m]), m)
        leader = max(by, key=order)
        kind |= {(key, m): leader for m in by if agree(m, leader)}
        rest = [m for m in by if not agree(m, leader)]
        cut = [3 + (key[0] - 3) * p // 3 for p in range(4)]
        family = lambda m, p, cut=cut: (p, tuple(m.split(" ")[cut[p] : cut[p + 1]]))
        families = defaultdict(list)
        for m in rest:
            for p in range(3):
                families[family(m, p)].append(m)
        for m in rest:
            leaders = {max(families[family(m, p)], key=order) for p in range(3)} if key[0] >= 6 else set()
            kind[key, m] = max([x for x in leaders if agree(m, x)], key=order, default=m)
    of = lambda m: ((len(m), tuple(m[:3])), kind[(len(m), tuple(m[:3])), " ".join(m)])
    found = defaultdict(set)
    for d, _, m in parsed:
        found[of(m)].add(d)
    gone = {(d, p) for d, p, m in parsed if len(found[of(m)]) >= min_docs and d != min(found[of(m)])}
    return {d: None if t is None else "\n".join(line for p, line in enumerate(t.split("\n")) if (d, p) not in gone) for d, t in texts}


def test_lines_against_brute_force(spark):
    rng = random.Random(6)
    common = ["this is a {own} greeting from the {own} town of old", "this is a very different line for {own} readers now", "this is a line that {own} else ever said here", "Page {} of {}", "All rights reserved.", "user {} logged in from {} at noon today ok", "x", "the quick brown fox jumps over the lazy dog {}"]
    texts = []
    for d in range(40):
        own = [" ".join(words(rng, rng.choice([1, 5, 12]))) for _ in range(5)] + ["", "  "]
        own += [rng.choice(common).format(rng.randrange(99), rng.choice(["1.2.3.4", "home", "x9"]), own=rng.choice("abcdefgh")) for _ in range(6)]
        rng.shuffle(own)
        texts.append((d, "\n".join(own)))
    texts += [(100, None), (101, ""), (102, "\n\n"), (103, "same\t line \r\nsame line")]
    got = {r.doc_id: r for r in lines.dedup_lines(docs(spark, extra=texts)).collect()}
    assert {d: r.text for d, r in got.items()} == brute_lines(texts)
    assert sum(r.n_dropped for r in got.values()) > 50
    assert (got[100].n_lines, got[101].n_lines, got[102].n_lines) == (0, 1, 3)
    assert got[0].positions == "x" and lines.dedup_lines(docs(spark)).count() == 0


def test_line_sql_is_the_same(spark, small):
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(db.sql(f"SELECT doc_id, text, n_lines, n_dropped FROM ({queries.ORACLES['op8_line_dedup']})").fetchall())
    got = sorted(tuple(r) for r in queries.op8_line_dedup(spark, small).select("doc_id", "text", "n_lines", "n_dropped").collect())
    assert got == want


@pytest.mark.parametrize("plan", ["op1_pii", "op2_decontamination", "op8_line_dedup"])
def test_no_python_on_the_native_path(spark, small, plan):
    text = queries.QUERIES[plan](spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)

"""Operators that work inside tasks, against brute-force versions, round trips and held-out labels."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stowage.llm import html, media, packing, quality, queries, simhash, toxicity, urls
from stowage.llm.joined import Stored
from stowage.llm.kneser import UNIT

from .fixtures import docs, labels

# SimHash


def brute_print(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(ids, prints, radius=3):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[a] = b
    least = defaultdict(list)
    for i in range(len(ids)):
        least[find(i)].append(ids[i])
    return [min(least[find(i)]) for i in range(len(ids))]


def test_simhash_groups(spark):
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = [None, "", " \t\n", "One", "one", "Ünique x", "a b", "a b c", "A B C", "z" * 100_000]
    for _ in range(40):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([5, 80, 400]))]
        texts.append(" ".join(w))
        for _ in range(rng.randrange(4)):
            w = list(w)
            w[rng.randrange(len(w))] = "edited"
            texts.append("  ".join(w))
    extra = [(3, "One"), (500, texts[20])]
    df = docs(spark, *texts, extra=extra)
    ids, every = [*range(len(texts)), 3, 500], [*texts, "One", texts[20]]
    prints = [brute_print(t) for t in every]
    groups = brute_groups(ids, prints)
    want = sorted((i, p - (p >> 63 << 64), c) for i, p, c in zip(ids, prints, groups))
    assert sorted(map(tuple, simhash.near_duplicates(df, tile=8).collect())) == want
    kept = simhash.one_of_each(df)
    assert {r.doc_id for r in kept.collect()} == {i for i, c in zip(ids, groups) if i == c}
    assert kept.columns == df.columns
    assert simhash.near_duplicates(docs(spark)).count() == 0


def test_forest_and_chains(spark):
    rng = np.random.default_rng(2)
    u, v = rng.integers(0, 500, 400).astype(np.uint64), rng.integers(0, 500, 400).astype(np.uint64)
    node, root = simhash.forest(u, v)
    assert len(node) == len(set(node.tolist())) and (root < node).all()
    chain = spark.range(300).selectExpr("id as u", "id + 1 as v")
    got = simhash.components(chain).collect()
    assert len(got) == 301 and {r.root for r in got} == {0}


def test_tiles_lose_no_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    a = np.unique(np.concatenate([base, near]))
    u, v = simhash.tile_links(a, None, 3)
    assert len(u) >= 40 and (np.bitwise_count(u ^ v) <= 3).all()


# Packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


ODD = ["It's <|endoftext|>x İstanbul ΣΑΣ é café don't_x 12'll ½²³ \x1c a\x1cb \u200b z\u2028y 日本語。ok ﬁ ẞ ŉ İ ſ", "e\u0301 ǅ Ŀ", "", "<|startoftext|>", "\u00a0a\u0085b"]


def test_words_encode_as_whole_texts(tokenizer, spark, small):
    cache = packing.WordCache(queries.tokenizer_path(), chunks=500, words=300)
    texts = ODD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    assert [x.tolist() for x in cache.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_of_all_forms_encode_as_whole_texts(tokenizer):
    """Every letter of the plain forms and pieces of all kinds at random, with caches that overflow."""
    rng = random.Random(21)
    letters = [c for c in map(chr, range(0x41, 0x180)) if re.fullmatch(f"[{packing.WordCache.LETTERS}]", c)]
    some = [*letters, *map(chr, range(0x21, 0x7F)), *"İŉſ日я½\u0301\u200b\x1c\x85", "<|endoftext|>", "'s", "'LL", " ", "\n", "  "]
    texts = [" ".join(f"{c} x{c}y! {c}{c}." for c in letters), "日本 語。 \u0301", "", *ODD, " 12 'tis", "-- !"]
    texts += ["".join(rng.choice(some if i % 2 else letters[:40] + [" ", ". "]) for _ in range(rng.randrange(120))) for i in range(400)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for chunks, words, group in ((20, 40, 300), (10**6, 10**6, 1 << 20), (1, 1, 1)):
        cache = packing.WordCache(queries.tokenizer_path(), chunks=chunks, words=words)
        for _ in range(2):
            assert [x.tolist() for x in cache.encode(texts, group)] == want


def test_common_words_stay_known(tokenizer):
    """New words in every group fill the cache; those that come again each time are still looked up once."""
    rng = random.Random(22)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    common, texts = [word() for _ in range(300)], []
    for _ in range(20):
        texts.append(" ".join(common + [word() for _ in range(400)]))
    cache, told = packing.WordCache(queries.tokenizer_path(), chunks=1000, words=1000), []

    class Counted:
        def encode(self, text, **options):
            told.extend(text.split())
            return tokenizer.encode(text, **options)

        def encode_batch_fast(self, texts, **options):
            told.extend(w for t in texts for w in t.split())
            return tokenizer.encode_batch_fast(texts, **options)

    cache.tokenizer = Counted()
    for t in texts:
        assert next(iter(cache.encode([t]))).tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert sum(w in set(common) for w in told) <= 2 * len(common)


def check_pieces(rows, want, size):
    """want: by doc_id the ids of each of its rows."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for v in sequences.values():
        at = 0
        for o, n in sorted(v):
            assert o == at and n > 0
            at += n
        assert at <= size
    for d, lists in want.items():
        assert sum(r.length for r in pieces[d]) == sum(map(len, lists))
        for r in pieces[d]:
            fits = [x for x in lists if len(x) == r.doc_tokens]
            assert any(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in fits)
    return [sum(n for _, n in v) for v in sequences.values()]


def test_pieces(spark, tokenizer):
    texts = [*ODD, None, "one.", "word " * 9000, "no stop " * 700 + ". " * 50, "a. " * 300, "x" * 3000]
    df = docs(spark, *texts, extra=[(0, texts[0]), (900, "tail")])
    want = defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        want[r.doc_id].append(np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], dtype="<u4"))
    for size, stretch in ((256, 1024), (4096, packing.STRETCH), (64, 256)):
        rows = packing.pack(df, queries.tokenizer_path(), size=size, stretch=stretch).collect()
        check_pieces(rows, want, size)
    assert packing.pack(docs(spark), queries.tokenizer_path()).count() == 0


def test_padding_is_little(spark, small, tokenizer):
    df = spark.read.parquet(f"{small}/documents.parquet").coalesce(1)
    lengths = check_pieces(packing.pack(df, queries.tokenizer_path()).collect(), {}, 4096)
    assert sum(0 if n & (n - 1) == 0 else 4096 - n for n in lengths) < 0.02 * sum(lengths)


def test_plan_is_the_best():
    rng = random.Random(4)
    for _ in range(60):
        size, places = 16, [0]
        while len(places) < 12:
            places.append(places[-1] + rng.randint(1, 9))
        pen = [0, *[rng.choice([0, 1, 3]) for _ in places[1:-1]], 0]
        cost = lambda a, b: 0 if (b - a) & (b - a - 1) == 0 else size - (b - a)
        best = [0.0] + [1e9] * 11
        for j in range(1, 12):
            best[j] = min((best[i] + cost(places[i], places[j]) + pen[j] for i in range(j) if places[j] - places[i] <= size), default=1e9)
        cuts = packing.plan(np.array(places), np.array(pen, dtype=float), size)
        got = sum(cost(places[a], places[b]) + pen[b] for a, b in zip([0, *cuts], cuts))
        assert cuts[-1] == 11 and got == best[-1]


# Media


def test_media_round_trip(spark):
    texts = [None, "", "a", "x" * 64, "é" * 63, "😀\n" * 5000, "z" * (media.UNIT * media.ROWS + 1), "".join(map(chr, range(1, 900)))]
    df = docs(spark, *texts, extra=[(1, ""), (None, "a")])
    rows = media.read_back(media.store(df)).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        t = "a" if r.doc_id is None else texts[r.doc_id]
        raw = (t or "").encode()
        padded = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    by = {r.doc_id: r for r in rows}
    assert by[0].media_sha256 == by[1].media_sha256 and by[0].feature == by[1].feature == "512x8:0000000000000000"
    assert by[6].feature.count(",") == 1
    assert media.read_back(media.store(docs(spark))).count() == 0


def colour_jpeg():
    """A 4:2:0 image of 24 x 20 with AC coefficients, made bit by bit, and its luminance DC values (quantiser 3)."""
    dc_table, ac_table = media.DC_TABLE, ((0, 2, 1, 1, 1) + (0,) * 11, (0x00, 0x01, 0xF0, 0x12, 0x23))
    dc, ac = media.huffman_codes(*dc_table), media.huffman_codes(*ac_table)
    rng, bits, luma, last = random.Random(5), [], [], [0, 0, 0]

    def put(value, n):
        bits.extend(value >> k & 1 for k in reversed(range(n)))

    def number(v):
        n = abs(v).bit_length()
        put(v if v >= 0 else v + (1 << n) - 1, n)

    for _ in range(2 * 2):  # MCUs of 16 x 16
        for c in (0, 0, 0, 0, 1, 2):
            d = rng.randint(-60, 60)
            put(*dc[abs(d - last[c]).bit_length()])
            number(d - last[c])
            last[c] = d
            if c == 0:
                luma.append(d)
            used = 0
            for symbol in rng.choice([[], [0x01], [0xF0, 0x12], [0x23, 0x01, 0x01], [0xF0, 0xF0, 0xF0, 0x01] + [0x01] * 14]):
                put(*ac[symbol])
                used += (symbol >> 4) + 1
                if symbol & 15:
                    number(rng.choice([-1, 1]) * (1 << (symbol & 15) - 1))
            if used < 63:
                put(*ac[0])
    bits += [1] * (-len(bits) % 8)
    data = bytes(int("".join(map(str, bits[k : k + 8])), 2) for k in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    tables = b"\x00" + bytes(dc_table[0]) + bytes(dc_table[1]) + b"\x10" + bytes(ac_table[0]) + bytes(ac_table[1])
    raw = b"\xff\xd8" + media._segment(0xE0, b"JFIF\0") + media._segment(0xDB, b"\x00" + b"\x03" * 64)
    raw += media._segment(0xC0, b"\x08\x00\x14\x00\x18\x03\x01\x22\x00\x02\x11\x00\x03\x11\x00") + media._segment(0xC4, tables)
    return raw + media._segment(0xDA, b"\x03\x01\x00\x02\x00\x03\x00\x00\x3f\x00") + data + b"\xff\xd9", luma


def test_colour_image_with_ac_coefficients():
    raw, luma = colour_jpeg()
    (frame,) = media.parse(raw)
    (pixels,) = media.dc_thumbnails([frame])
    assert (frame.width, frame.height, pixels.shape) == (24, 20, (3, 3))
    grid = np.zeros((4, 4), dtype=int)
    for m in range(4):
        for b in range(4):
            grid[2 * (m // 2) + b // 2, 2 * (m % 2) + b % 2] = luma[4 * m + b]
    assert (pixels == np.clip((grid[:3, :3] * 3 + 4 >> 3) + 128, 0, 255)).all()


@pytest.mark.parametrize("damage", [lambda r: r[:-40], lambda r: r.replace(b"\xff\xc0", b"\xff\xc2"), lambda r: b"no image"])
def test_damaged_images_are_errors(damage):
    raw = media.encode([media.payload("text " * 100)])[0]
    with pytest.raises((ValueError, IndexError)):
        media.dc_thumbnails(list(media.parse(damage(raw))) or [media.Frame()])


# Toxicity


def test_toxicity_held_out(spark, small):
    got = queries.op7_toxicity(spark, small.replace("0.001", "0.01"))
    truth = spark.read.parquet(f"{small.replace('0.001', '0.01')}/labels.parquet")
    rows = got.where("held_out").join(truth, "doc_id").collect()
    assert rows and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    right = sum(r.predicted == r.toxic for r in rows)
    assert right >= 0.9 * len(rows), (right, len(rows))  # about 200 labels to learn from; on 15,000 it is over 0.999


def test_toxicity_recall_and_precision(spark, small):
    where = small.replace("0.001", "0.1")
    rows = queries.op7_toxicity(spark, where).where("held_out").join(spark.read.parquet(f"{where}/labels.parquet"), "doc_id").collect()
    toxic, flagged = sum(r.toxic for r in rows), sum(r.predicted for r in rows)
    both = sum(r.toxic and r.predicted for r in rows)
    # From 2,000 labels to learn from: 100 of 120 are caught, 11 others flagged.
    assert toxic > 80 and both >= 0.8 * toxic and both >= 0.85 * flagged, (toxic, flagged, both, len(rows))


@pytest.mark.parametrize("limit", [toxicity.MODEL_BYTES, 0])
def test_toxicity_edges(spark, monkeypatch, limit):
    monkeypatch.setattr(toxicity, "MODEL_BYTES", limit)
    good, bad = "the cat sat on the mat and slept", "you utter scumbag and moron you"
    texts = [good if k % 3 else bad for k in range(200)]
    rows = docs(spark, *texts, extra=[(500, None), (501, ""), (502, "!!!"), (503, "scumbags " * 20_000), (None, bad), (0, bad)])
    known = labels(spark, [(k, 1, int(k % 3 == 0)) for k in range(200)] + [(1, 1, None), (None, 1, 1)])
    model = toxicity.train(rows, known)
    got = toxicity.score(rows, model).collect()
    assert len(got) == 206
    by = {r.doc_id: r for r in got if r.doc_id not in (0,)}
    assert by[503].predicted == 1 and by[None].predicted == 1 and not by[None].held_out
    assert len({by[k].score for k in (500, 501, 502)}) == 1
    assert all(by[k].predicted == int(k % 3 == 0) for k in range(1, 200))
    kept = toxicity.drop_toxic(rows, model)
    assert kept.columns == rows.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}
    none = toxicity.train(rows, labels(spark, []))
    assert toxicity.score(rows, none).count() == 206 and toxicity.score(docs(spark), none).count() == 0


def test_held_out_labels_are_not_read(spark):
    texts = ["good text here" if k % 2 else "awful moron here" for k in range(120)]
    rows = docs(spark, *texts)
    known = [(k, 1, int(k % 2 == 0)) for k in range(120)]
    turned = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 4 == 2 else t) for k, q, t in known]
    a, b = (sorted(map(tuple, toxicity.score(rows, toxicity.train(rows, labels(spark, x))).collect())) for x in (known, turned))
    assert a == b


def brute_ratio(texts, words):
    """log P(word | toxic) - log P(word | ordinary) of texts(text, toxic) by Counters of whole sequences."""
    top = [Counter(), Counter()]
    for t, kind in texts:
        for w in toxicity.words_of(t):
            p = f"^{w}$"
            top[kind].update(p[max(0, i - 5) : i] for i in range(2, len(p) + 1))
    by = {}
    for n in (5, 4, 3, 2):
        by[n] = []
        for kind in (0, 1):
            here = {g: c for g, c in top[kind].items() if len(g) == n}
            tokens, kinds = Counter(), Counter()
            for g, c in here.items():
                tokens[g[:-1]] += c
                kinds[g[:-1]] += 1
            by[n].append((here, tokens, kinds))
            low = Counter({g: c for g, c in top[kind].items() if len(g) < n})
            low.update(g[1:] for g in here)
            top[kind] = low
    single = top[0] + top[1]
    out = []
    for w in words:
        p, logs = f"^{w}$", 0.0
        for i in range(1, len(p)):
            both = []
            for kind in (0, 1):
                q = (single[p[i]] + 0.5) / (sum(single.values()) + 0.5 * (1 << 19))
                for n in range(2, min(5, i + 1) + 1):
                    here, tokens, kinds = by[n][kind]
                    g = p[i - n + 1 : i + 1]
                    if t := tokens[g[:-1]]:
                        q = max(here.get(g, 0) - 0.75, 0) / t + min(1, 0.75 * kinds[g[:-1]] / t) * q
                both.append(q)
            logs += np.log(both[1]) - np.log(both[0])
        out.append(logs)
    return out


def test_counts_are_exact_with_many_sequences(spark):
    rng = random.Random(9)
    texts = [(" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzàéîõü") for _ in range(7)) for _ in range(200)), int(k % 4 == 0)) for k in range(300)]
    model = toxicity.count_model(spark.createDataFrame(texts, "text string, toxic int"))
    words = [t.split()[3] for t, _ in texts[:60]] + ["zzz", "a", "日本語", "unseen"]
    assert np.allclose(model.ratios(words) / UNIT, brute_ratio(texts, words), rtol=1e-9, atol=1e-5)


def test_joined_counts_give_the_same_ratios(spark, monkeypatch):
    rng = random.Random(4)
    texts = [(" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(30)), int(k % 3 == 0)) for k in range(60)]
    rows = spark.createDataFrame(texts, "text string, toxic int")
    collected = toxicity.count_model(rows)
    monkeypatch.setattr(toxicity, "MODEL_BYTES", 0)
    model = toxicity.count_model(rows)
    words = [*sorted({t.split()[3] for t, _ in texts}), "zzz", "a", "日本語", "𐐨𐐩a", "unseen"]
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "key bigint, word string")
    got = {r.key: r.ratio for r in model.ratios(rows).collect()}
    assert [got[k] for k in range(len(words))] == collected.ratios(words).tolist()
    assert np.allclose([got[k] / UNIT for k in range(len(words))], brute_ratio(texts, words), rtol=1e-9, atol=1e-6)


def test_joined_counts_score_the_same(spark, small, monkeypatch):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("text", "doc_id", "lang")
    rows = rows.union(docs(spark, None, "", "!!!", "scumbag " * 5_000, "one two", "one two").selectExpr("text", "-doc_id", "'en'"))
    rows = rows.union(spark.createDataFrame([("no id", None, "en")], rows.schema))
    known = spark.read.parquet(f"{small}/labels.parquet")
    out = []
    for limit in (toxicity.MODEL_BYTES, 0):
        monkeypatch.setattr(toxicity, "MODEL_BYTES", limit)
        model = toxicity.train(rows, known)
        kept = toxicity.drop_toxic(rows, model)
        assert kept.columns == rows.columns
        scored = sorted(toxicity.score(rows, model).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.score))
        out.append((scored, sorted(map(str, kept.collect()))))
    assert isinstance(model, Stored) and len(out[0][0]) == rows.count()
    assert out[0] == out[1]  # scores bit for bit


# Quality


def test_quality_prefers_the_target(spark, small):
    kept = {r.doc_id for r in queries.op9_quality_resampling(spark, small).collect()}
    rows = spark.read.parquet(f"{small}/labels.parquet").collect()
    assert sum(r.doc_id in kept for r in rows if r.quality) >= 0.9 * sum(r.quality for r in rows)
    assert sum(r.doc_id in kept for r in rows if not r.quality) <= 0.2 * sum(1 - r.quality for r in rows)


def brute_buckets(text):
    """Counts by bucket of words, word pairs and runs of one to three shapes, one by one."""
    tokens, out, mask = quality.TOKEN.findall(text or ""), Counter(), (1 << 64) - 1
    words = [(xxhash.xxh64_intdigest(t.lower().encode(), 42) >> 8) % (1 << 40) for t in tokens]
    # Words shorten to whole multiples of 64 with a shape's number beside them; a shape tells whether the word is that before it.
    shapes = [quality._shape(t) + 64 * (k > 0 and words[k] == words[k - 1]) for k, t in enumerate(tokens)]
    grams = [8 * w for w in words] + [8 * s + 2 for s in shapes]
    grams += [8 * (31 * b + 17 * a) + 1 for a, b in zip(words, words[1:])]
    grams += [8 * (b + 128 * a) + 3 for a, b in zip(shapes, shapes[1:])]
    grams += [8 * (c + 128 * b + 16384 * a) + 4 for a, b, c in zip(shapes, shapes[1:], shapes[2:])]
    for g in grams:
        out[((g & mask) * 0x9E3779B97F4A7C15 & mask) >> 50] += 1
    return out


def test_quality_ratios_equal_brute_force(spark):
    rng = random.Random(12)
    texts = [" ".join(rng.choice(["The", "cat", "sat", "SAT", "42", "--", "naïve", "日本", "x_1", "!"]) for _ in range(rng.randint(0, 30))) for _ in range(80)]
    texts += ["", None, "one " * 3_000]
    rows = docs(spark, *texts)
    ratios, share, total = quality.fit(rows, labels(spark, [(k, int(k % 3 == 0), 0) for k in range(40)] + [(1, None, 0)]))
    raw, target = Counter(), Counter()
    for k, t in enumerate(texts):
        raw += brute_buckets(t)
        target += brute_buckets(t) if k < 40 and k % 3 == 0 else Counter()
    n = quality.BUCKETS
    p, q = ([(c[b] + 1) / (sum(c.values()) + n) for b in range(n)] for c in (target, raw))
    expected = np.log(np.array(p) / np.array(q))
    assert np.allclose(ratios, expected, rtol=0, atol=1e-12) and total == len(texts) and share == 14 / 40
    got = {r.doc_id: r.log_ratio for r in quality.keyed(rows, ratios).collect()}
    assert all(abs(got[k] - sum(expected[b] * c for b, c in brute_buckets(t).items())) < 1e-8 for k, t in enumerate(texts))


def test_quality_noise_without_ids(spark):
    rows = docs(spark, extra=[(None, f"text {k // 2}") for k in range(40)])
    assert len({r.key - r.log_ratio for r in quality.keyed(rows, np.zeros(quality.BUCKETS)).collect()}) == 20


def test_top_keys_is_exact(spark):
    rng = random.Random(6)
    keys = [rng.gauss(0, 1) * 10 ** rng.randint(-3, 6) for _ in range(2000)]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(keys)], "doc_id bigint, key double")
    for k in (0, 1, 7, 1000, 1999, 2000, 5000):
        assert {r.doc_id for r in quality.top_keys(df, k).collect()} == set(sorted(range(2000), key=lambda i: -keys[i])[:k])
    ties = df.select("doc_id", F.lit(1.0).alias("key"))
    assert quality.top_keys(ties, 3).count() == 2000


def test_quality_edges(spark):
    rows = docs(spark, None, "", "fine words here", "FINE!! WORDS!!", extra=[(2, "fine words here"), (None, "x")])
    assert quality.resample(rows, labels(spark, [(2, 1, 0), (3, 0, 0)]), k=6).count() == 6
    assert quality.resample(rows, labels(spark, [])).count() == 6
    assert quality.resample(docs(spark), labels(spark, [(2, 1, 0)])).count() == 0


def test_gumbel_sample_follows_the_ratio(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("text"))
    ratios = np.zeros(quality.BUCKETS)
    (word,) = set(quality.Reader()("a").tolist()) - set(quality.Reader()("b").tolist())
    ratios[word] = np.log(4)
    first = quality.keyed(rows, ratios).orderBy(F.desc("key")).limit(500).collect()
    assert 0.72 < sum(r.doc_id % 2 == 0 for r in first) / 500 < 0.88


# URLs


def brute_judge(url, listed):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, verdict = max(fits, key=lambda x: len(x[0]))
        return host, path, rule, verdict
    parts = host.split(".")
    hit = host and any(".".join(parts[k:]) in listed for k in range(len(parts)))
    return host, path, None, "block" if hit else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://A.Bad.NET/x?y#z", "x://bad.net", "http://notbad.net/", "http://example.org/es/1", "https://EXAMPLE.org/en/12?q", "https://sub.example.org/en/2",
    "http://a.com/fr/x", "http://a.com/de/", "http://a.com/de", "http://com/fr/", "http://a.org", "http://a.org?x", "http://éÀ.NET/É", "a://b://c/d", "http://user@bad.net:80/", "http://..bad.net/", "http://bad.net./",
]


@pytest.mark.parametrize("max_bytes", [urls.MAX_BYTES, 40])
def test_urls(spark, max_bytes):
    rng = random.Random(7)
    names = [f"h{k}.{rng.choice(['net', 'com', 'example.net'])}" for k in range(300)]
    listed = {"bad.net", *[n for n in names if rng.random() < 0.3]}
    every = URLS + [f"https://{'www.' * rng.randrange(2)}{rng.choice(names)}/{k}" for k in range(500)]
    rows = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate([*every, every[5]])], "page_id bigint, url string, host string, blocked string")
    known = spark.createDataFrame([(x,) for x in [*listed, "bad.net", "absent.net", None]], "key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(rows, known, max_bytes=max_bytes).collect()}
    assert got == {k: brute_judge(u, listed) for k, u in enumerate([*every, every[5]])}


def test_urls_of_nothing(spark):
    rows = spark.createDataFrame([], "page_id bigint, url string")
    none = spark.createDataFrame([], "key string")
    assert urls.judge(rows, none).count() == 0
    assert urls.judge(spark.createDataFrame([(1, "http://bad.net")], rows.schema), none).first().verdict == "allow"


def test_url_sql_is_the_same(spark, small):
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{small}/pages.parquet'")
    names = ["page_id", "host", "path", "rule", "verdict"]
    want = sorted(map(repr, db.sql(f"SELECT {', '.join(names)} FROM ({queries.ORACLES['op10_url_filter']})").fetchall()))
    assert sorted(repr(tuple(r)) for r in queries.op10_url_filter(spark, small).select(*names).collect()) == want


# HTML

LONG = "This paragraph tells a long and winding story about a village, its river and the people who live there. "

PAGES = {
    "marked": (
        f"<html><head><title>T</title><style>p{{}}</style></head><body><header><a href=/>Home</a></header><nav><ul><li>Menu</ul></nav><article><header><h1>Title &amp; more</h1></header>"
        f"<p>{LONG}<b>bold\n\t</b>&nbsp;text.<br>next<p>Short.</p><script>var t='</p><p>no';</script><!-- <p>no --><div class='ad-box ad'>Buy</div><div id=comments><p>{LONG}</p></div></article><footer>F</footer></body></html>",
        f"Title & more\n{LONG}bold text. next\nShort.",
    ),
    "plain": (
        "<body><div class=menu><a href=a>One</a> <a href=b>Two</a></div><div><a href=c>Link one two three</a></div><div><a href=d>Link</a></div><div><a href=d>Link</a></div>"
        f"<div><div>{LONG}</div><div>{LONG}{LONG}</div><div>Brief.</div><div>{LONG}</div></div>"
        "<form><p>Your name and a lot of words to fill in here, please do it right now.</p></form><div class='cookie notice'>We use cookies. " + LONG + "</div><div id=footer>Imprint</div></body>",
        "\n".join(x.strip() for x in (LONG, LONG + LONG, "Brief.", LONG)),
    ),
    "short": ("<p>Only this.</p>", "Only this."),
    "entities": ("<main><p>&lt;b&gt; &eacute; &#x41;&#66; &unknown; a &lt; b</p></main>", "<b> é AB &unknown; a < b"),
    "unclosed": (f"<article><p>One {LONG}<aside>side", f"One {LONG}".strip()),
    "comment": ("<article><p>a<!-- never closed <p>b", "a"),
    "raw": ("<article><p>a<script>x<p>b", "a"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    assert html.main_text(page) == want


def test_window_sums_decide_where_articles_are_marked():
    text = [LONG.strip()] * 3
    blocks = "".join(f"<div>{x}</div>" for x in text)
    assert html.main_text(f"<body><main></main>{blocks}<article>Ad: see more</article></body>").split("\n")[:3] == text
    assert html.main_text(f"<body><article>Read more</article>{'<div class=ad>x</div>' * 9}{blocks}</body>").split("\n") == text
    poem = ["A line of verse,", "another, shorter,", "and the last one."]
    verses = "".join(f"<p>{x}</p>" for x in poem)
    assert html.main_text(f"<body><article>{verses}</article><div class=ad>x</div>{blocks}</body>").split("\n") == poem
    two = f"<article>{blocks}</article>" + "<div class=ad>x</div>" * 9
    assert html.main_text(f"<body>{two}{two}<div>Imprint</div></body>").split("\n") == text * 2


def test_other_articles_and_comments_are_left_out():
    text = [LONG.strip()] * 4
    article = "<article><h1>Title</h1>" + "".join(f"<p>{x}</p>" for x in text) + "</article>"
    teasers = "".join(f"<article><h3>Story {k}</h3><p>{LONG[:100]}</p></article>" for k in range(3))
    said = "".join(f"<article><p>{LONG[:110]}</p></article>" for _ in range(4))
    want = ["Title", *text]
    assert html.main_text(f"<body>{article}<section><h2>More stories</h2>{teasers}</section></body>").split("\n") == want
    assert html.main_text(f"<body><div><h2>Today</h2>{teasers}</div>{article}<div><h2>Readers say</h2>{said}</div></body>").split("\n") == want


def test_surge_and_dive_points_set_the_ends_in_marked_elements():
    text = [LONG.strip()] * 3
    inner = "".join(f"<p>{x}</p>" for x in text)
    links = "".join(f"<p><a href=x>Other story {k} of this week</a></p>" for k in range(9))
    assert html.main_text(f"<body><article>{links}{inner}{links}</article></body>").split("\n") == text
    assert html.main_text(f"<body><article>{inner}{'<div class=ad>x</div>' * 9}{inner}</article></body>").split("\n") == text * 2


def test_light_lines_stay_without_marks():
    para = LONG.strip()
    items = [f"Item {k} of the list" for k in range(12)]
    page = lambda *parts: "<body><div class=menu>Menu</div>" + "".join(f"<div class=ad>Buy {p[3:]}</div>" if p[:3] == "ad:" else f"<div>{p}</div>" for p in parts) + "<div id=footer>F</div></body>"
    for parts in ([para, para, *items, para], [para, *items], [para, *items, "ad:1", *items, para], [para, "ad:1", "ad:2", *items[:1]]):
        assert html.main_text(page(*parts)).split("\n") == [p for p in parts if p[:3] != "ad:"]
    links = [f"<a href=x>Other story {k}</a>" for k in range(8)]
    assert html.main_text(page(para, para, *items, *links, para)).split("\n") == [para, para, *items]


def test_extraction(spark, small):
    rows = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<p>é" * 3, "x"), (3, "u", "<p>é" * 3, "x"), (None, "u", "<", "x")], "page_id bigint, url string, html string, text string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html.extract(rows).collect())
    assert got == [(0, "<", 1), (1, "", 0), (2, "", 0), (3, "é\né\né", 5), (3, "é\né\né", 5)]
    assert html.extract(rows.limit(0)).count() == 0
    for r in spark.read.parquet(f"{small}/pages.parquet").join(queries.op3_html_extraction(spark, small), "page_id").limit(40).collect():
        assert r.text and r.text == html.main_text(r.html) and "track(" not in r.text


#: Pages that make a scanner go over the same text again: each by its length.
HOSTILE = {
    "less than": lambda k: "<" * k,
    "long name": lambda k: "<" + "a" * k,
    "open script tags": lambda k: "<script " * k,
    "scripts": lambda k: "<script>" * k,
    "script ends": lambda k: "<script>" + "</script " * k,
    "cdata": lambda k: "<![CDATA[>" * k,
    "quotes": lambda k: "<a \"" * k + "<a '" * k,
    "links": lambda k: "<a href='" * k,
    "nested": lambda k: "<div>" * k + "</ul>" * k,
    "nested lists": lambda k: "<ul>" + "<div>x" * k + "</ul>" * k,
    "comments": lambda k: "<!--" * k,
    "menus": lambda k: "<div class=menu><h1>x" * k,
    "attribute": lambda k: "<p title=\"" + "x" * k,
    "references": lambda k: "&amp" * k,
    "articles": lambda k: "<article>a</article>" * k,
    "lines": lambda k: "<p>short" * k,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_take_linear_time(name):
    import time

    def took(k):
        page, best = HOSTILE[name](k), 1e9
        for _ in range(3):
            t = time.perf_counter()
            html.main_text(page)
            best = min(best, time.perf_counter() - t)
        return best

    assert any(took(40_000) <= 3 * max(took(20_000), 0.02) for _ in range(5))  # other load may disturb a measurement


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='layout has-sidebar'><article><p>{LONG}</p><p>{LONG}</p></article></div>",
        f"<div id=page class=with-menu><div class=menu><a href=/>Home</a></div><p>{LONG}<p>{LONG}</div>",
        f"<body><form id=aspnetForm><div class=nav>Home</div><p>{LONG}</p><p>{LONG}</p></form></body>",
        f"<body><div class='page sidebar'><h1>{LONG}</h1><p>{LONG}</p></div><div id=footer>Imprint</div></body>",
        f"<body><div class=sidebar><p>{LONG}</p><p>{LONG}</p></div></body>",
        f"<article><p>{LONG}</p><p>{LONG}</p></article><div class=comments><p>{LONG * 9}</p><p>{LONG * 9}</p></div>",
        f"<article><p>{LONG}</p><p>{LONG}</p></article><form><p>Write to us</p></form><div class=related><article><a href=x>{LONG}</a></article></div>",
    ],
)
def test_elements_that_wrap_the_page_are_no_menus(page):
    assert html.main_text(page) == "\n".join([LONG.strip()] * 2)


def brute_plateaus(weights, breaks, window, surge, gap):
    """Line by line from the definition: from a surge on, until more than `gap` breaks have followed the last sum that surged."""
    out, i, n = [], 0, len(weights)
    high = lambda k: sum(weights[k : k + window]) >= surge
    while i < n:
        if not (high(i) and weights[i]):
            i += 1
            continue
        inside = []
        j = i
        while j < n:
            last = max(k for k in range(i, j + 1) if high(k))
            since = [k for k in range(last + 1, j + 1) if breaks[k]]
            inside.append(j if weights[j] and (not since or j - since[0] + 1 <= window) else None)
            j += 1
            if len(since) > gap:
                break
        out.append((i, max(k for k in inside if k is not None) + 1))
        i = j
    return out


def test_plateaus_against_the_definition():
    rng = random.Random(12)
    for _ in range(400):
        weights = [rng.choice([0, 0, 5, 20, 40, 100, 300]) for _ in range(rng.randrange(30))]
        breaks = [w == 0 or rng.random() < 0.1 for w in weights]
        assert html.plateaus(weights, breaks) == brute_plateaus(weights, breaks, html.WINDOW, html.SURGE, html.GAP)



# Ids


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_ids_come_back_as_they_are(spark, kind):
    """A null in the same batch must not turn large ids into floats; ids may be texts too."""
    ids = [2**60 + 1, None, 2**60 + 3, 5] if kind == "bigint" else ["doc-1", None, "1e3", ""]
    good, bad = "the cat sat on the mat and slept", "you utter scumbag and moron you"
    df = spark.createDataFrame([(i, t) for i, t in zip(ids, [good, bad, good, None])], f"doc_id {kind}, text string").coalesce(1)
    known = spark.createDataFrame([(i, 1, int(t == bad)) for i, t in zip(ids, [good, bad, good, good])], f"doc_id {kind}, quality int, toxic int")
    same = lambda out: sorted((r.doc_id for r in out.select("doc_id").collect()), key=repr) == sorted(ids, key=repr)
    assert same(simhash.with_fingerprint(df))
    assert same(media.store(df)) and same(media.read_back(media.store(df)))
    assert same(packing.pack(df, queries.tokenizer_path()).select("doc_id").distinct())  # a text may be cut
    assert same(toxicity.score(df, toxicity.train(df, known)))
    assert same(quality.keyed(df, np.zeros(quality.BUCKETS)))
    assert same(simhash.near_duplicates(df))
    pages = df.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    assert same(html.extract(pages).withColumnRenamed("page_id", "doc_id"))

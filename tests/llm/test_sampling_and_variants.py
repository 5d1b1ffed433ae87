"""Importance resampling, SuperMinHash and spelling variants, in parts and on odd rows, against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd_documents import PROSE, documents, odd_texts  # noqa: F401
from test_operators import LOW, copies

from pathloom.llm import crc, fm_index, grouping, importance, radix, spelling, super_minhash
from pathloom.llm import text as tx

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RUN = re.compile("[A-Za-z\u00c0-\u00ff]+")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# checksums
def test_checksums_of_segments_and_of_what_they_make():
    r = random.Random(5)
    parts = [bytes(r.randrange(256) for _ in range(n)) for n in (0, 1, 2, 31, 32, 33, 64, 255, 256, 257, 700, 9000)]
    buf = np.frombuffer(b"".join(parts), dtype=np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    sums = crc.segment_crcs(buf, starts, ends)
    assert sums.tolist() == [zlib.crc32(p) for p in parts]
    for left in parts[:6]:
        joined = crc.joined(np.full(len(parts), zlib.crc32(left), dtype=np.uint32), sums, ends - starts)
        assert joined.tolist() == [zlib.crc32(left + p) for p in parts]


# importance resampling
def plain_features(text):
    words = FEATURE_WORD.findall((text or "").translate(LOW))
    return words, [zlib.crc32(" ".join(words[i : i + k]).encode()) % importance.BUCKETS for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def test_resampling_on_odd_rows(spark, documents):  # noqa: F811
    texts = odd_texts() + [f"{PROSE} number {i}" for i in range(200)]
    target = spark.createDataFrame([(0, PROSE), (1, None), (2, "old tree near a quiet house")], "item_id long, text string")
    docs = documents(texts)
    rows = by_id(importance.resample(docs, target))
    found = {i: plain_features(t) for i, t in enumerate(texts)}
    s = Counter(b for _, f in found.values() for b in f)
    t = Counter(b for r in target.collect() for b in plain_features(r.text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in range(10000)]
    score = {}
    for i, (_, f) in found.items():
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score[i] = sum(gain[b] for b in f) + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
    able = sorted((i for i, (w, _) in found.items() if len(w) >= 20), key=lambda i: (-score[i], i))
    place = {i: k + 1 for k, i in enumerate(able[: 5 * len(able) // 100])}
    assert len(place) > 5 and len(rows) == len(texts)
    for i in rows:
        assert (rows[i].n_features, rows[i].score, rows[i]["rank"]) == (len(found[i][1]), score[i], place.get(i)), i
    drawn = importance.draw(docs, target)
    assert drawn.columns == docs.columns and {r.doc_id for r in drawn.collect()} == set(place)
    assert importance.resample(documents([]), target).count() == 0
    alone = importance.resample(docs, target.limit(0))
    assert alone.count() == len(texts)


def test_resampling_of_repeated_and_missing_ids(spark, documents):  # noqa: F811
    docs = documents([PROSE] * 60)
    odd = docs.selectExpr("CASE WHEN doc_id < 20 THEN 7 WHEN doc_id < 40 THEN NULL ELSE doc_id END AS doc_id", "text", "n AS rank", "n AS weight")
    target = spark.createDataFrame([(0, PROSE)], "item_id long, text string")
    rows = importance.resample(odd, target, percent=100).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 61))
    order = sorted(rows, key=lambda r: (-r.score, r.doc_id is None, r.doc_id or 0))
    assert [(r.score, r.doc_id) for r in sorted(rows, key=lambda r: r["rank"])] == [(r.score, r.doc_id) for r in order]


@pytest.mark.parametrize("chunk", [None, 64])
def test_radix_ranks(spark, monkeypatch, chunk):
    if chunk:  # many chunks although there are few rows
        monkeypatch.setattr(radix, "CHUNK", chunk)
    r = random.Random(3)
    rows = [(i, r.choice([0, -5, 2**62, -(2**62), r.randrange(-9, 9), r.randrange(-(2**40), 2**40)]), r.randrange(-50, 5000)) for i in range(700)]
    df = spark.createDataFrame(rows, "row long, a long, b long")
    got = {x.row: x["rank"] for x in radix.ranks(df, "row", ["a", "b"]).collect()}
    assert sorted(got.values()) == list(range(1, 701))
    keys = {i: (a, b) for i, a, b in rows}
    order = sorted(got, key=got.get)
    assert [keys[i] for i in order] == sorted(keys.values())
    same = radix.ranks(df.selectExpr("row", "cast(1 as long) a"), "row", ["a"]).collect()
    assert sorted(x["rank"] for x in same) == list(range(1, 701))
    assert radix.ranks(df.limit(0), "row", ["a"]).count() == 0


# near duplicates
def plain_signature(elements, slots):
    out = [2**64 - 1] * slots
    for e in elements:
        seed, p = tx.mix(np.array([e], dtype=np.uint64)), list(range(slots))
        for j in range(slots):
            draw = int(tx.mix(seed + np.uint64(0x9E3779B97F4A7C15 * (j + 1) & (2**64 - 1)))[0])
            k = j + ((draw & 0xFFFFFFFF) * (slots - j) >> 32)
            p[j], p[k] = p[k], p[j]
            out[p[j]] = min(out[p[j]], draw >> 32 | j << 32)
    return out


def test_super_minhash_signatures():
    r = np.random.default_rng(1)
    sets = [r.integers(0, 2**63, size=n, dtype=np.uint64) for n in (1, 2, 40, 500)]
    got = super_minhash.signatures(np.repeat(np.arange(4), [len(s) for s in sets]), np.concatenate(sets), 4)
    assert got.tolist() == [plain_signature(s.tolist(), super_minhash.SLOTS) for s in sets]
    close = []
    for _ in range(80):  # the estimate is unbiased, and its spread below that of independent hashes
        u = r.integers(0, 2**63, size=130, dtype=np.uint64)
        x = super_minhash.signatures(np.repeat([0, 1], 100), np.concatenate([u[:100], u[30:]]), 2)
        close.append((x[0] == x[1]).mean())
    j = 70 / 130
    assert abs(np.mean(close) - j) < 0.02 and np.std(close) < 0.95 * math.sqrt(j * (1 - j) / super_minhash.SLOTS)


def plain_classes(texts, size, percent):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]) and label[i] != label[j]:
                lo, hi = sorted((label[i], label[j]))
                label = [lo if x == hi else x for x in label]
    return [(len(s), c) for s, c in zip(sets, label)]


@pytest.mark.parametrize("small", [False, True])
def test_super_minhash_classes(documents, monkeypatch, small):  # noqa: F811
    if small:  # several blocks, and rounds that leave work to them
        monkeypatch.setattr(grouping, "BLOCK_ROWS", 25)
        monkeypatch.setattr(grouping, "ROUNDS", 1)
        monkeypatch.setattr(super_minhash, "HELD", 500)
    texts = copies(seed=4) + ["one two three four five six", "one two three four five six seven", "a b", "a b", "b a"]
    rows = by_id(super_minhash.mark_copies(documents(texts)))
    expected = plain_classes(texts, 3, 85)
    assert [(rows[i].n_shingles, rows[i].component_id) for i in range(len(texts))] == expected
    assert [rows[i].kept for i in range(len(texts))] == [c == i for i, (_, c) in enumerate(expected)]


def test_super_minhash_on_odd_rows(documents):  # noqa: F811
    assert super_minhash.mark_copies(documents([])).count() == 0
    assert [tuple(r) for r in super_minhash.mark_copies(documents([None, ""])).orderBy("doc_id").collect()] == [(0, 0, 0, True), (1, 0, 1, True)]
    docs = documents([PROSE, PROSE, "x"]).selectExpr("CASE WHEN doc_id = 0 THEN NULL ELSE doc_id END AS doc_id", "text", "part AS sig", "row AS hub")
    rows = super_minhash.mark_copies(docs).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in rows) == [(False, 1), (False, 2), (True, 1)]


def test_hot_keys_are_salted(spark):
    from pathloom.llm.shared import salted_join

    left = spark.range(5000).selectExpr("id AS row", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k")
    right = left.groupBy("k").count().selectExpr("k", "k * 2 AS v", "count AS c")
    joined = salted_join(left, right, ["k"], "row")
    assert sorted((r.row, r.k, r.v) for r in joined.collect()) == sorted((r.row, r.k, 2 * r.k) for r in left.collect())


# spelling variants
def one_error(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def test_search_schemes_find_all_near_words():
    r = random.Random(1)
    for trial in range(30):
        alphabet = "ab\u00e9" if trial % 2 else "abcdefgh"
        words = list({"".join(r.choices(alphabet, k=r.randint(2, 8))) for _ in range(r.choice([1, 2, 30, 300]))})
        queries = words + ["".join(r.choices(alphabet + "z", k=6)) for _ in range(20)]
        got = fm_index.Both(words).near(queries)
        assert sorted(got) == sorted((i, w) for i, q in enumerate(queries) for w in words if one_error(q, w))
    assert fm_index.Both(["x" * 5000, "x" * 4999, "y"]).near(["x" * 5000]) == [(0, "x" * 4999)]


def plain_variants(counts):
    near = {w: [x for x in counts if one_error(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None)
    return out


@pytest.mark.parametrize("block", [20_000, 12])
def test_variants(spark, block, monkeypatch):
    r = random.Random(8)
    words = {"".join(r.choices("aben\u00f6", k=r.randint(5, 7))) for _ in range(250)} | {"samehead" + "".join(r.choices("ab", k=5)) for _ in range(30)}
    counts = {w: r.choice([3, 4, 6, 7, 13, 40, 90]) for w in words}
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (spelling.LEAST_LETTERS, block))  # parts cut into blocks
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in spelling.variants(df).collect()}
    assert got == plain_variants(counts) and any(v[0] and v[0] != v[1] for v in got.values())


def test_words_are_counted(spark, documents, monkeypatch):  # noqa: F811
    monkeypatch.setattr(spelling, "HELD", 4)  # counts handed on in between
    texts = odd_texts() + ["\u00c9T\u00c9 \u00e9t\u00e9s na\u00efve ma\u00dfe a\u00d7b\u00f7cde \u0100bcdef \u4e2dwordsx"] * 3
    docs = documents(texts)
    for plant in (None, 3):
        expected = Counter()
        for i, t in enumerate(texts):
            for run in RUN.findall(t or ""):
                run = run.translate(LOW)
                h = zlib.crc32(f"{i}:{run}".encode())
                if plant and h % plant == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= spelling.LEAST_LETTERS:
                    expected[run] += 1
        assert {r.word: r.n for r in spelling.count_words(docs, plant).collect()} == dict(expected)
    assert spelling.variants(spelling.vocabulary(documents([]))).count() == 0
    assert spelling.variants(spelling.vocabulary(documents([None, "", "a b c"]))).count() == 0


def test_letters_of_two_bytes():
    buf = np.frombuffer("a\u00c0\u00ff\u0100\u00bf\u20ac".encode(), dtype=np.uint8)
    assert spelling.letters(buf).tolist() == [True] * 5 + [False] * (len(buf) - 5)
    assert list(tx.groups(pa.array([], pa.string()))) == []

"""Numpy models against plain versions of themselves."""

import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from pathloom.llm import cover_tree, kneser_ney, ngram_join, packing, pii, unigram
from pathloom.llm import text as tx
from pathloom.llm.quality_crf import LineField, line_features
from pathloom.llm.url_filters import GlobSet


# Shift-And automaton
def plain_glob(pattern):
    parts = re.split(r"(\*\*|\*|\?)", pattern)
    return re.compile("".join({"**": r"[\s\S]*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab/*?.", max_size=9), min_size=1, max_size=20), st.lists(st.text(alphabet="ab/.", max_size=12), min_size=1, max_size=8))
def test_globs(patterns, texts):
    patterns = [p.replace("***", "**") for p in patterns]
    _, _, buf, offsets = next(tx.groups(pa.array(texts), 1 << 30))
    got = GlobSet(patterns).match(buf, offsets)
    assert got.tolist() == [[plain_glob(p).fullmatch(t) is not None for p in patterns] for t in texts]


# bin completion
def fewest(sizes, capacity):
    best = [len(sizes)]
    sizes = sorted(sizes, reverse=True)

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                bins[k] += sizes[i]
                place(i + 1, bins)
                bins[k] -= sizes[i]
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=0, max_size=9))
def test_packing_is_optimal_where_it_can_be_tried(sizes):
    plan = packing.plan(np.bincount(sizes, minlength=21).tolist() if sizes else [0] * 21, 20)
    packed = [s for filling, times in plan for s in filling * times]
    assert sorted(packed) == sorted(sizes)
    assert all(sum(f) <= 20 for f, _ in plan)
    assert sum(t for _, t in plan) == fewest(sizes, 20)


def test_packing_of_many_pieces_is_close_to_the_bound():
    r = random.Random(3)
    counts = [0] + [r.randrange(40) for _ in range(1024)]
    plan = packing.plan(counts)
    total = sum(s * c for s, c in enumerate(counts))
    assert sum(t for _, t in plan) <= -(-total // 1024) * 1.005


@pytest.mark.parametrize("some", [{30: 100_000}, {10: 100_000}, {1: 100_000}, {s: 7 * s + 100 for s in range(1, 61)}, {s: 90 for s in range(100, 200)}, {1: 200_000, **{s: 50 for s in range(200, 700)}}])
def test_packing_of_short_pieces_is_close_to_the_bound(some):
    plan = packing.plan([some.get(s, 0) for s in range(1025)])
    packed = Counter()
    for filling, times in plan:
        assert sum(filling) <= 1024
        packed.update({s: times * n for s, n in Counter(filling).items()})
    assert packed == some
    whole = 1024 // max(some) * max(some) if len(some) == 1 else 1024  # what equal pieces can fill
    total = sum(s * n for s, n in some.items())
    assert sum(t for _, t in plan) <= -(-total // whole) * 1.01


# prefix signatures
@settings(max_examples=200, deadline=None)
@given(st.integers(1, 260), st.integers(0, 2**32), st.floats(0, 1))
def test_linked_sets_share_a_signature(n, seed, frequent):
    r = random.Random(seed)
    base = r.sample(range(10**6), n)
    slack = n - -(-80 * n // 100)
    lost = r.randint(0, slack)
    new = r.randint(0, max(0, min(slack, 100 * (n - lost) // 80 - n)))
    x, y = set(base), set(base[lost:]) | {10**7 + i for i in range(new)}
    if 100 * len(x & y) < 80 * len(x | y):
        return
    df = {t: 1 if t not in x & y else (r.choice([300, 1000, 5000]) if r.random() < frequent else r.choice([2, 3, 20, 200])) for t in x | y}
    sigs = []
    for s in (x, y):
        key = np.array(sorted(t for t in s if df[t] > 1), dtype=np.uint64)
        sigs.append(set(ngram_join.signatures(key, np.array([df[int(k)] for k in key], dtype=np.uint16), len(s)).tolist()))
    assert sigs[0] & sigs[1]


# cover trees
@pytest.mark.parametrize("seed", range(4))
def test_dual_tree_search(seed):
    r = np.random.default_rng(seed)
    centres = r.integers(-40, 40, (6, 8))
    data = (centres[r.integers(0, 6, 700)] + r.integers(-3, 4, (700, 8))).astype(np.int64)
    data[50:60] = data[40]
    ids, rows = np.arange(700), np.arange(0, 700, 7)
    best = cover_tree.search(data[rows], ids[rows], np.full(len(rows), cover_tree.NONE), data, ids, 5)
    for k, q in enumerate(rows):
        others = ids[ids != q]
        scores = data[others] @ data[q]
        order = np.lexsort((others, -scores))[:5]
        assert best.id[k].tolist() == others[order].tolist() and best.score[k].tolist() == scores[order].tolist()


def test_covering_radii_cover():
    x = np.random.default_rng(1).normal(size=(900, 4))
    tree = cover_tree.CoverTree(x)
    for c, r, (i, j), kids in zip(tree.centre, tree.radius, tree.span, tree.children):
        assert np.linalg.norm(x[tree.order[i:j]] - c, axis=1).max() <= r + 1e-9
        assert not kids or sorted(k for n in kids for k in range(*tree.span[n])) == list(range(i, j))


# conditional random field over lines
def test_line_marginals_are_those_of_all_labellings():
    r = np.random.default_rng(2)
    buf, offsets = next(tx.groups(pa.array(["One line.\n### ###\n\nlast", "", "single"]), 1 << 30))[2:]
    x, length, first, after = line_features(buf, offsets)
    assert (after - first).tolist() == [4, 1, 1] and length.tolist() == [9, 7, 0, 4, 0, 6]
    field = LineField(r.normal(size=x.shape[1]), r.normal(size=(2, 2)))
    good, _ = field.marginals(x, first, after)
    score = x @ field.weights
    for a, b in zip(first, after):
        total, on = 0.0, np.zeros(b - a)
        for labels in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(score[a + i] * v for i, v in enumerate(labels)) + sum(field.pairs[p, q] for p, q in zip(labels, labels[1:])))
            total += w
            on += w * np.array(labels)
        assert np.allclose(good[a:b], on / total)


# personal data
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab@.-_1234 +()", max_size=40))
def test_base_spans(text):
    spans = pii.base_spans(text)
    assert [(s, e) for s, e, k in spans if k == 0] == [m.span() for m in EMAIL.finditer(text)]
    assert [(s, e) for s, e, k in spans if k == 1] == [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]


def test_tagger_gradients():
    r = np.random.default_rng(0)
    tagger = pii.Tagger()
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    x, y = r.integers(0, pii.N_CHARS, (3, 12)), r.integers(0, pii.N_TAGS, (3, 12))
    _, g = tagger.gradients(x, y)
    for k, d in g.items():
        i = np.unravel_index(np.abs(d).argmax(), d.shape)
        sides = []
        for step in (1e-3, -2e-3):
            tagger.p[k][i] += step
            sides.append(tagger.gradients(x, y)[0])
        tagger.p[k][i] += 1e-3
        assert np.isclose((sides[0] - sides[1]) / 2e-3, d[i], rtol=1e-3)


def test_windows_are_reconciled():
    assert pii.reconciled([(5.0, 0, 10, 0), (5.0, 0, 10, 0), (3.0, 5, 15, 1), (1.0, 10, 12, 2), (4.0, 20, 30, 3)]) == [(0, 10, 0), (10, 12, 2), (20, 30, 3)]


def test_tagger_finds_what_patterns_miss():
    r = random.Random(1)
    words = "the of and river house quiet tree bird sang old near".split()

    def number():
        while True:
            d = "4" + "".join(r.choice("0123456789") for _ in range(15))
            if pii._luhn(d):
                return d

    def phone():
        return f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}"

    def mail():
        return f"{''.join(r.choices('abcdefg', k=5))}.{r.randrange(10, 99)}@mail{r.randrange(9)}.example.com"

    def ip():
        return ".".join(str(r.randrange(1, 255)) for _ in range(4))

    texts = [" ".join([*r.choices(words, k=15), r.choice([number, phone, mail, ip])(), *r.choices(words, k=20)]) for _ in range(300)]
    tagger = pii.Tagger()
    tagger.fit(*pii.training_windows([pii.stretches(t, i) for i, t in enumerate(texts)]))
    found, tried = 0, 40
    for _ in range(tried):
        a, b = phone(), number()
        text = " ".join([*r.choices(words, k=9), a, b, *r.choices(words, k=9)])
        base, every = pii.all_spans([text], tagger)[0]
        assert base == []
        at = text.index(a)
        found += {(at, at + len(a), 3), (at + len(a) + 1, at + len(a) + 1 + len(b), 2)} <= set(every)
    assert found >= 0.8 * tried
    assert pii.all_spans(["no numbers here", ""], tagger) == [([], []), ([], [])]


# unigram pieces
@pytest.fixture(scope="module")
def pieces():
    return unigram.load_pieces()


def test_unigram_viterbi_scores_as_the_library(pieces):
    raw = open(unigram.default_model(), "rb").read()
    at = raw.rindex(b"\x18\x02")  # the model's type: unigram in place of BPE
    at = raw.rindex(b"tok_v0\x18\x02") + 6
    theirs = sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x18\x01" + raw[at + 2 :])
    r = random.Random(4)
    texts = ["the", "hend and", "a b", "nation", *("".join(r.choices("abehnst ", k=9)).strip() or "x" for _ in range(60))]
    encoder = unigram.Encoder(pieces)
    ids, counts, _, _ = encoder.encode(*next(tx.groups(pa.array(texts), 1 << 30))[2:])
    cut = np.concatenate([[0], np.cumsum(counts)])
    for t, a, b in zip(texts, cut[:-1], cut[1:]):
        if "  " in t:
            continue
        best = theirs.nbest_encode_as_ids(t, 2)[0]
        assert pieces.scores[ids[a:b]].sum() == pytest.approx(pieces.scores[best].sum(), rel=1e-6)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="theandions 1é日😀\x00\n", min_size=1, max_size=60))
def test_unigram_of_a_long_unit_is_that_of_a_short_one(pieces, text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    ids, counts = unigram.viterbi(pieces, data[None, :], np.array([len(data)]))
    assert unigram.viterbi_long(pieces, data).tolist() == ids.tolist() and counts.tolist() == [len(ids)]


def test_unigram_of_prose_without_spaces_takes_linear_time(pieces):
    r = random.Random(6)
    text = "".join(r.choices("日本語の文章にはスペースがない。abc", k=30_000))  # 80,000 bytes
    encoder = unigram.Encoder(pieces)
    began = time.perf_counter()
    ids, _, _, _ = encoder.encode(*next(tx.groups(pa.array([text]), 1 << 30))[2:])
    assert time.perf_counter() - began < 3  # 0.3 s alone on a machine; 22 s a byte at a time
    assert unigram.decode_text(pieces, ids.tolist()) == text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="the and\n1é日😀\x00", max_size=30), min_size=1, max_size=4))
def test_unigram_round_trip(pieces, texts):
    encoder = unigram.Encoder(pieces)
    ids, counts, _, _ = encoder.encode(*next(tx.groups(pa.array(texts), 1 << 30))[2:])
    cut = np.concatenate([[0], np.cumsum(counts)])
    assert [unigram.decode_text(pieces, ids[a:b].tolist()) for a, b in zip(cut[:-1], cut[1:])] == texts


# Kneser-Ney helpers
def test_scattered_keys_give_their_words_back():
    for words in (1, 300, 10**6, 2**31):
        s = kneser_ney.Scatter(words)
        a = np.array([0, words, words // 2, 1 % (words + 1)])
        b = np.array([words, 0, words // 3, words])
        x, y = s.words(s.key(a, b))
        assert x.tolist() == a.tolist() and y.tolist() == b.tolist()


def test_encoded_keys_come_back():
    for key in ([], [5], [1, 2, 2**40, 2**63]):
        k, c = kneser_ney._decode(kneser_ney._encode(np.array(key, dtype=np.uint64), np.arange(len(key))))
        assert k.tolist() == key and c.tolist() == list(range(len(key)))

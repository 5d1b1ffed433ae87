"""Operators in Spark against plain versions, and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_documents import PROSE, documents, odd_texts  # noqa: F401

import corpus_pipeline
from pathloom.llm import components, cover_tree, grouping, kneser_ney, ngram_join, packing, pii, preferences, quality_crf, quality_rules, unigram, url_filters
from pathloom.llm.oracle import ORACLE
from pathloom.llm.queries import QUERIES, URL_GLOBS, URL_RULES
from test_queries import multiset, oracle_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    columns, expected = multiset(*oracle_rows(sf_dir, ORACLE[name]))
    found_columns, found = multiset(result.columns, [tuple(r) for r in result.collect()])
    assert found_columns == columns and found == expected and found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, sf_dir, name):
    table, key = ("embeddings", "query_id") if name == "op8_cover_tree" else ("documents", "doc_id")
    rows = QUERIES[name](spark, sf_dir)
    ids = {r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select("vec_id" if table == "embeddings" else "doc_id").collect()}
    assert {r[key] for r in rows.select(key).collect()} == ({i for i in ids if i % 20 == 0} if table == "embeddings" else ids)


# quality rules
def test_rules_on_odd_rows(documents):  # noqa: F811
    rows = by_id(quality_rules.apply_rules(documents()))
    assert len(rows) == len(odd_texts())
    assert not rows[0].kept and rows[0].n_words == 0 and rows[0].base_failed
    assert rows[5].kept and rows[7].kept and not rows[9].kept
    assert quality_rules.apply_rules(documents([])).count() == 0
    kept = quality_rules.filter_documents(documents())
    assert kept.columns == documents().columns and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}


def test_limits_follow_the_source(documents):  # noqa: F811
    plain, signs = PROSE, PROSE.replace(" ", " # ")
    mostly_plain = documents([plain] * 250 + [signs] * 5)
    mostly_signs = documents([signs] * 250 + [plain] * 5)
    assert [r.kept for r in quality_rules.apply_rules(mostly_plain.drop("lang", "source").selectExpr("*", "'a' lang", "'b' source")).orderBy("doc_id").collect()] == [True] * 250 + [False] * 5
    assert all(r.kept for r in quality_rules.apply_rules(mostly_signs.drop("lang", "source").selectExpr("*", "'a' lang", "'b' source")).where("doc_id < 250").collect())


def test_filters_keep_columns_of_any_name(spark, documents):  # noqa: F811
    names = ["__quality_rules", "__lang", "__limit_length", "__quality_score", "further0", "__kept", "rule", "verdict"]
    docs = documents([PROSE, "x", PROSE + " once more"]).selectExpr("doc_id", "text", "lang", "source", *[f"doc_id + {i} AS {n}" for i, n in enumerate(names)])
    labels = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    for kept in (quality_rules.filter_documents(docs), quality_crf.filter_documents(docs, labels)):
        assert kept.columns == docs.columns
        assert all([r[n] - r.doc_id for n in names] == list(range(len(names))) for r in kept.collect())
    pages = url_filters.filter_urls(docs.selectExpr("*", "'a.org' AS host", "'/' AS path"), URL_RULES, URL_GLOBS)
    assert [c for c in pages.columns if c in ("rule", "verdict")] == ["rule", "verdict"] and {r.verdict for r in pages.collect()} == {"allow"}


# classifier
def test_classifier(spark, sf_dir, documents):  # noqa: F811
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    rows = by_id(quality_crf.classify(docs, labels))
    held = [(rows[r.doc_id].predicted, r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in rows)
    assert sum(a == b for a, b in held) >= 0.9 * len(held)
    odd = by_id(quality_crf.classify(documents(), labels))
    assert len(odd) == len(odd_texts()) and all(0 <= r.score <= 1 for r in odd.values())
    none = quality_crf.classify(documents(), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_crf.classify(documents([]), labels).count() == 0


# language model
def test_language_model(spark, documents):  # noqa: F811
    docs = documents()
    model = kneser_ney.learn(docs)
    rows = by_id(kneser_ney.score(docs, model))
    words = {i: [w.translate(LOW) for w in WORD.findall(t or "")] + [None] for i, t in enumerate(odd_texts())}
    train = [i for i in words if zlib.crc32(str(i).encode()) % 10]
    uni = Counter(w for i in train for w in words[i])
    two = Counter(b for i in train for b in zip([0, *words[i][:-1]], words[i]))
    n, v = sum(uni.values()), len(uni)
    context, kinds, before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter(w for _, w in two)
    for (u, _), c in two.items():
        context[u] += c
        kinds[u][min(c, 3) - 1] += 1
    d = (0, *kneser_ney.discounts([sum(c == k for c in two.values()) for k in (1, 2, 3, 4)]))
    lower = (0, *kneser_ney.discounts([sum(c == k for c in before.values()) for k in (1, 2, 3, 4)]))
    rest = sum(lower[min(c, 3)] for c in before.values())

    def p(u, w):
        low = (before[w] - lower[min(before[w], 3)] + rest / (v + 1)) / len(two)
        c = two[u, w]
        return (c - d[min(c, 3)] + sum(a * b for a, b in zip(d[1:], kinds[u])) * low) / context[u] if context[u] else low

    for i, w in words.items():
        assert rows[i].n_tokens == len(w) and rows[i].train_tokens == n and rows[i].n_known == sum(uni[x] > 0 for x in w)
        assert rows[i].score == pytest.approx(sum(np.log10(p(u, x)) for u, x in zip([0, *w[:-1]], w)), rel=1e-6, abs=1e-9)
        assert rows[i].base_score == pytest.approx(sum(np.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel=1e-6)
    for u in (0, "the", "nowhere"):
        assert sum(p(u, w) for w in uni) + p(u, "\0") == pytest.approx(1)
    empty = documents([])
    assert kneser_ney.score(empty, kneser_ney.learn(empty)).count() == 0


def test_language_model_of_steep_counts_is_finite(documents):  # noqa: F811
    """Counts of counts that do not fall: no estimate may leave a context without mass for unseen words."""
    r = np.random.default_rng(2)
    tables = [["a b"] * 2 + [t for t in ("c d", "e f", "g h", "i j") for _ in range(3)] + [" ".join(f"w{i}" for i in range(60)), "a f", "a zzz"]]
    tables += [[" ".join(r.choice(list("abcd"), size=int(r.integers(1, 7)))) for _ in range(12)] * int(r.integers(1, 4)) for _ in range(2)]
    for texts in tables:
        docs = documents(texts)
        rows = kneser_ney.score(docs, kneser_ney.learn(docs)).collect()
        assert len(rows) == len(texts) and all(np.isfinite(x.score) and x.score < 0 for x in rows)
    for counts in ([10, 1, 30, 0], [0, 0, 0, 0], [60, 0, 0, 5], [0, 7, 3, 9], [5, 5, 5, 5]):
        assert all(0 < d <= k for k, d in enumerate(kneser_ney.discounts(counts), 1))


# packing
def test_packing(documents):  # noqa: F811
    rows = packing.pack(documents()).collect()
    assert {r.doc_id for r in rows} == set(range(len(odd_texts())))
    for doc in {r.doc_id for r in rows}:
        mine = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert [r.start for r in mine] == np.cumsum([0, *(r.length for r in mine[:-1])]).tolist()
        assert all(r.length == 1024 for r in mine[1:])
    for s in {r.sequence_id for r in rows}:
        mine = sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset)
        assert [r.offset for r in mine] == np.cumsum([0, *(r.length for r in mine[:-1])]).tolist()
        assert sum(r.length for r in mine) <= 1024
    assert [r.length for r in rows if r.doc_id == 0] == [1]
    assert packing.pack(documents([])).count() == 0


# vectors
def test_vectors(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 6)).astype("float32").tolist()
    rows = [(i, v, "x") for i, v in enumerate(x)] + [(300, None, "x"), (301, [], "x"), (302, [None] * 6, "x"), (303, [float("nan")] * 6, "x"), (304, [1.0] * 5, "x"), (None, x[0], "x")]
    rows += [(305, x[5], "x"), (306, x[5], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string")
    vectors = cover_tree.quantised(df)
    got = defaultdict(list)
    for row in cover_tree.top_inner_products(vectors, vectors.where("id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[row.query_id].append((row.rank, row.vec_id, row.score))
    q = {i: np.floor(64 * np.array(v, dtype=float)).astype(int) for i, v, _ in rows if i is not None and v and len(v) == 6 and i not in (302, 303)}
    assert set(got) == {i for i in q if i % 20 == 0}
    for a, found in got.items():
        best = sorted(((-int(q[b] @ q[a]), b) for b in q if b != a))[:20]
        assert found == [(k + 1, b, -s) for k, (s, b) in enumerate(best)]
    few = cover_tree.quantised(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>"))
    assert [tuple(x) for x in cover_tree.top_inner_products(few, few.where("id = 0")).collect()] == [(0, 1, 1, 8192)]
    none = few.limit(0)
    assert cover_tree.top_inner_products(none, none).count() == 0


def test_vectors_of_any_length_and_size(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e15, -3.0]), (2, [3.0]), (20, [0.5]), (3, [2.0, 1.0]), (40, [1e300, 0.0]), (4, [2.0]), (5, [-1e300, 1.0])]
    vectors = cover_tree.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in cover_tree.top_inner_products(vectors, vectors.where("id % 20 = 0")).collect()}
    most = 1 << 62
    assert [got[0, k] for k in (1, 2, 3, 4)] == [(40, most), (1, 64 * int(64e15) - 128 * 192), (3, 128 * 64 * 2), (5, -most)]
    assert [got[20, k] for k in (1, 2)] == [(2, 32 * 192), (4, 32 * 128)]
    assert [got[40, k] for k in (1, 2, 3, 4)] == [(0, most), (1, most), (3, most), (5, -most)] and len(got) == 10


# personal data
def test_personal_data(documents):  # noqa: F811
    docs = documents()
    rows = by_id(pii.find(docs, None))
    assert rows[0].spans == "" and rows[14].n_email == 1 and rows[14].n_ip == 1
    assert rows[14].n_phone == 0 and rows[14].n_card == 0  # one run of digits to the patterns
    clean = by_id(pii.redact(docs, None))
    assert "[EMAIL]" in clean[14].text and clean[14].n_chars == len(clean[14].text) and clean[5].text == PROSE and clean[0].text is None
    assert pii.train(documents([None, "no digits"])) is None
    assert pii.find(documents([]), None).count() == 0


def test_digest_of_base_spans(spark, sf_dir):
    """Digest and counts of whole texts against the patterns as the contract states them."""
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def luhn(d):
        twice = [2 * int(c) if i % 2 else int(c) for i, c in enumerate(reversed(d))]
        return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0

    def plain(t):
        digits = lambda m: re.sub("[^0-9]", "", m.group())
        found = [(m.start(), 0, "email", m.end()) for m in email.finditer(t)]
        found += [(m.start(), 1, "ip", m.end()) for m in ip.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
        found += [(m.start(), 2, "card", m.end()) for m in card.finditer(t) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
        found += [(m.start(), 3, "phone", m.end()) for m in phone.finditer(t) if 10 <= len(digits(m)) <= 15]
        return sorted(found)

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tagger = pii.train(docs)
    rows, clean = by_id(pii.find(docs, tagger)), by_id(pii.redact(docs, tagger))
    seen = 0
    for r in docs.collect():
        spans = plain(r.text or "")
        got = rows[r.doc_id]
        assert got.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in spans).encode()).hexdigest()
        assert [got.n_email, got.n_ip, got.n_card, got.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        every = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in got.spans.split(",") if x)]
        assert {(s, e, k) for s, _, k, e in spans} <= set(every) and every == sorted(every, key=lambda x: x[0])
        out, at = "", 0
        for s, e, k in every:  # what overlaps is one
            if s >= at:
                out += r.text[at:s] + f"[{k.upper()}]"
            at = max(at, e)
        assert clean[r.doc_id].text == (None if r.text is None else out + r.text[at:])
        seen += len(spans)
    assert seen


def test_training_sees_ends_of_long_texts(documents):  # noqa: F811
    """Spans and lines far down a long text are learnt from: neither is cut to a head."""
    text = "plain words " * 3000 + "call +1 (269) 555-3296 now"
    named, pieces = pii.stretches(text, 7)
    assert named == [(3, "+1 (269) 555-3296")] and len(pieces) == pii.PER_TEXT
    lines = quality_crf.drawn_lines(11, 0, 5000)
    assert sum(b - a for a, b in lines) == quality_crf.MAX_LINES and max(b for _, b in lines) > 1000
    docs = documents([PROSE] * 8 + ["\n".join([PROSE] * 200 + ["# $ % 1 2 3 !!"] * 800)] * 8)
    labels = docs.selectExpr("doc_id", "cast(doc_id < 8 as int) quality")
    sample = quality_crf.training_sample(docs, labels)
    bad = sample[sample.quality == 0]
    assert len(bad) and all(len(x) == 4 and sum(x) == quality_crf.MAX_LINES for x in bad.sizes)
    signs = [(np.frombuffer(x, np.float32).reshape(-1, quality_crf.N_FEATURES)[:, 2] > 0.2).sum() for x in bad.lines]
    assert sum(signs) > 20 * len(bad)  # most lines stand in the bad four fifths


def test_long_span_is_put_together():
    a, b = pii.WIDTH, pii.STRIDE
    cut = [(1.0, 20, a, 0, False, True), (2.0, b, a + b, 0, True, True), (1.0, 2 * b, 2 * b + 70, 0, True, False), (3.0, 400, 410, 1, False, False)]
    assert pii.joined(cut) == [(3.0, 400, 410, 1), (4.0, 20, 2 * b + 70, 0)]
    assert pii.joined([(1.0, 150, 160, 3, False, True), (1.0, 150, 170, 3, False, False), (1.0, 160, 170, 3, True, False)]) == [(1.0, 150, 170, 3)]


# near copies
def plain_classes(texts):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and label[i] != label[j]:
                lo, hi = sorted((label[i], label[j]))
                label = [lo if x == hi else x for x in label]
    return [(len(s), c) for s, c in zip(sets, label)]


def copies(n=220, seed=1):
    r = np.random.default_rng(seed)
    word = lambda: "w" + str(int(r.integers(3000)))
    base = [[word() for _ in range(90)] for _ in range(6)]
    texts = odd_texts()
    for _ in range(n):
        w = list(base[int(r.integers(3 if r.random() < 0.8 else 6))])
        for _ in range(int(r.integers(0, 6))):
            w[int(r.integers(len(w)))] = word()
        texts.append(" ".join(w[: int(r.integers(75, 91))]))
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_near_copies(documents, monkeypatch, small):  # noqa: F811
    if small:  # frequent shingles and several blocks although there are few documents
        monkeypatch.setattr(ngram_join, "CLASSES", (3, 12))
        monkeypatch.setattr(grouping, "BLOCK_ROWS", 25)
        monkeypatch.setattr(grouping, "ROUNDS", 1)
        monkeypatch.setattr(components, "ONE_TASK", 20)
        monkeypatch.setattr(ngram_join, "FLUSH", 3000)
    texts = copies()
    rows = by_id(ngram_join.classes(documents(texts)))
    assert [(rows[i].n_shingles, rows[i].component_id) for i in range(len(texts))] == plain_classes(texts)


def test_near_copies_on_odd_rows(spark, documents):  # noqa: F811
    assert ngram_join.classes(documents([])).count() == 0
    docs = documents([PROSE, PROSE, None, "", "a", "a"])
    kept = ngram_join.drop_near_copies(docs.union(docs.where("doc_id = 0")))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4]


@pytest.mark.parametrize("one_task", [components.ONE_TASK, 0])
def test_components(spark, monkeypatch, one_task):
    monkeypatch.setattr(components, "ONE_TASK", one_task)  # 0: rounds of contraction until no edge is left
    edges = [(i, i + 1) for i in range(0, 40)] + [(50, 60), (55, 60), (70, 71)]
    got = {r.vertex: r.label for r in components.connect(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 55: 50, 70: 70, 71: 70}


# pages, conversations, pieces
def test_urls_on_odd_rows(spark):
    urls = [None, "", "nourl", "http://ORG/", "http://a.b.example.org/es/x?q#f", "https://example.org", "x://forg/", "http://x.com/de/", "http://y.com/fr/1", "http://x.casino.net", "http://é.example.org/en/12", "http://" + "a" * 5000 + ".com/fr/"]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule2 string")
    rows = by_id(url_filters.filter_urls(url_filters.canonical(pages), URL_RULES, URL_GLOBS), "page_id")
    assert [(rows[i].rule, rows[i].verdict) for i in range(12)] == [(None, "allow")] * 3 + [("org/", "allow"), ("example.org/es/", "block"), (None, "allow"), (None, "allow"), ("com/de/", "block"), ("com/fr/", "allow"), (None, "block"), ("example.org/en/1", "block"), ("com/fr/", "allow")]
    assert rows[0].host == "" and rows[4].path == "/es/x"
    assert url_filters.filter_urls(url_filters.canonical(pages.limit(0)), URL_RULES, URL_GLOBS).count() == 0


def test_preferences(spark):
    schema = "pair_id long, turn long, role string, text string, prompt string"
    chosen = [(1, 0, "user", "q", ""), (1, 1, "assistant", "yes", ""), (2, 0, "user", None, ""), (3, 0, None, "x", ""), (3, 1, "assistant", "", ""), (None, 0, "user", "q", "")]
    rejected = [(1, 0, "user", "q", ""), (1, 0, "user", "q", ""), (1, 1, "assistant", "no", ""), (2, 0, "user", None, ""), (4, 0, "user", "only", "")]
    rows = by_id(preferences.format_pairs(spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema)), "pair_id")
    assert set(rows) == {1, 2, 3, 4}
    assert rows[1].prompt == "<|user|>\nq<|end|>\n" and rows[1].prefix_turns == 1
    assert rows[1].chosen == "<|assistant|>\nyes<|end|>\n" and [rows[1].chosen[a:b] for a, b in rows[1].chosen_mask] == ["yes"]
    assert [rows[1].rejected[a:b] for a, b in rows[1].rejected_mask] == ["no"]
    assert rows[2].chosen == rows[2].rejected == "" and rows[2].prefix_turns == 1
    assert rows[3].prompt == "" and rows[3].rejected == "" and [rows[3].chosen[a:b] for a, b in rows[3].chosen_mask] == [""]
    empty = spark.createDataFrame([], schema)
    assert preferences.format_pairs(empty, empty).count() == 0


def test_pieces_on_odd_rows(documents):  # noqa: F811
    rows = by_id(unigram.encode_documents(documents()))
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in rows.values())
    assert rows[0].n_ids == 0 and rows[9].n_fallback > 0
    assert unigram.encode_documents(documents([])).count() == 0


# pipeline
def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id for r in docs.collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for (name, stage), plain in zip(corpus_pipeline.STAGES, ("crf", "rules", "copies", None, None)):
        before, docs = docs, stage(spark, docs, sf_dir)
        ids = {r.doc_id for r in docs.collect()}
        if plain == "crf":
            assert ids == {r.doc_id for r in quality_crf.classify(before, labels).where("predicted = 1").collect()}
        elif plain == "rules":
            assert ids == {r.doc_id for r in quality_rules.apply_rules(before).where("kept").collect()}
        elif plain == "copies":
            texts = [(r.doc_id, r.text) for r in before.orderBy("doc_id").collect()]
            assert ids == {i for k, (i, _) in enumerate(texts) if plain_classes([t for _, t in texts])[k][1] == k} if len(texts) < 60 else len(ids) <= len(texts)
        else:
            assert ids == {r.doc_id for r in before.collect()}
        assert ids <= kept and (docs.columns == columns or name == "best-fit packing")
        kept = ids
    run = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in run.collect()} == kept

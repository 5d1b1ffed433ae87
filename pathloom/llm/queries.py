"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm import cover_tree, importance, kneser_ney, ngram_join, packing, pii, preferences, quality_crf, quality_rules, spelling, super_minhash, unigram, url_filters
from pathloom.llm.shared import table

#: (host, path, verdict): the longest that fits decides.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Globs for what no rule fits: kinds of hosts that carry advertising, betting, adult or spam pages.
BLOCKED_HOSTS = ["*casino*", "*adult*", "*pills*", "*bets.*", "*betting*", "*spam*", "*ads-*", "*.ads.*", "*tracker*", "*porn*"]
URL_GLOBS = [(g, "block") for host in BLOCKED_HOSTS for g in (host, f"{host}/**")]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preferences.neighbours(table(spark, sf_dir, "conversations"))
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s[0], s[1])), ",")
    return pairs.withColumns({c: shown(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.encode_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return kneser_ney.score(docs, kneser_ney.learn(docs))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = url_filters.canonical(table(spark, sf_dir, "pages").select("page_id", "url"))
    return url_filters.filter_urls(pages, URL_RULES, URL_GLOBS).select("page_id", "host", "path", "rule", "verdict")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cover_tree.quantised(table(spark, sf_dir, "embeddings"))
    return cover_tree.top_inner_products(vectors, vectors.where(F.col("id") % cover_tree.EVERY == 0))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op12_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return super_minhash.mark_copies(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), plant=spelling.PLANT))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_preferences": op2_preferences,
    "op3_quality_crf": op3_quality_crf,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_kneser_ney": op5_kneser_ney,
    "op6_url_filters": op6_url_filters,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_cover_tree": op8_cover_tree,
    "op9_pii": op9_pii,
    "op10_ngram_join": op10_ngram_join,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_super_minhash": op12_super_minhash,
    "op13_spelling_variants": op13_spelling_variants,
}

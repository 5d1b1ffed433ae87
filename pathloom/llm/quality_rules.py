"""Quality rules whose limits follow the data: quantile sketches per language and source.

Each document is measured (`with_metrics`): words, symbols, repeated lines and repeated passages. Four
ratios of these, as whole thousandths, go into sketches: counts per bucket of at most 1/16 relative
width. Sketches are sums, so they merge in any order and give the same limits after any retry; those of
a source with few documents give way to its language's, and those to the sketch of all.

A limit is the upper quartile plus `FENCE` times the quartile range plus a slack; a document beyond a
limit is not kept. Documents that fail the base check (too short, or mostly repeated passages) are
never kept and are left out of the sketches.

Defined results: a null or empty text has no words and fails the base check; null languages and
sources form groups of their own; repeated rows count each time and come out each time; an empty table
gives an empty result; further columns are carried or ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pathloom.llm import text as tx
from pathloom.llm.shared import map_arrow, shielded, written

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
#: Quartile ranges between the upper quartile and the limit (3: far outside, in Tukey's sense).
FENCE = 3
#: Documents a sketch must hold to set limits of its own.
MIN_DOCS = 200
#: Thousandths by which a limit is wider, so that a ratio that hardly varies sets no needle-thin limit.
SLACK = {"symbols": 100, "length": 1500, "dup_lines": 500, "repeats": 300}
#: The ratio as SQL over the measures.
RATIOS = {
    "symbols": "1000 * n_symbols div greatest(n_words, 1)",
    "length": "1000 * word_chars div greatest(n_words, 1)",
    "dup_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words div greatest(n_words, 1)",
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
METRICS = "__quality_rules"

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def repeated(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash occurs more than once in its document, and whether it occurs before in it."""
    key = tx.mix(hashes + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again, later = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    later[order[1:][same]] = True
    return again, later


def measure(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    words = tx.Words(buf, offsets)
    n = words.n_docs
    lead = (buf & 0xC0) != 0x80
    out = {
        "n_words": words.counts,
        "word_chars": tx.per_doc(lead & tx.IS_WORD[buf], offsets),
        "n_symbols": tx.per_doc(_SYMBOL[buf], offsets),
    }
    breaks = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    line_doc = np.searchsorted(offsets, starts, side="right") - 1
    # A break at a text's very end opens an empty line at the next text's start: such lines have no word.
    ends = np.minimum(np.append(starts[1:], len(buf)), offsets[np.minimum(line_doc + 1, n)])
    broken = (ends > starts) & (buf[np.maximum(ends - 1, 0)] == 10) if len(buf) else np.zeros(len(starts), dtype=bool)
    ends = ends - broken
    full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, line_doc = starts[full], ends[full], line_doc[full]
    _, later = repeated(tx.segment_hashes(buf, starts, ends), line_doc)
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=n)
    window = tx.windows(words.hashes(lower=False), WINDOW)
    cover = np.zeros(len(words.starts) + 1, dtype=np.int64)
    if len(window):
        whole = words.doc[: len(window)] == words.doc[WINDOW - 1 :]
        at = np.flatnonzero(whole)
        again, _ = repeated(window[at], words.doc[at])
        np.add.at(cover, at[again], 1)
        np.add.at(cover, at[again] + WINDOW, -1)
    out["n_repeat_words"] = tx.per_doc(np.cumsum(cover[:-1]) > 0, words.bounds)
    return {k: v.astype(np.int64) for k, v in out.items()}


def with_metrics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns in `keep` (default: all) and the measures of column `text` as struct METRICS."""
    keep = docs.columns if keep is None else keep
    schema = T.StructType([docs.schema[c] for c in keep])
    schema.add(METRICS, T.StructType([T.StructField(m, T.LongType(), False) for m in MEASURES]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in tx.groups(batch.column("text")):
                found = measure(buf, offsets)
                struct = pa.StructArray.from_arrays([pa.array(found[m]) for m in MEASURES], MEASURES)
                columns = [batch.column(c).slice(i, j - i) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, struct], [*keep, METRICS])

    source = docs if set(keep) == set(docs.columns) else docs.select(*dict.fromkeys([*keep, "text"]))
    return map_arrow(source, work, schema)


def base_failed() -> Column:
    n = F.col(f"{METRICS}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{METRICS}.n_repeat_words") > REPEAT_PERCENT * n)


def _ratios() -> list[Column]:
    sql = {}
    for name, ratio in RATIOS.items():
        for m in MEASURES:
            ratio = ratio.replace(m, f"{METRICS}.{m}")
        sql[name] = F.expr(ratio)
    return [c.alias(n) for n, c in sql.items()]


def _bucket(v: Column) -> Column:
    """The lower bound of the bucket of v: its five leading bits."""
    drop = F.greatest(F.length(F.bin(v)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketches(metrics: DataFrame) -> DataFrame:
    """lang, source, feature, bucket, n: counts of the ratios of documents that pass the base check."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), c.alias("v")) for n, c in zip(RATIOS, _ratios(), strict=True)]))
    return (
        metrics.where(~base_failed())
        .select("lang", "source", pairs.alias("p"))
        .select("lang", "source", F.col("p.feature").alias("feature"), _bucket(F.col("p.v")).alias("bucket"))
        .groupBy("lang", "source", "feature", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def limits(sketch: DataFrame) -> DataFrame:
    """lang, source and a low and high limit per ratio, for every group of the sketches."""
    by_lang = sketch.groupBy("lang", "feature", "bucket").agg(F.sum("n").alias("n"))
    by_all = by_lang.groupBy("feature", "bucket").agg(F.sum("n").alias("n"))

    def fences(df: DataFrame, keys: list[str], level: str) -> DataFrame:
        w = Window.partitionBy(*keys, "feature").orderBy("bucket")
        whole = Window.partitionBy(*keys, "feature")
        cells = df.withColumns({"upto": F.sum("n").over(w), "total": F.sum("n").over(whole)})
        q = [F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bucket"))) for k in (1, 3)]
        rows = cells.groupBy(*keys, "feature").agg(q[0].alias("q1"), q[1].alias("q3"), F.first("total").alias("docs"))
        slack = F.element_at(F.create_map(*[x for k, v in SLACK.items() for x in (F.lit(k), F.lit(v))]), F.col("feature"))
        reach = FENCE * (F.col("q3") - F.col("q1")) + slack
        fence = F.struct("docs", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
        return rows.select(*keys, "feature", fence.alias(level))

    own = fences(sketch, ["lang", "source"], "own")
    lang = fences(by_lang, ["lang"], "of_lang").withColumnsRenamed({"lang": "l", "feature": "lf"})
    every = fences(by_all, [], "of_all").withColumnsRenamed({"feature": "af"})
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("feature") == F.col("lf"))).join(every, F.col("feature") == F.col("af"))
    chosen = (
        F.when(F.col("own.docs") >= MIN_DOCS, F.col("own"))
        .when(F.col("of_lang.docs") >= MIN_DOCS, F.col("of_lang"))
        .otherwise(F.col("of_all"))
    )
    per_feature = [F.max(F.when(F.col("feature") == f, F.col("c"))).alias(f"limit_{f}") for f in RATIOS]
    return joined.withColumn("c", chosen).groupBy("lang", "source").agg(*per_feature)


def judged(metrics: DataFrame, found: DataFrame) -> DataFrame:
    """`metrics` with columns __base_failed and __kept, limits joined by language and source.

    The limits are one row per group: the planner broadcasts them below its size limit and else joins
    by sorting, where the side of the documents may be split.
    """
    found = found.withColumnsRenamed({"lang": "__lang", "source": "__source", **{f"limit_{f}": f"__limit_{f}" for f in RATIOS}})
    on = F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source"))
    inside = F.lit(True)
    for name, ratio in zip(RATIOS, _ratios(), strict=True):
        inside &= ratio <= F.col(f"__limit_{name}.high")
        if name == "length":
            inside &= ratio >= F.col(f"__limit_{name}.low")
    joined = metrics.join(found, on, "left")
    failed = base_failed()
    return joined.select(
        *[F.col(c) for c in metrics.columns],
        failed.alias("__base_failed"),
        F.coalesce(~failed & inside, F.lit(False)).alias("__kept"),
    )


def apply_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every document (columns doc_id, text, lang, source)."""
    metrics = written(with_metrics(docs.select("doc_id", "lang", "source", "text"), ["doc_id", "lang", "source"]), "quality-metrics")
    rows = judged(metrics, written(limits(sketches(metrics)), "quality-limits"))
    return rows.select(
        "doc_id", *[F.col(f"{METRICS}.{m}").alias(m) for m in MEASURES], F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept")
    )


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns; the texts are not shuffled while the limits are small."""
    narrow = with_metrics(docs.select("lang", "source", "text"), ["lang", "source"])
    found = written(limits(sketches(narrow)), "quality-limits")
    plain = shielded(docs, {"lang", "source", "text"})
    return judged(with_metrics(plain), found).where("__kept").select(*plain.columns).toDF(*docs.columns)

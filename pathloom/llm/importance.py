"""Target-distribution importance resampling: draw the documents that look most like a target corpus.

Features of a text are its runs of one to three words, hashed to BUCKETS buckets. A bucket's gain is the
logarithm of how much likelier the target makes it; a document's weight is the sum of its features'
gains, read from an array, and its score adds noise (Gumbel, from a hash of the id), so that the highest
scores are a draw without replacement by weight. Scores are ranked by a distributed radix sort (`radix`).

All counts are over whole texts of all rows. To the driver go BUCKETS counts a table, and back the array.

Defined results: a null text has no words; a document without words weighs 0; a null doc_id is hashed as
empty text and ranks after all others of its score; repeated rows are scored each, and rows of equal score
and id get neighbouring ranks in any order; without target texts every bucket is as likely as any, by the
added one; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm import crc
from pathloom.llm import text as tx
from pathloom.llm.radix import ranks
from pathloom.llm.shared import map_arrow, written

BUCKETS = 10_000
#: Words a document must have to be drawn, and how many of a hundred such documents are drawn.
LEAST_WORDS, PERCENT = 20, 5
SEED = 42
#: Bytes of words: digits, letters, and all of any character beyond ASCII.
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SPACE = zlib.crc32(b" ")


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[tx.Words, list[np.ndarray]]:
    """The words of some texts, and for runs of one, two and three words from each word on the bucket, or -1 where the text ends before."""
    low = tx.LOWER[buf]
    words = tx.Words(low, offsets, IN_WORD[buf])
    one = crc.segment_crcs(low, words.starts, words.ends)
    lengths = words.ends - words.starts
    run, found = one, [(one % BUCKETS).astype(np.int64)]
    for k in (1, 2):
        bucket = np.full(len(one), -1, dtype=np.int64)
        if len(one) > k:
            spaced = crc.moved(run[: len(one) - k], np.ones(len(one) - k, dtype=np.int64)) ^ np.uint32(_SPACE)
            run = crc.joined(spaced, one[k:], lengths[k:])
            bucket[: len(one) - k] = np.where(words.doc[:-k] == words.doc[k:], (run % BUCKETS).astype(np.int64), -1)
        found.append(bucket)
    return words, found


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, buf, offsets in tx.groups(batch.column("text")):
                for found in features(buf, offsets)[1]:
                    total += np.bincount(found[found >= 0], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    rows = map_arrow(texts.select("text"), work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of target to source probability, one added to every bucket, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight and row (a number of the row) of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        padded = np.append(gain, 0)
        for batch in batches:
            for i, j, buf, offsets in tx.groups(batch.column("text")):
                words, found = features(buf, offsets)
                n = sum(tx.per_doc(b >= 0, words.bounds) for b in found)
                weight = sum(tx.per_doc(padded[b], words.bounds) for b in found)
                columns = [batch.column("doc_id").slice(i, j - i), pa.array(words.counts), pa.array(n), pa.array(weight), pa.array(row + np.arange(j - i))]
                row += j - i
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight", "row"])

    return map_arrow(docs.select("doc_id", "text"), work, "doc_id long, n_words long, n_features long, weight long, row long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document; the rank is null where it is not drawn."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")
    scored = written(weigh(docs, gain).withColumn("score", F.col("weight") + noise), "scores")
    able = scored.where(F.col("n_words") >= LEAST_WORDS)
    drawn = percent * able.count() // 100
    keys = able.select("row", (-F.col("score")).alias("less"), F.col("doc_id").isNull().cast("long").alias("lost"), F.coalesce("doc_id", F.lit(0)).alias("id"))
    best = ranks(keys, "row", ["less", "lost", "id"]).where(F.col("rank") <= drawn)
    return scored.join(best, "row", "left").select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """The drawn documents with all their columns; rows without an id are never drawn here, repeated ids together."""
    ids = resample(docs, target, percent, seed).where("rank IS NOT NULL AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(ids, "doc_id", "left_semi").select(*docs.columns)

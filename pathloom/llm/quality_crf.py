"""Document quality from line labels: a linear-chain conditional random field over the lines.

Every line has features of its own and of its neighbours (`line_features`). The field labels each line
good or bad; the forward-backward marginals of "good", weighted by the lines' lengths in bytes, average
to the score of the document. It is trained in numpy by gradient ascent with momentum on the labels of
whole documents, which their lines inherit.

Training uses at most MAX_TRAIN labelled documents, those of the smallest hash of their id, and of each
at most MAX_LINES lines: of a longer text, runs of RUN neighbouring lines drawn by hash over its whole length,
each a chain of its own. Features are made of the whole text before lines are drawn, and no text goes to the
driver. Scoring has no bound. Neither language, source, id nor any label is a feature.

Defined results: a null or empty text is scored as one empty line; repeated rows are scored alike; of a
labelled id that repeats one text, that of the smallest hash, and the highest label count; without any training label every score is 0.5; an empty table
gives an empty result; further columns are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom.llm import text as tx
from pathloom.llm.quality_rules import repeated
from pathloom.llm.shared import doc_crc, map_arrow, shielded

#: Bound of the training sample and of the lines of each of its documents.
MAX_TRAIN, MAX_LINES, RUN = 3000, 64, 16
#: The score from which a document counts as good.
THRESHOLD = 0.3
STEPS, RATE, MOMENTUM, DECAY = 150, 0.5, 0.9, 1e-4
SCORE = "__quality_score"

_KINDS = np.zeros((256, 5), dtype=bool)
_KINDS[65:91, 0] = True  # capitals
_KINDS[48:58, 1] = True  # digits
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum()], 2] = True  # signs
_KINDS[[b for b in b"!?.,;:'\"()-"], 3] = True  # signs of usual prose
_KINDS[[b for b in b"!"], 4] = True
N_OWN = 11


def line_features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features and length of every line, and the first line of every text and the one after the last."""
    n_docs = len(offsets) - 1
    breaks = np.flatnonzero(buf == 10)
    # A line begins at each text's start and after each break that is not the text's last byte.
    starts = np.unique(np.concatenate([offsets[:-1] * 2, (breaks + 1) * 2 + 1]))
    doc_start = starts % 2 == 0
    starts = starts // 2
    inner = ~doc_start & np.isin(starts, offsets)
    starts, doc_start = starts[~inner], doc_start[~inner]
    doc = np.empty(len(starts), dtype=np.int64)
    empty_or_start = np.flatnonzero(doc_start)
    # Empty texts share an offset with the text after them: give each its own empty line.
    uniq, count = np.unique(offsets[:-1], return_counts=True)
    repeat = np.ones(len(starts), dtype=np.int64)
    repeat[empty_or_start] = count[np.searchsorted(uniq, starts[empty_or_start])]
    starts = np.repeat(starts, repeat)
    is_start = np.repeat(doc_start, repeat)
    doc = np.cumsum(is_start) - 1
    ends = np.append(starts[1:], len(buf))
    broken = (ends > starts) & (buf[np.maximum(ends - 1, 0)] == 10) if len(buf) else np.zeros(len(starts), dtype=bool)
    ends = ends - broken
    length = ends - starts
    words = tx.Words(buf, offsets)
    lo, hi = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    n_words = hi - lo
    per = [np.concatenate([[0], np.cumsum(_KINDS[buf, k], dtype=np.int64)]) for k in range(5)]
    share = [(c[ends] - c[starts]) / np.maximum(length, 1) for c in per]
    hashes = words.hashes(lower=True)
    line_of_word = np.repeat(np.arange(len(starts)), n_words)
    order = np.arange(len(hashes))
    _, again = repeated(hashes[order], line_of_word)
    repeats = tx.per_doc(again, np.append(np.cumsum(n_words) - n_words, len(hashes))) / np.maximum(n_words, 1)
    same_next = np.zeros(len(hashes))
    if len(hashes) > 1:
        same_next[1:] = (hashes[1:] == hashes[:-1]) & (line_of_word[1:] == line_of_word[:-1])
    runs = tx.per_doc(same_next, np.append(np.cumsum(n_words) - n_words, len(hashes))) / np.maximum(n_words, 1)
    _, later = repeated(tx.segment_hashes(buf, starts, ends), doc)
    word_bytes = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    mean = (word_bytes[hi] - word_bytes[lo]) / np.maximum(n_words, 1)
    own = np.stack(
        [share[0], share[1], share[2], share[2] - share[3], 4 * share[4], repeats, runs, later & (n_words > 0), np.log1p(n_words) / 5, np.minimum(mean, 30) / 10, n_words < 3],
        axis=1,
    ).astype(np.float64)
    first = np.searchsorted(doc, np.arange(n_docs))
    after = np.searchsorted(doc, np.arange(n_docs), side="right")
    around = np.zeros((len(starts), 2 * N_OWN))
    before_ok, next_ok = np.ones(len(starts), dtype=bool), np.ones(len(starts), dtype=bool)
    before_ok[first], next_ok[after - 1] = False, False
    around[1:, :N_OWN] = own[:-1]
    around[:-1, N_OWN:] = own[1:]
    around[~before_ok, :N_OWN] = own[~before_ok]
    around[~next_ok, N_OWN:] = own[~next_ok]
    squares = own[:, [0, 2, 3, 5, 9]] ** 2
    return np.concatenate([own, around, squares, np.ones((len(own), 1))], axis=1), length, first, after


N_FEATURES = 3 * N_OWN + 5 + 1


class LineField:
    """Labels 0 (bad) and 1 (good): a weight per feature for good, and a weight per pair of neighbours."""

    def __init__(self, weights: np.ndarray | None = None, pairs: np.ndarray | None = None):
        self.weights = np.zeros(N_FEATURES) if weights is None else weights
        self.pairs = np.zeros((2, 2)) if pairs is None else pairs

    def marginals(self, x: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line, and the expected count of every pair of neighbouring labels.

        Texts advance together, one line a step, the longest first; potentials stay in logarithms.
        """
        score = x @ self.weights
        size = after - first
        order = np.argsort(-size, kind="stable")
        at, size = first[order], size[order]
        n = len(x)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        unary = np.stack([np.zeros(n), score], axis=1)
        forward[at] = unary[at]
        steps = int(size[0]) if len(size) else 0
        live = [int(np.searchsorted(-size, -k, side="left")) for k in range(steps)]  # texts of more than k lines
        for k in range(1, steps):
            i = at[: live[k]] + k
            f = forward[i - 1]
            forward[i] = unary[i] + np.logaddexp(f[:, :1] + self.pairs[0], f[:, 1:] + self.pairs[1])
        for k in range(steps - 2, -1, -1):
            i = at[: live[k + 1]] + k
            b = backward[i + 1] + unary[i + 1]
            backward[i] = np.logaddexp(self.pairs[:, 0] + b[:, :1], self.pairs[:, 1] + b[:, 1:])
        total = forward + backward
        good = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -700, 700)))
        inner = np.ones(n, dtype=bool)
        inner[first] = False
        j = np.flatnonzero(inner)
        joint = forward[j - 1][:, :, None] + self.pairs + (unary[j] + backward[j])[:, None, :]
        joint = np.exp(joint - np.logaddexp(total[j, 0], total[j, 1])[:, None, None])
        return good, joint.sum(axis=0)

    def fit(self, x: np.ndarray, first: np.ndarray, after: np.ndarray, label: np.ndarray, doc: np.ndarray | None = None) -> LineField:
        """`doc` numbers the document of each chain, where one may have several."""
        lines = after - first
        doc = np.arange(len(first)) if doc is None else doc
        y = np.repeat(label, lines)
        of_doc = np.bincount(doc, weights=lines)
        weight = np.repeat(1.0 / np.maximum(of_doc[doc], 1), lines)  # every document counts alike in the mean gradient
        inner = np.repeat(np.maximum(lines - 1, 0), 1)
        seen = np.zeros((2, 2))
        seen[0, 0], seen[1, 1] = inner[label == 0].sum(), inner[label == 1].sum()
        step_w, step_p = np.zeros_like(self.weights), np.zeros_like(self.pairs)
        for _ in range(STEPS):
            good, pairs = self.marginals(x, first, after)
            gradient = x.T @ ((y - good) * weight) / len(of_doc) - DECAY * self.weights
            step_w = MOMENTUM * step_w + RATE * gradient
            step_p = MOMENTUM * step_p + RATE * ((seen - pairs) / len(x) - DECAY * self.pairs)
            self.weights = self.weights + step_w
            self.pairs = np.clip(self.pairs + step_p, -3, 3)
        return self

    def score(self, x: np.ndarray, length: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        good, _ = self.marginals(x, first, after)
        weight = length + 1.0
        bounds = np.append(first, after[-1:]) if len(first) else np.zeros(1, dtype=np.int64)
        return tx.per_doc(good * weight, bounds) / tx.per_doc(weight, bounds)


def drawn_lines(seed: int, first: int, after: int) -> list[tuple[int, int]]:
    """The chains (from, to) that are learnt of a text's lines: all, or runs drawn over the whole text."""
    if after - first <= MAX_LINES:
        return [(first, after)]
    starts = np.arange(first, after, RUN)
    order = np.argsort(tx.mix((starts - first).astype(np.uint64) ^ np.uint64(seed & (1 << 64) - 1)), kind="stable")
    return [(s, min(s + RUN, after)) for s in np.sort(starts[order[: MAX_LINES // RUN]]).tolist()]


def training_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> pd.DataFrame:
    """doc_id, quality, and features of lines (float32, by chain: `sizes`) of at most `limit` labelled documents outside the
    held-out fold, by the hash of their id."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    rank = F.xxhash64("doc_id")
    chosen = known.select("doc_id", "quality", rank.alias("h")).orderBy("h", "doc_id").limit(limit)
    found = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("of_text")).join(F.broadcast(chosen), "doc_id")  # at most `limit` rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_pylist()
            for i, j, buf, offsets in tx.groups(batch.column("text")):
                x, _, first, after = line_features(buf, offsets)
                chains = [drawn_lines(h[i + d], int(first[d]), int(after[d])) for d in range(j - i)]
                cells = [np.concatenate([x[a:b] for a, b in c]).astype(np.float32).tobytes() for c in chains]
                sizes = [[b - a for a, b in c] for c in chains]
                kept = [batch.column(c).slice(i, j - i) for c in ("doc_id", "quality", "h", "of_text")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(sizes, pa.list_(pa.int32())), pa.array(cells, pa.binary())], ["doc_id", "quality", "h", "of_text", "sizes", "lines"])

    drawn = map_arrow(found, work, "doc_id long, quality int, h long, of_text long, sizes array<int>, lines binary")
    once = drawn.groupBy("doc_id", "quality", "h").agg(F.min(F.struct("of_text", "sizes", "lines")).alias("t"))  # one row for each of `limit` ids
    return once.select("h", "doc_id", "quality", "t.sizes", "t.lines").orderBy("h", "doc_id").toPandas()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(doc_crc(doc_id) % 5 == 0, F.lit(False))


def train(sample: pd.DataFrame) -> LineField:
    field = LineField()
    if len(sample):
        x = np.frombuffer(b"".join(sample["lines"]), dtype=np.float32).reshape(-1, N_FEATURES).astype(np.float64)
        sizes = [np.asarray(s, dtype=np.int64) for s in sample["sizes"]]
        doc = np.repeat(np.arange(len(sizes)), [len(s) for s in sizes])
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        field.fit(x, bounds[:-1], bounds[1:], sample["quality"].to_numpy().astype(np.int64)[doc], doc)
    return field


def with_scores(docs: DataFrame, field: LineField, keep: list[str] | None = None) -> DataFrame:
    """The columns in `keep` (default: all) and the score of column `text` as SCORE."""
    keep = docs.columns if keep is None else keep
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(SCORE, T.DoubleType(), False)])
    weights, pairs = field.weights, field.pairs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LineField(weights, pairs)
        for batch in batches:
            for i, j, buf, offsets in tx.groups(batch.column("text")):
                score = model.score(*line_features(buf, offsets))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in keep), pa.array(np.clip(score, 0, 1))], [*keep, SCORE])

    source = docs if set(keep) == set(docs.columns) else docs.select(*dict.fromkeys([*keep, "text"]))
    return map_arrow(source, work, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    field = train(training_sample(docs, labels))
    rows = with_scores(docs.select("doc_id", "text"), field, ["doc_id"])
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(SCORE).alias("score"), (F.col(SCORE) >= THRESHOLD).cast("int").alias("predicted"))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be good, with all their columns."""
    plain = shielded(docs, {"doc_id", "text"})
    return with_scores(plain, train(training_sample(docs, labels))).where(F.col(SCORE) >= THRESHOLD).select(*plain.columns).toDF(*docs.columns)

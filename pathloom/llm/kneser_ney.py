"""An interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped for scoring.

Words are hashed; the number of a word is the place of its hash among all hashes in order. A bigram's key
holds both numbers, scattered over its range by a bijection, so keys of all bigrams sort into equal
parts whatever words are frequent, and give their words back. Three passes over the texts:

1. `vocabulary`: hashes of words and their counts, in sorted arrays, a file for each part;
2. `bigrams`: keys and counts likewise; each part adds up, per word, what contexts and continuations need;
3. `score`: workers map these files and look up each text's words and bigrams, without a shuffle.

Counts, of counts too, cover all training texts; nothing is cut off. The files hold about 12 bytes a
distinct bigram and 32 a distinct word; workers keep none of it on the heap.

Defined results: a null or empty text is one token, the end; a row without id is not learned from and
counts as held out; repeated rows are learned and scored each time; without any training text every
probability is 1; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pathloom.llm import text as tx
from pathloom.llm.mapped import load, narrow, save
from pathloom.llm.shared import even_keys, map_arrow, parts, written
from workload.scratch import shared_folder

U64 = np.uint64
FOLDS = 10
#: The end of a text as a word, and distinct keys a task gathers before it deals them out.
END, FLUSH = U64(0x0E4D0F7E07), 3_000_000
_DEALT = "part long, payload binary"


def learned(ids: list[int | None], folds: int = FOLDS) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % folds != 0 for i in ids], dtype=bool)


def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text followed by END, and where each text begins."""
    words = tx.Words(buf, offsets)
    bounds = words.bounds + np.arange(words.n_docs + 1)
    out = np.full(int(bounds[-1]), END, dtype=U64)
    inner = np.ones(len(out), dtype=bool)
    inner[bounds[1:] - 1] = False
    out[inner] = words.hashes(lower=True)
    return out, bounds


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.empty(0, dtype=U64), np.empty(0, dtype=np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
    return key[first], np.add.reduceat(count[order], first) if len(first) else count


class _Gatherer:
    """Distinct keys and counts of a task, merged as they come."""

    def __init__(self):
        self.keys, self.counts, self.size, self.merged = [], [], 0, 0

    def add(self, keys: np.ndarray) -> None:
        key, count = np.unique(keys, return_counts=True)
        self.keys.append(key)
        self.counts.append(count)
        self.size += len(key)
        if self.size > self.merged + FLUSH // 3:
            self._merge()

    def _merge(self) -> None:
        key, count = _merged(self.keys, self.counts)
        self.keys, self.counts, self.size, self.merged = [key], [count], len(key), len(key)

    def full(self) -> bool:
        return self.merged > FLUSH

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self._merge()
        out = self.keys[0], self.counts[0]
        self.__init__()
        return out


def _part(key: np.ndarray, bits: int, n: int) -> np.ndarray:
    return (((key >> U64(bits - 16)) * U64(n)) >> U64(16)).astype(np.int64)


def _encode(key: np.ndarray, count: np.ndarray) -> bytes:
    """Keys in order as differences, in four bytes where they fit."""
    step = np.diff(key, prepend=key[:1])
    small = len(step) == 0 or int(step.max()) < 1 << 32
    head = np.array([len(key), 4 if small else 8, key[0] if len(key) else 0], dtype=U64)
    return head.tobytes() + step.astype(np.uint32 if small else U64).tobytes() + count.astype(np.uint32).tobytes()


def _decode(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width, first = np.frombuffer(raw, U64, 3).tolist()
    step = np.frombuffer(raw, np.uint32 if width == 4 else U64, n, 24).astype(U64)
    return np.cumsum(step, dtype=U64) + U64(first), np.frombuffer(raw, np.uint32, n, 24 + width * n)


def _dealt(key: np.ndarray, count: np.ndarray, bits: int, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    at = np.searchsorted(_part(key, bits, len(places)), np.arange(len(places) + 1))
    for p in range(len(places)):
        if at[p + 1] > at[p]:
            payload = _encode(key[at[p] : at[p + 1]], count[at[p] : at[p + 1]])
            yield pa.RecordBatch.from_arrays([pa.array(places[p : p + 1]), pa.array([payload], pa.binary())], ["part", "payload"])


def _collected(batches: Iterator[pa.RecordBatch]) -> dict[int, list[bytes]]:
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for part, payload in zip(batch.column("part").to_pylist(), batch.column("payload"), strict=True):
            held.setdefault(part, []).append(payload.as_py())
    return held


class Scatter:
    """A bijection of keys of two numbers of `half` bits each."""

    def __init__(self, words: int):
        self.half = max(8, int(words + 1).bit_length())
        self.bits = 2 * self.half
        self.mask = U64((1 << self.bits) - 1)
        self.factors = [0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1]

    def key(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        x = (first.astype(U64) << U64(self.half)) | second.astype(U64)
        for f in self.factors:
            x = (x * U64(f)) & self.mask
            x ^= x >> U64(self.half)
        return x

    def words(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for f in reversed(self.factors):
            x = x ^ (x >> U64(self.half))
            x = (x * U64(pow(f, -1, 1 << 64))) & self.mask
        return (x >> U64(self.half)).astype(np.int64), (x & U64((1 << self.half) - 1)).astype(np.int64)


@dataclass
class Model:
    folder: str
    #: Number of the first word of every part, and the number of words at last.
    starts: list[int]
    n_tokens: int = 0
    n_texts: int = 0
    n_bigrams: int = 0
    #: Discounts of counts 1, 2 and more: of bigrams, and of continuations.
    discounts: tuple[float, ...] = (0.0, 0.0, 0.0)
    lower_discounts: tuple[float, ...] = (0.0, 0.0, 0.0)
    #: Words with one, two and more continuations.
    lower_counts: tuple[int, ...] = (0, 0, 0)

    @property
    def n_words(self) -> int:
        return self.starts[-1]


class Reader:
    """The files of a model, mapped as they are needed."""

    def __init__(self, model: Model):
        self.model, self.n = model, len(model.starts) - 1
        self.scatter = Scatter(model.n_words)
        self.starts = np.array(model.starts, dtype=np.int64)
        self.files: dict[tuple[str, int], list[np.ndarray]] = {}

    def _file(self, kind: str, part: int, *dtypes: type) -> list[np.ndarray]:
        if (kind, part) not in self.files:
            self.files[kind, part] = load(f"{self.model.folder}/{kind}-{part}", *dtypes)
        return self.files[kind, part]

    def _found(self, kind: str, key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of keys in order: whether each is there, its place in its part's array, and its count."""
        there, place, count = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=np.int64), np.zeros(len(key), dtype=np.int64)
        part = _part(key, bits, self.n)
        for p in np.unique(part).tolist():
            i, j = np.searchsorted(part, [p, p + 1])
            keys, counts = self._file(kind, p, U64, None)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key[i:j]), len(keys) - 1)
                ok = keys[at] == key[i:j]
                there[i:j], place[i:j], count[i:j] = ok, at, np.where(ok, counts[at], 0)
        return there, place, count

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: not known) and count of every word."""
        key, back = np.unique(hashes, return_inverse=True)
        there, place, count = self._found("words", key, 64)
        number = np.where(there, place + self.starts[:-1][_part(key, 64, self.n)], -1)
        return number[back], count[back]

    def bigram_counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        key, back = np.unique(self.scatter.key(first, second), return_inverse=True)
        return self._found("bigrams", key, self.scatter.bits)[2][back]

    def stats(self, number: np.ndarray) -> np.ndarray:
        """Of words by number: contexts' bigrams of count 1, 2, more, and how many words come before (4, words)."""
        key, back = np.unique(number, return_inverse=True)
        out = np.zeros((4, len(key)), dtype=np.int64)
        part = key * self.n // (self.model.n_words + 1)
        for p in np.unique(part).tolist():
            i, j = np.searchsorted(part, [p, p + 1])
            columns = self._file("stats", p, *[np.uint32] * 4)
            first = -(-p * (self.model.n_words + 1) // self.n)
            for k, c in enumerate(columns):
                out[k, i:j] = c[key[i:j] - first]
        return out[:, back]

    def log10(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the probability of every token, and its count."""
        m = self.model
        number, count = self.words(hashes)
        before, before_count = np.empty_like(number), np.empty_like(count)
        before[1:], before_count[1:] = number[:-1], count[:-1]
        before[bounds[:-1]], before_count[bounds[:-1]] = m.n_words, m.n_texts  # a text's start
        known = number >= 0
        uses = np.zeros(len(number), dtype=np.int64)
        uses[known] = self.stats(number[known])[3]
        d = np.array([0.0, *m.lower_discounts])
        rest = float(np.dot(m.lower_discounts, m.lower_counts)) if m.n_bigrams else 1.0
        p = (uses - d[np.minimum(uses, 3)] + rest / (m.n_words + 1)) / max(m.n_bigrams, 1)
        context = (before >= 0) & (before_count > 0)
        both = context & known
        c = np.zeros(len(number), dtype=np.int64)
        c[both] = self.bigram_counts(before[both], number[both])
        d = np.array([0.0, *m.discounts])
        kinds = self.stats(before[context])[:3]
        total = before_count[context]
        c = c[context]
        p[context] = (c - d[np.minimum(c, 3)] + np.array(m.discounts) @ kinds * p[context]) / total
        return np.log10(p), count


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more, from how many things have the counts 1, 2, 3 and 4.

    Where counts of counts do not fall, as in small or steep tables, the estimate of a count may be 0 or less and would leave
    a context nothing for unseen words; absolute discounting takes its place there.
    """
    y = n[0] / max(n[0] + 2 * n[1], 1)
    plain = y if 0 < y < 1 else 0.5
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return tuple(min(d, float(k)) if d > 0 else plain for k, d in enumerate(found, 1))


def vocabulary(docs: DataFrame, folder: str, folds: int = FOLDS) -> Model:
    spark = docs.sparkSession
    keys = even_keys(spark, parts(spark))
    places, number = np.array(keys, dtype=np.int64), {k: i for i, k in enumerate(keys)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Gatherer()
        for batch in batches:
            batch = batch.filter(pa.array(learned(batch.column("doc_id").to_pylist(), folds)))
            for _, _, buf, offsets in tx.groups(batch.column("text")):
                held.add(tokens(buf, offsets)[0])
                if held.full():
                    yield from _dealt(*held.take(), 64, places)
        yield from _dealt(*held.take(), 64, places)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, payloads in _collected(batches).items():
            blocks = [_decode(p) for p in payloads]
            key, counts = _merged([b[0] for b in blocks], [b[1] for b in blocks])
            save(f"{folder}/words-{number[place]}", key, narrow(counts))
            ends = int(counts[key == END].sum())
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (number[place], len(key), int(counts.sum()), ends)], ["part", "words", "tokens", "ends"])

    dealt = map_arrow(docs.select("doc_id", "text"), count, _DEALT).repartition(len(keys), "part")
    rows = written(map_arrow(dealt, store, "part long, words long, tokens long, ends long"), "vocabulary").collect()  # a row a part
    sizes = np.zeros(len(keys), dtype=np.int64)
    for r in rows:
        sizes[r["part"]] = r["words"]
    for p in np.flatnonzero(sizes == 0).tolist():
        save(f"{folder}/words-{p}", np.empty(0, dtype=U64), np.empty(0, dtype=np.uint32))
    return Model(folder, [0, *np.cumsum(sizes).tolist()], sum(r["tokens"] for r in rows), sum(r["ends"] for r in rows))


def bigrams(docs: DataFrame, model: Model, folds: int = FOLDS) -> Model:
    spark = docs.sparkSession
    n_parts = len(model.starts) - 1
    keys = even_keys(spark, n_parts)
    places, number = np.array(keys, dtype=np.int64), {k: i for i, k in enumerate(keys)}
    scatter, folder, size = Scatter(model.n_words), model.folder, model.n_words + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, reader = _Gatherer(), Reader(model)
        for batch in batches:
            batch = batch.filter(pa.array(learned(batch.column("doc_id").to_pylist(), folds)))
            for _, _, buf, offsets in tx.groups(batch.column("text")):
                hashes, bounds = tokens(buf, offsets)
                second, _ = reader.words(hashes)
                first = np.concatenate([[0], second[:-1]])
                first[bounds[:-1]] = model.n_words
                held.add(scatter.key(first, second))
                if held.full():
                    yield from _dealt(*held.take(), scatter.bits, places)
        yield from _dealt(*held.take(), scatter.bits, places)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Writes a part's bigrams; what its words gain by them goes on to the words' part (kinds 1 to 4), counts of counts to kind 0."""
        for place, payloads in _collected(batches).items():
            blocks = [_decode(p) for p in payloads]
            key, counts = _merged([b[0] for b in blocks], [b[1] for b in blocks])
            save(f"{folder}/bigrams-{number[place]}", key, narrow(counts))
            first, second = scatter.words(key)
            kinds = np.minimum(counts, 3)
            told = [np.array([len(key), *((counts == k).sum() for k in (1, 2, 3, 4))], dtype=np.int64).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array(places[:1]), pa.array(told, pa.binary())], ["kind", "part", "payload"])
            for kind, words in ((1, first[kinds == 1]), (2, first[kinds == 2]), (3, first[kinds == 3]), (4, second)):
                word, gain = np.unique(words, return_counts=True)
                at = np.searchsorted(word * n_parts // size, np.arange(n_parts + 1))
                for p in range(n_parts):
                    if at[p + 1] > at[p]:
                        payload = [_encode(word[at[p] : at[p + 1]].astype(U64), gain[at[p] : at[p + 1]])]
                        yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array(places[p : p + 1]), pa.array(payload, pa.binary())], ["kind", "part", "payload"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        told = np.zeros(5, dtype=np.int64)
        for batch in batches:
            for kind, place, payload in zip(batch.column("kind").to_pylist(), batch.column("part").to_pylist(), batch.column("payload"), strict=True):
                raw, p = payload.as_py(), number[place]
                if kind == 0:
                    told += np.frombuffer(raw, np.int64)
                    continue
                first, end = -(-p * size // n_parts), -(-(p + 1) * size // n_parts)
                sums = held.setdefault(p, [np.zeros(end - first, dtype=np.uint32) for _ in range(4)])
                word, gain = _decode(raw)
                sums[kind - 1][word.astype(np.int64) - first] += gain
        lower = np.zeros(5, dtype=np.int64)
        for p, sums in held.items():
            save(f"{folder}/stats-{p}", *sums)
            lower += np.array([*((sums[3] == k).sum() for k in (1, 2, 3, 4)), (sums[3] >= 3).sum()])
        made = [np.array(sorted(held), dtype=np.int64).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([told.tobytes()], pa.binary()), pa.array([lower.tobytes()], pa.binary()), pa.array(made, pa.binary())], ["told", "lower", "made"])

    dealt = map_arrow(docs.select("doc_id", "text"), count, _DEALT).repartition(n_parts, "part")
    gains = map_arrow(dealt, store, "kind int, part long, payload binary").repartition(n_parts, "part")
    rows = written(map_arrow(gains, total, "told binary, lower binary, made binary"), "bigrams").collect()  # a row a part
    told, lower = (sum((np.frombuffer(r[c], np.int64) for r in rows), np.zeros(5, dtype=np.int64)).tolist() for c in ("told", "lower"))
    made = {p for r in rows for p in np.frombuffer(r["made"], np.int64).tolist()}
    for p in set(range(n_parts)) - made:
        length = -(-(p + 1) * size // n_parts) - -(-p * size // n_parts)
        save(f"{folder}/stats-{p}", *[np.zeros(length, dtype=np.uint32)] * 4)
    model.n_bigrams, model.discounts = told[0], discounts(told[1:])
    model.lower_discounts, model.lower_counts = discounts(lower[:4]), (lower[0], lower[1], lower[4])
    return model


def learn(docs: DataFrame, folds: int = FOLDS) -> Model:
    folder = shared_folder(docs.sparkSession, "language-model")
    return bigrams(docs, vocabulary(docs, folder, folds), folds)


def score(docs: DataFrame, model: Model, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        floor = model.n_tokens + 0.1 * (model.n_words + 1)
        for batch in batches:
            for i, j, buf, offsets in tx.groups(batch.column("text")):
                hashes, bounds = tokens(buf, offsets)
                log_p, count = reader.log10(hashes, bounds)
                ids = batch.column("doc_id").slice(i, j - i)
                base = tx.per_doc(np.log10((count + 0.1) / floor), bounds)
                columns = [pa.array(~learned(ids.to_pylist(), folds)), pa.array(np.diff(bounds)), pa.array(tx.per_doc(count > 0, bounds)), pa.array(np.full(j - i, model.n_tokens)), pa.array(base), pa.array(tx.per_doc(log_p, bounds))]
                yield pa.RecordBatch.from_arrays([ids, *columns], names)

    return map_arrow(docs.select("doc_id", "text"), work, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

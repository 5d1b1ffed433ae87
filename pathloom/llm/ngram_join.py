"""Jaccard self-join of documents by word n-grams, with token-combination prefixes.

A document's set holds the hashes of its distinct five-word shingles. Two documents link when their
sets' Jaccard similarity is at least PERCENT / 100; classes are the connected components of the links.

1. Every shingle is counted: tasks deal their shingles out by hash in packed blocks, each part counts
   how many documents hold a shingle, and tells documents the shingles that others hold too. A document
   of which fewer than PERCENT hundredths are shared can link with nothing and is done.
2. Documents of equal sets become one; one of each is kept as representative.
3. Shingles are ordered from rare to frequent. A prefix of each set is indexed: a rare shingle by
   itself, frequent ones (by class, CLASSES) in combinations of k within small hash groups, as any two
   frequent shingles are shared by many documents but a combination is not. The prefix reaches so far
   that, whatever a linked document may lack, one whole combination is common to both (`signatures`).
4. Candidates are verified on their whole sets and grouped (`grouping`). No link between classes is lost, and no
   group of linked documents is written out in pairs.

Defined results: a null or empty text, or one without words, has an empty set, is linked with nothing
and is its own class; a text of one to four words is one shingle; repeated rows link with each other; a
null doc_id comes out as null and its class is the smallest id that is not null, if any; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm import grouping
from pathloom.llm import text as tx
from pathloom.llm.grouping import runs
from pathloom.llm.shared import even_keys, map_arrow, only, parts, written

U64 = np.uint64
WORDS, PERCENT = 5, 80
#: Documents that may hold a shingle of class 1 (indexed alone), 2 (in pairs); beyond: in triples.
CLASSES = (16, 256)
#: Shingles of a document, if all were frequent, in a hash group: 2 ** GROUP_BITS to twice as many.
GROUP_BITS = 3
#: Sets of fewer shingles index every shingle alone.
SMALL_BITS = 4
#: Shingles a task gathers before it deals them out.
FLUSH = 2_000_000
_KEY = (1 << 40) - 1


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashes of the distinct shingles of every text, by text."""
    words = tx.Words(buf, offsets)
    hashes = words.hashes(lower=True)
    docs, found = [], []
    for k in range(1, size + 1):
        window = tx.windows(hashes, k)
        doc = words.doc[: len(window)]
        ok = doc == words.doc[k - 1 :] if len(window) else np.zeros(0, dtype=bool)
        if k < size:  # the whole of a short text
            ok &= words.counts[doc] == k
        docs.append(doc[ok])
        found.append(window[ok])
    doc, h = np.concatenate(docs).astype(np.uint16), np.concatenate(found)
    order = np.argsort(h)
    order = order[np.argsort(doc[order], kind="stable")]
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new].astype(np.int64), h[new]


def _pack(rows: np.ndarray, counts: np.ndarray, keys: np.ndarray, extra: np.ndarray | None = None) -> bytes:
    """Row ids, how many keys each has, the keys in five bytes each, and two bytes more for each."""
    head = np.array([len(rows), len(keys)], dtype=np.int64)
    packed = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :5]
    return b"".join([head.tobytes(), rows.astype(np.int64).tobytes(), counts.astype(np.int32).tobytes(), packed.tobytes(), b"" if extra is None else extra.astype(np.uint16).tobytes()])


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, m = np.frombuffer(raw, np.int64, 2)
    rows = np.frombuffer(raw, np.int64, n, 16)
    counts = np.frombuffer(raw, np.int32, n, 16 + 8 * n)
    keys = np.zeros((m, 8), dtype=np.uint8)
    keys[:, :5] = np.frombuffer(raw, np.uint8, 5 * m, 16 + 12 * n).reshape(-1, 5)
    rest = 16 + 12 * n + 5 * m
    extra = np.frombuffer(raw, np.uint16, m, rest) if len(raw) > rest else np.empty(0, dtype=np.uint16)
    return rows, counts, keys.view(np.uint64).ravel(), extra


_BLOCKS = "kind int, part long, info struct<row: long, doc_id: long, n: long, a: long, b: long>, payload binary"
_INFO = pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _rows(kind: int, part: np.ndarray, info: pa.Array | None, payload: list[bytes] | None) -> pa.RecordBatch:
    n = len(part)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, dtype=np.int32)), pa.array(part, pa.int64()), pa.nulls(n, _INFO) if info is None else info, pa.nulls(n, pa.binary()) if payload is None else pa.array(payload, pa.binary())],
        ["kind", "part", "info", "payload"],
    )


def _deal(docs: DataFrame, keys: list[int]) -> DataFrame:
    """Kind 0: the shingles of a task's texts that go to a part; kind 1: what is to be known of each text."""
    n_parts = len(keys)
    places = np.array(keys, dtype=np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_row = TaskContext.get().partitionId() << 40
        seen, held, size = 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            row, h = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            part = ((h >> U64(48)) * U64(n_parts)) >> U64(16)
            order = np.argsort(part.astype(np.uint16), kind="stable")
            part, row, h = part[order], row[order], h[order]
            begin, length = runs(part)
            for b, n in zip(begin.tolist(), length.tolist(), strict=True):
                at, count = runs(row[b : b + n])
                payload = _pack(row[b : b + n][at], count, h[b : b + n] & U64(_KEY))
                yield _rows(0, places[part[b : b + 1].astype(np.int64)], None, [payload])

        for batch in batches:
            for i, j, buf, offsets in tx.groups(batch.column("text")):
                doc, h = shingle_sets(buf, offsets)
                bounds = np.searchsorted(doc, np.arange(j - i + 1))
                row = first_row + seen + np.arange(j - i)
                seen += j - i
                # The sum of two mixtures of its shingles stands for a whole set.
                sums = [np.add.reduceat(np.append(tx.mix(h ^ U64(salt)), U64(0)), bounds[:-1]) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)] if len(h) else [np.zeros(j - i, dtype=U64)] * 2
                n = np.diff(bounds)
                info = pa.StructArray.from_arrays([pa.array(row), batch.column("doc_id").slice(i, j - i), pa.array(n), *(pa.array(np.where(n > 0, s, 0).astype(U64).view(np.int64)) for s in sums)], ["row", "doc_id", "n", "a", "b"])
                yield _rows(1, places[(tx.mix(row.astype(U64)) % U64(n_parts)).astype(np.int64)], info, None)
                held.append((row[doc], h))
                size += len(h)
                if size >= FLUSH:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    return map_arrow(docs.select("doc_id", "text"), work, _BLOCKS)


def _count(blocks: DataFrame, keys: list[int]) -> DataFrame:
    """Kind 0 becomes kind 2: the shingles that a second document holds, for the home of each document."""
    n_parts = len(keys)
    places, number = np.array(keys, dtype=np.int64), {k: i for i, k in enumerate(keys)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            if (kind == 1).any():
                yield batch.filter(pa.array(kind == 1))
            rows = batch.filter(pa.array(kind == 0))
            for part, payload in zip(rows.column("part").to_pylist(), rows.column("payload"), strict=True):
                held.setdefault(part, []).append(_unpack(payload.as_py()))
        for part in list(held):
            blocks = held.pop(part)
            row = np.concatenate([np.repeat(b[0], b[1]) for b in blocks])
            key = np.concatenate([b[2] for b in blocks])
            del blocks
            order = np.argsort(key, kind="stable")
            begin, length = runs(key[order])
            df = np.repeat(length, length)
            shared = df > 1
            order, df = order[shared], df[shared]
            row, key = row[order], key[order] | U64(number[part] << 40)
            home = (tx.mix(row.astype(U64)) % U64(n_parts)).astype(np.int64)
            order = np.lexsort((key, row, home))
            home, row, key, df = home[order], row[order], key[order], df[order]
            at, count = runs(home)
            for b, n in zip(at.tolist(), count.tolist(), strict=True):
                first, size = runs(row[b : b + n])
                payload = _pack(row[b : b + n][first], size, key[b : b + n] & U64(_KEY), np.minimum(df[b : b + n], 65535))
                yield _rows(2, places[home[b : b + 1]], None, [np.int64(number[part]).tobytes() + payload])

    return map_arrow(blocks, work, _BLOCKS)


def _gather(blocks: DataFrame) -> DataFrame:
    """A row per document; shingles and df (packed) where enough of them are shared for a link."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        infos, row, key, df = [], [], [], []
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            infos.append(pa.RecordBatch.from_struct_array(batch.filter(pa.array(kind == 1)).column("info")))
            for payload in batch.filter(pa.array(kind == 2)).column("payload"):
                raw = payload.as_py()
                rows, counts, keys, dfs = _unpack(raw[8:])
                row.append(np.repeat(rows, counts))
                key.append(keys | U64(int(np.frombuffer(raw, np.int64, 1)[0]) << 40))
                df.append(dfs)
        if not infos:
            return
        info = pa.Table.from_batches(infos).combine_chunks()
        if not info.num_rows:
            return
        ids = info.column("row").to_numpy()
        n = info.column("n").to_numpy()
        key = np.concatenate(key) if key else np.empty(0, dtype=U64)
        df = np.concatenate(df) if df else np.empty(0, dtype=np.uint16)
        row = np.concatenate(row) if row else np.empty(0, dtype=np.int64)
        order = np.lexsort((key, row))
        row, key, df = row[order], key[order], df[order]
        lo, hi = np.searchsorted(row, ids), np.searchsorted(row, ids, side="right")
        enough = (n > 0) & (100 * (hi - lo) >= PERCENT * n)
        cells = [(key[a:b].tobytes(), df[a:b].tobytes()) if ok else (None, None) for a, b, ok in zip(lo.tolist(), hi.tolist(), enough.tolist(), strict=True)]
        for i in range(0, len(cells), 500):
            part = info.slice(i, 500).combine_chunks().to_batches()[0]
            packed = [pa.array([c[k] for c in cells[i : i + 500]], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*part.columns, *packed], [*part.schema.names, "shingles", "df"])

    return map_arrow(blocks, work, "row long, doc_id long, n long, a long, b long, shingles binary, df binary")


def signatures(key: np.ndarray, df: np.ndarray, n: int) -> np.ndarray:
    """Hashes of what is indexed of a set of n shingles, of which `key` are held by `df` > 1 documents.

    Of a set of n at most `slack` shingles are missing in one it links with. In rare-to-frequent order,
    shingles are taken until the groups hold more than `slack` beyond the k - 1 each may hold without
    having a combination; then some group keeps k common shingles. Groups depend on the size class of
    the smaller set, so a set near the lower end of its class is indexed for the class below, too.
    """
    slack = n - -(-PERCENT * n // 100)
    order = np.lexsort((key, df))
    key, df = key[order], df[order]
    bits = n.bit_length() - 1
    spaces = [bits, bits - 1] if PERCENT * n <= 100 << bits else [bits]
    out = []
    for space in spaces:
        need = slack + 1 - (n - len(key))
        small = space < SMALL_BITS
        kinds = np.ones(len(key), dtype=np.int64) if small else 1 + np.searchsorted(CLASSES, df, side="left")
        group = (tx.mix(key) >> U64(20)) % U64(1 << max(0, space - GROUP_BITS)) + (kinds.astype(U64) << U64(40))
        group[kinds == 1] = key[kinds == 1] | U64(1 << 63)
        _, number = np.unique(group, return_inverse=True)
        # The place of each shingle in its group, in order; it counts once k - 1 stand before it.
        by = np.argsort(number, kind="stable")
        first, length = runs(number[by])
        place = np.empty(len(key), dtype=np.int64)
        place[by] = np.arange(len(key)) - np.repeat(first, length)
        total = np.cumsum(place >= kinds - 1)
        end = min(int(np.searchsorted(total, need)) + 1, len(key))
        single = kinds[:end] == 1
        out.append(tx.mix(key[:end][single]))
        many = np.flatnonzero(~single)
        if len(many):
            many = many[np.argsort(number[many], kind="stable")]
            first, length = runs(number[many])
            sigs = []
            for b, m in zip(first.tolist(), length.tolist(), strict=True):
                k = int(kinds[many[b]])
                if m >= k:
                    members = np.sort(key[many[b : b + m]])
                    sigs.append(tx.windows(members[np.array(list(combinations(range(m), k)))].ravel(), k)[::k])
            if sigs:
                out.append(tx.mix(np.concatenate(sigs) ^ U64(0xA5A5 + space)))
    return np.unique(np.concatenate(out))


def _index(sets: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, n = batch.column("row")[i].as_py(), batch.column("n")[i].as_py()
                key, df = np.frombuffer(batch.column("shingles")[i].as_py(), U64), np.frombuffer(batch.column("df")[i].as_py(), np.uint16)
                sig = signatures(key, df, n).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(np.full(len(sig), row)), pa.array(np.full(len(sig), n))], ["sig", "row", "n"])

    return map_arrow(sets.select("row", "n", "shingles", "df"), work, "sig long, row long, n long")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (and row, a number of the row) for every row of `docs`."""
    spark = docs.sparkSession
    keys = even_keys(spark, parts(spark))
    n = len(keys)
    dealt = _deal(docs, keys).repartition(n, "part")
    rows = written(_gather(_count(dealt, keys).repartition(n, "part")), "shingles")

    able = rows.where(F.col("shingles").isNotNull())
    member = grouping.equal_sets(able)
    reps = able.select("row", "n", "shingles", "df").join(member.where("row <> rep").select("row"), "row", "left_anti")
    index = written(_index(reps), "index")
    label = grouping.classes(index, lambda candidates: only(able.select("row", "n", "shingles"), candidates, "row"), PERCENT, 8)
    return grouping.placed_rows(rows.select("row", "doc_id", "n"), member, label).withColumnRenamed("n", "n_shingles")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, the one of the smallest id.

    Rows without an id stay; rows of one id count as one document, of which one row stays.
    """
    found = classes(docs.select("doc_id", "text"))
    lost = written(found.where("doc_id <> component_id").select("doc_id").distinct(), "near-copies")
    kept = docs.join(lost, "doc_id", "left_anti").select(*docs.columns)
    twice = written(found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id"), "repeated-ids")
    if twice.isEmpty():
        return kept
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).union(kept.join(twice, "doc_id").select(*docs.columns).dropDuplicates(["doc_id"]))

"""Packing of tokenised documents into as few sequences as possible.

A piece longer than nothing but at most CAPACITY tokens goes whole into one sequence. How many pieces
have each length is all the packing depends on: a table of at most CAPACITY counts, however many
documents there are. `plan` packs that table by bin completion; each chosen filling is used as often as
the counts allow, so a plan has few rows. Pieces then find their place by their rank among the pieces
of their length: a rank within the task that made them, plus the sum of the counts of earlier tasks.

Defined results: a null or empty text is one piece of one token, the end; repeated rows are packed each
time; a text of any length is cut into pieces of CAPACITY, the first one shorter; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pathloom.llm import text as tx
from pathloom.llm.bpe import Encoder
from pathloom.llm.shared import map_arrow, written

CAPACITY = 1024
END_ID = 2
#: Nodes the search opens before it settles for the best solution so far.
NODES = 1_000
#: Fillings tried at a node, those of least waste first, and the sets of pieces looked at to find them.
BREADTH, SETS = 6, 400
#: Sets of more pieces are not compared with each other, which takes time that grows steeply with them.
COMPARED = 5


def cut(n: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of every piece of documents of n tokens."""
    count = -(-n // capacity)
    doc = np.repeat(np.arange(len(n)), count)
    piece = tx.spans(np.zeros(len(n), dtype=np.int64), count)
    short = n - (count - 1) * capacity
    start = np.where(piece == 0, 0, short[doc] + (piece - 1) * capacity)
    return doc, piece, start, np.where(piece == 0, short[doc], capacity)


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece, and task, rank: its place among the task's pieces of its length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            encoder = encoder or Encoder(vocabulary)
            for i, j, buf, offsets in tx.groups(batch.column("text"), 2 * tx.CHUNK_BYTES):
                ids, sizes = encoder.encode(buf, offsets)
                ends = np.cumsum(sizes + 1)
                whole = np.full(len(ids) + len(sizes), end_id, dtype="<u4")
                keep = np.ones(len(whole), dtype=bool)
                keep[ends - 1] = False
                whole[keep] = ids
                doc, piece, start, length = cut(sizes + 1, capacity)
                at = (ends - sizes - 1)[doc] + start
                raw = memoryview(whole.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                run = length[order]
                first = np.flatnonzero(np.diff(run, prepend=-1))
                rank = np.empty(len(run), dtype=np.int64)
                rank[order] = np.arange(len(run)) - np.repeat(first, np.diff(np.append(first, len(run)))) + seen[run]
                seen += np.bincount(length, minlength=capacity + 1)
                ids_of = batch.column("doc_id").slice(i, j - i).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays(
                    [ids_of, pa.array(piece.astype(np.int32)), *map(pa.array, (start, length)), pa.array(crc, pa.int64()), pa.array(np.full(len(rank), task, dtype=np.int32)), pa.array(rank)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"],
                )

    return map_arrow(docs.select("doc_id", "text"), work, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long")


class _Search:
    """Bin completion over counts of sizes."""

    def __init__(self, counts: Sequence[int], capacity: int):
        self.counts = np.array(counts, dtype=np.int64)
        self.capacity = capacity
        self.total = int(self.counts @ np.arange(len(self.counts)))
        self.least = -(-self.total // capacity)

    def fillings(self, counts: np.ndarray, largest: int) -> list[tuple[int, ...]]:
        """Undominated sets of pieces that fit beside the largest, those of least waste first; none leaves room for a further piece."""
        room = self.capacity - largest
        free = counts.copy()
        free[largest] -= 1
        sizes = [int(s) for s in np.flatnonzero(free[: room + 1]) if s]
        if not sizes:
            return [()]
        if sizes[-1] == room:  # one piece that leaves no waste dominates every other set
            return [(room,)]
        free = {s: int(free[s]) for s in sizes}
        found: set[tuple[int, ...]] = set()

        def complete(chosen: tuple[int, ...], r: int) -> None:
            """Fills the room left, as many pieces of the largest size that fits at a time."""
            i = bisect_right(sizes, r)
            while i:
                s = sizes[i - 1]
                n = min(free[s] - chosen.count(s), r // s)
                chosen += (s,) * n
                r -= n * s
                i = min(i - 1, bisect_right(sizes, r))
            if room - r >= sizes[-1]:  # else one larger piece could stand for the set
                found.add(tuple(sorted(chosen, reverse=True)))

        def extend(chosen: tuple[int, ...], r: int, limit: int, budget: int) -> int:
            """Ways on from a set, each with its share of the budget, whose rest is returned; pieces come in falling order."""
            ways: list[int] = []
            i = bisect_right(sizes, min(r, limit))
            while i and len(ways) < BREADTH:
                i -= 1
                if free[sizes[i]] > chosen.count(sizes[i]):
                    ways.append(sizes[i])
            budget -= 1
            if len(ways) < 2 or budget < len(ways):
                complete(chosen, r)
                return budget
            for k, s in enumerate(ways):
                share = budget // (len(ways) - k)
                budget += extend((*chosen, s), r - s, s, share) - share
            return budget

        extend((), room, room, SETS)
        ranked = sorted(found, key=lambda f: (room - sum(f), len(f), f))
        kept: list[tuple[int, ...]] = []
        for f in ranked:
            if len(kept) == BREADTH:
                break
            if len(f) > COMPARED or not any(_dominates(k, f) for k in kept):
                kept.append(f)
        return kept

    def solve(self) -> list[tuple[tuple[int, ...], int]]:
        """Fillings (with their largest piece) and how many sequences use each."""
        best: list[tuple[tuple[int, ...], int]] | None = None
        bins_best = None
        path: list[tuple[tuple[int, ...], int]] = []
        stack: list[tuple[np.ndarray, Iterator[tuple[int, ...]], int, int]] = []
        counts, bins, waste, nodes = self.counts.copy(), 0, 0, 0

        def opened(counts: np.ndarray) -> Iterator[tuple[int, ...]]:
            largest = int(np.flatnonzero(counts)[-1])
            return iter([(largest, *f) for f in self.fillings(counts, largest)])

        if self.total:
            stack.append((counts, opened(counts), bins, waste))
        while stack:
            counts, ways, bins, waste = stack[-1]
            filling = next(ways, None)
            del path[len(stack) - 1 :]
            if filling is None or (bins_best is not None and (nodes > NODES or bins_best == self.least)):
                stack.pop()
                continue
            nodes += 1
            sizes, uses = np.unique(filling, return_counts=True)
            times = int((counts[sizes] // uses).min())
            left = counts.copy()
            left[sizes] -= times * uses
            now = bins + times
            lost = waste + times * (self.capacity - sum(filling))
            # With so much waste no solution below the incumbent is left.
            if bins_best is not None and lost > (bins_best - 1) * self.capacity - self.total:
                continue
            path.append((filling, times))
            if not left.any():
                if bins_best is None or now < bins_best:
                    best, bins_best = list(path), now
                continue
            stack.append((left, opened(left), now, lost))
        return best or []


def _dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the pieces of b can be put into parts that fit into the pieces of a, one part a piece."""
    if len(a) > len(b) or sum(a) < sum(b):
        return False

    def place(i: int, room: tuple[int, ...]) -> bool:
        if i == len(b):
            return True
        return any(r >= b[i] and place(i + 1, (*room[:k], r - b[i], *room[k + 1 :])) for k, r in enumerate(room))

    return place(0, a)


def plan(counts: Sequence[int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Fillings and the number of sequences of each, for counts[s] pieces of size s (s up to the capacity)."""
    return _Search(counts, capacity).solve()


def places(fillings: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Rows by (length, first rank): the pieces from that rank on go m to a sequence, from sequence `base` at `offset`."""
    used = np.zeros(capacity + 1, dtype=np.int64)
    rows, base = [], 0
    for filling, times in fillings:
        at = 0
        for size in sorted(set(filling), reverse=True):
            m = filling.count(size)
            rows.append((size, int(used[size]), m, base, at))
            used[size] += m * times
            at += m * size
        base += times
    rows.sort()
    return {k: np.array([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(("length", "rank", "m", "base", "offset"))}


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document."""
    rows = written(pieces(docs, capacity, end_id, vocabulary), "pieces")
    per_task = rows.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    per_task = written(per_task.select("task", "length", "n", F.coalesce(before, F.lit(0)).alias("before")), "piece-ranks")
    counts = [0] * (capacity + 1)
    for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    where = places(plan(counts, capacity), capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (where["length"] << 44) + where["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            k = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            step = rank - where["rank"][k]
            sequence = where["base"][k] + step // where["m"][k]
            offset = where["offset"][k] + step % where["m"][k] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    ranked = rows.join(per_task.select("task", "length", "before"), ["task", "length"]).select(*columns, (F.col("rank") + F.col("before")).alias("rank"))
    return map_arrow(ranked, work, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

"""Grouping of spelling variants: every word points to the frequent word one letter away.

1. Words are counted: a task counts those of its texts, Spark adds the counts up.
2. Words are dealt out so that words one error apart meet: of two such words either the first half of the
   one begins the other, or its second half ends it. So every word goes to the parts of its own halves, as a
   query, and to those of the halves that a word one letter shorter or longer would have. A part of more
   than BLOCK words, as where a third of the vocabulary shares one half, is cut into blocks, and each block
   of queries meets each block of words.
3. In a part an FM-index over its delimited vocabulary is searched for all queries at once: the half that
   stands first in reading order must match exactly, the other half with one error (`fm_index`).
4. A word's form is its most frequent near word, if that is RATIO times as frequent; pointers from word to
   form are doubled until they reach the root.

To exercise the search on texts without real slips, the query may plant some: a run's letter is deleted where
a checksum of document and run says so (`plant`).

Defined results: a null or empty text has no words; a null doc_id counts as empty text in the checksum; repeated
rows count each; ties of frequency go to the smallest word in code-point order; an empty table gives an empty
result; further columns are ignored; texts and words may be of any length. Words are told apart within
a group of texts by 64-bit hashes, and by themselves beyond.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm import crc
from pathloom.llm import text as tx
from pathloom.llm.fm_index import Both
from pathloom.llm.shared import map_arrow, ship, written

#: Code points and occurrences a word must have, and how much more frequent its form must be.
LEAST_LETTERS, LEAST_COUNT, RATIO = 5, 3, 2
#: One run in so many loses a letter where slips are planted.
PLANT = 97
#: Words of a part, about, and words a task counts before it hands them on.
BLOCK, HELD = 20_000, 400_000
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = True


def letters(buf: np.ndarray) -> np.ndarray:
    """Which bytes are parts of A-Z, a-z or U+00C0 to U+00FF, which UTF-8 writes as 0xC3 and one byte more."""
    inside = _LETTER[buf]
    inside[1:] |= buf[:-1] == 0xC3
    return inside


def count_words(docs: DataFrame, plant: int | None = None) -> DataFrame:
    """word, n of all words of enough letters; with `plant`, runs whose checksum it divides lose a letter."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            words = pa.array(list(counts.keys()), pa.binary()).cast(pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, j, buf, offsets in tx.groups(batch.column("text")):
                low = tx.LOWER[buf]
                runs = tx.Words(low, offsets, letters(buf))
                whole = np.zeros(len(buf) + 1, dtype=np.int64)
                np.cumsum((buf & 0xC0) != 0x80, out=whole[1:])
                size = whole[runs.ends] - whole[runs.starts]
                kept = size >= LEAST_LETTERS
                if plant:
                    prefix = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in ids[i:j]], dtype=np.uint32)
                    sums = crc.joined(prefix[runs.doc], crc.segment_crcs(low, runs.starts, runs.ends), runs.ends - runs.starts)
                    hit = sums % plant == 0
                    for r in np.flatnonzero(hit & (size > LEAST_LETTERS)).tolist():
                        run = low[runs.starts[r] : runs.ends[r]].tobytes().decode()
                        at = int(sums[r]) % len(run)
                        word = (run[:at] + run[at + 1 :]).encode()
                        counts[word] = counts.get(word, 0) + 1
                    kept &= ~hit
                starts, ends = runs.starts[kept], runs.ends[kept]
                hashes = tx.segment_hashes(low, starts, ends)
                _, first, n = np.unique(hashes, return_index=True, return_counts=True)
                data = low.tobytes()
                for s, e, c in zip(starts[first].tolist(), ends[first].tolist(), n.tolist(), strict=True):
                    word = data[s:e]
                    counts[word] = counts.get(word, 0) + c
                if len(counts) >= HELD:
                    yield flush()
        if counts:
            yield flush()

    return map_arrow(docs.select("doc_id", "text"), work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _half(length: str, right: bool) -> str:
    return f"({length} - {length} div 2)" if right else f"({length} div 2)"


def near_pairs(words: DataFrame, least: int = LEAST_LETTERS, block: int = BLOCK) -> DataFrame:
    """word, n, near, near_n of all pairs of `words` (word, n; distinct) that differ by one letter, in both directions.

    Words of fewer than `least` letters, at least two, take no part.
    """
    ship(words.sparkSession)
    words = words.select("word", F.col("n").alias("n"), F.char_length("word").alias("size")).where(F.col("size") >= max(2, least))
    total = words.count()
    parts = max(1, -(-4 * total // block))
    sides = []
    for right in (False, True):
        text = "reverse(word)" if right else "word"
        sizes = [f"greatest({least}, size{d})" for d in ("", " - 1", " + 1")]
        part = [f"pmod(xxhash64(substring({text}, 1, {_half(s, right)})), {parts})" for s in sizes]
        sides.append(words.select("word", "n", F.lit(right).alias("right"), F.expr(part[0]).alias("own"), F.expr(f"explode(array_distinct(array({', '.join(part)})))").alias("part")))
    placed = written(sides[0].union(sides[1]).select("word", "n", "right", "part", (F.col("own") == F.col("part")).alias("asks")), "spelling-parts")
    cuts = placed.groupBy("right", "part").agg(F.ceil(F.count(F.lit(1)) / (4 * block)).cast("int").alias("cuts"))
    placed = placed.join(cuts, ["right", "part"])
    mine = F.pmod(F.xxhash64("word", F.lit(1)), F.col("cuts")).cast("int")
    all_cuts = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    held = placed.select("word", "n", "right", "part", mine.alias("i"), all_cuts.alias("j"), F.lit(False).alias("asks"))
    asks = placed.where("asks").select("word", "n", "right", "part", all_cuts.alias("i"), mine.alias("j"), F.lit(True).alias("asks"))

    def work(table: pa.Table) -> pa.Table:
        is_query = np.array(table.column("asks").to_pylist(), dtype=bool)
        text, n = table.column("word").to_pylist(), table.column("n").to_pylist()
        here = {w: c for w, c, q in zip(text, n, is_query.tolist(), strict=True) if not q}
        queries = np.flatnonzero(is_query).tolist()
        pairs: list[tuple[int, str]] = []
        if here and queries:
            index = Both(here)
            search = index.right_exact if table.column("right")[0].as_py() else index.left_exact
            pairs = search([text[i] for i in queries])
        at = [queries[q] for q, _ in pairs]
        columns = [pa.array([text[i] for i in at], pa.string()), pa.array([n[i] for i in at], pa.int64()), pa.array([w for _, w in pairs], pa.string()), pa.array([here[w] for _, w in pairs], pa.int64())]
        return pa.table(columns, ["word", "n", "near", "near_n"])

    return held.union(asks).groupBy("right", "part", "i", "j").applyInArrow(work, "word string, n long, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that forms lead to. A form is RATIO times as frequent, so no way is longer than the bits of a count, and doubling ends soon."""
    to = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = to.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(to.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        to = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return to


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `words` (word, n)."""
    words = written(words.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    near = near.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))
    found = words.join(near, "word", "left")
    enough = F.col("form_n") >= RATIO * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"))
    found = written(found, "forms")
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def vocabulary(docs: DataFrame, plant: int | None = None) -> DataFrame:
    """The words that occur often enough to be looked at."""
    return count_words(docs, plant).where(F.col("n") >= LEAST_COUNT)

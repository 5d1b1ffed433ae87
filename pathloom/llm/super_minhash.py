"""Near duplicates by SuperMinHash signatures, banded, verified on whole sets and grouped.

A document's set holds the hashes of its distinct three-word shingles. Every element of a set draws a random
permutation of the SLOTS places of the signature, lazily, and a random fraction for each step: at step j it
offers j plus the fraction to the j-th place of its permutation; a place keeps the smallest offer. Since the
ranks an element gives to the places are a permutation, offers are spread evenly and the estimate has lower variance
than with independent hashes. A set stops early: once every place has an offer below j + 1, later steps cannot change it.

Bands of ROWS places are hashed; documents that share a band are candidates. A pair at the threshold of
0.85 is missed with a probability of (1 - 0.85^5)^24, below 1e-6, by independent places. Documents of equal
sets (by 128 bits) are one. Sets are not kept; those of candidates are made again from their texts. `grouping`
verifies them whole, with 40 bits a shingle, and groups by union-find; no group is written out in pairs and
no bucket is cut.

Defined results: a null or empty text, or one without words, has an empty set, is linked with nothing and is
its own class; a text of one or two words is one shingle; repeated rows link with each other; a null doc_id comes
out as null and its class is the smallest id that is not null, if any; an empty table gives an empty result;
further columns are ignored; texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm import grouping
from pathloom.llm import text as tx
from pathloom.llm.grouping import packed
from pathloom.llm.ngram_join import shingle_sets
from pathloom.llm.shared import map_arrow, only, written

U64 = np.uint64
WORDS, PERCENT = 3, 85
BANDS, ROWS = 24, 5
SLOTS = BANDS * ROWS
WIDTH = 5
#: Elements whose permutations are held at a time.
HELD = 200_000


def signatures(number: np.ndarray, elements: np.ndarray, n_sets: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of every set, `slots` integers each: step << 32 | fraction. `number` tells the set of an element, in order."""
    empty = np.uint64((1 << 64) - 1)
    out = np.full(n_sets * slots, empty, dtype=U64)
    active, seeds = number, tx.mix(elements.astype(U64))
    permutation = None
    for j in range(slots):
        draw = tx.mix(seeds + U64(0x9E3779B97F4A7C15 * (j + 1) & (2**64 - 1)))
        k = j + ((draw & U64(0xFFFFFFFF)) * U64(slots - j) >> U64(32)).astype(np.int64)
        if permutation is None:
            place = k
        else:
            at = np.arange(len(active)) * slots
            place = permutation[at + k].astype(np.int64)
            permutation[at + k] = permutation[at + j]
        np.minimum.at(out, active * slots + place, (draw >> U64(32)) | U64(j << 32))
        unfilled = (out.reshape(n_sets, slots) == empty).any(axis=1)
        going = unfilled[active]
        if not going.any():
            break
        if permutation is None:  # of sets that go on, place j of the permutation now stands where k was
            permutation = np.tile(np.arange(slots, dtype=np.uint16), int(going.sum()))
            permutation[np.arange(int(going.sum())) * slots + k[going]] = 0
        elif not going.all():
            permutation = permutation.reshape(-1, slots)[going].ravel()
        active, seeds = active[going], seeds[going]
    return out.reshape(n_sets, slots)


def bands(signature: np.ndarray) -> np.ndarray:
    """A hash of every band of every signature, other ones for other bands."""
    n = len(signature)
    out = np.full((n, BANDS), WORDS, dtype=U64) + np.arange(BANDS, dtype=U64)
    for r in range(ROWS):
        out = tx.mix(out * U64(0x9E3779B97F4A7C15) + signature.reshape(n, BANDS, ROWS)[:, :, r])
    return out


def _prints(h: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """Two numbers that stand for every whole set: sums of mixtures of its shingles."""
    return [pa.array(tx.per_set_sum(tx.mix(h ^ U64(salt)), bounds).view(np.int64)) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]


def sketch(docs: DataFrame) -> DataFrame:
    """row, doc_id, n, a, b (fingerprints of the set) and bands of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, j, buf, offsets in tx.groups(batch.column("text")):
                doc, h = shingle_sets(buf, offsets, WORDS)
                bounds = np.searchsorted(doc, np.arange(j - i + 1))
                band = np.zeros((j - i, BANDS), dtype=U64)
                cut = np.searchsorted(bounds, np.arange(HELD, len(h), HELD)).tolist()  # sets of about HELD elements together
                for a, b in zip([0, *cut], [*cut, j - i], strict=True):
                    if a < b:
                        s, e = bounds[a], bounds[b]
                        band[a:b] = bands(signatures(doc[s:e] - a, h[s:e], b - a))
                offered = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * (j - i) + 1, BANDS), pa.int32()), pa.array(band.view(np.int64).ravel()))
                columns = [pa.array(row + np.arange(j - i)), batch.column("doc_id").slice(i, j - i), pa.array(np.diff(bounds)), *_prints(h, bounds), offered]
                row += j - i
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n", "a", "b", "bands"])

    return map_arrow(docs.select("doc_id", "text"), work, "row long, doc_id long, n long, a long, b long, bands array<long>")


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """row, n, shingles (WIDTH bytes each) of the `wanted` rows (row, doc_id, n, a, b), made anew from their texts.

    A text is known by the fingerprints of its set, so it matters neither how rows are numbered nor whether ids repeat.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in tx.groups(batch.column("text")):
                doc, h = shingle_sets(buf, offsets, WORDS)
                bounds = np.searchsorted(doc, np.arange(j - i + 1))
                cells = [packed(h[s:e], WIDTH) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(bounds)), *_prints(h, bounds), pa.array(cells, pa.binary())], ["n", "a", "b", "shingles"])

    texts = only(docs.select("doc_id", "text"), written(wanted.select("doc_id").distinct(), "wanted"), "doc_id")
    found = map_arrow(texts.select("text"), work, "n long, a long, b long, shingles binary")
    return found.join(wanted.select("row", "n", "a", "b"), ["n", "a", "b"]).select("row", "n", "shingles").dropDuplicates(["row"])


def classes(docs: DataFrame) -> DataFrame:
    """row (a number of the row), doc_id, n (size of its set) and component_id of every row of `docs`."""
    rows = written(sketch(docs), "sketches")
    able = rows.where("n > 0")
    member = grouping.equal_sets(able)
    copies = member.where("row <> rep").select("row")
    # A set of so few elements that one more is too much links with equal ones alone.
    alone = f"100 * n < {PERCENT} * (n + 1)"
    reps = written(able.where(f"NOT {alone}").select("row", "n", "bands").join(copies, "row", "left_anti"), "distinct-sets")
    index = reps.select(F.explode("bands").alias("sig"), "row", "n")

    def sets_of(candidates: DataFrame) -> DataFrame:
        wanted = only(able.select("row", "doc_id", "n", "a", "b"), candidates, "row")
        return whole_sets(docs, written(wanted, "wanted-rows"))

    label = grouping.classes(index, sets_of, PERCENT, WIDTH)
    return grouping.placed_rows(rows.select("row", "doc_id", "n"), member, label)


def mark_copies(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one document of each class stays, that of the smallest id."""
    return classes(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

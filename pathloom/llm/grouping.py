"""Classes of similar sets, from an index of signatures that similar sets share.

Given rows (sig, row, n) and the sets themselves, `classes` finds the connected components of all links, that
is of all rows that share a signature and whose Jaccard similarity, verified on whole sets, is high enough.

1. Signatures with the same rows are one: they are told by their smallest row, their number of rows and the
   exclusive or of their rows' hashes, and the smallest of them stands for all.
2. Each row is compared with the one it shares most signatures with among the smallest rows of each signature, so
   that a group of copies costs one comparison a row. While many pairs are left, each row outside the largest class of a
   signature is compared with a few more members of it.
3. Of what is left, rows that hang together by signatures form clusters; small ones share a block, large ones
   are cut, and any two blocks that share a signature meet in a task, which verifies every pair that
   shares a signature, may link by its sizes and is not yet connected. No pair leaves a task unless it connects.

No link between classes is lost, no group is written out in pairs, and no join on a signature or on a compared
row is without salt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm import text as tx
from pathloom.llm.components import connect
from pathloom.llm.shared import map_arrow, salted_join, written

U64 = np.uint64
#: Rounds in which rows are compared with TRIES members of larger classes, before all pairs left are.
ROUNDS, TRIES = 3, 4
#: Elements and rows of a block, where all pairs left are verified.
BLOCK_ELEMENTS, BLOCK_ROWS = 400_000, 1000


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    first = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.empty(0, dtype=np.int64)
    return first, np.diff(np.append(first, len(sorted_values)))


def packed(values: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of every number."""
    return np.ascontiguousarray(values.astype(U64)).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view(U64).ravel()


@dataclass(frozen=True)
class Sets:
    """Rows (row, n, shingles): n is the size of the whole set, `shingles` its elements in `width` bytes each, but for
    elements that no other set has, which may be left out. Two sets link at `percent` hundredths of similarity."""

    rows: DataFrame
    percent: int
    width: int = 8

    @property
    def may_link(self) -> str:
        return f"100 * least(n, m) >= {self.percent} * greatest(n, m)"

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (x, y) that link."""
        percent, width = self.percent, self.width

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                nx, ny = batch.column("nx").to_numpy(), batch.column("ny").to_numpy()
                ok = np.zeros(batch.num_rows, dtype=bool)
                for i in range(batch.num_rows):
                    both = np.concatenate([unpacked(batch.column(c)[i].as_py(), width) for c in ("sx", "sy")])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    ok[i] = 100 * common >= percent * (nx[i] + ny[i] - common)
                yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y")], ["x", "y"]).filter(pa.array(ok))

        pairs = written(pairs.select("x", "y"), "pairs")
        asked = pairs.groupBy("y").agg(F.count(F.lit(1)).alias("c"))
        x = self.rows.select(F.col("row").alias("x"), F.col("n").alias("nx"), F.col("shingles").alias("sx"))
        y = self.rows.select(F.col("row").alias("y"), F.col("n").alias("ny"), F.col("shingles").alias("sy"))
        y = written(y.join(asked, "y"), "asked-sets")
        return map_arrow(salted_join(pairs.join(x, "x"), y, ["y"], "x"), work, "x long, y long")


def _distinct_signatures(index: DataFrame) -> DataFrame:
    """sig, row, n, hub, w of signatures that two rows or more have, one for all of the same rows; w tells how many it stands for."""
    shared = index.groupBy("sig").agg(F.count(F.lit(1)).alias("c"), F.min("row").alias("hub"), F.bit_xor(F.xxhash64("row")).alias("rows")).where("c > 1")
    kept = shared.groupBy("hub", "c", "rows").agg(F.min("sig").alias("sig"), F.count(F.lit(1)).alias("w"))
    return salted_join(index, written(kept.select("sig", "hub", "w", "c"), "signatures"), ["sig"], "row")


def _stars(index: DataFrame, candidates: DataFrame, sets: Sets) -> DataFrame:
    """For each row the one it shares most signatures with, among the smallest rows of its signatures."""
    stars = written(index.where("row <> hub").groupBy("row", "n", "hub").agg(F.sum("w").alias("w")), "stars")
    hubs = stars.groupBy("hub").agg(F.count(F.lit(1)).alias("c")).join(candidates.select(F.col("row").alias("hub"), F.col("n").alias("m")), "hub")
    stars = salted_join(stars, written(hubs, "hubs"), ["hub"], "row").where(sets.may_link)
    return stars.groupBy(F.col("row").alias("x")).agg(F.max(F.struct("w", (-F.col("hub")).alias("y"))).alias("best")).select("x", (-F.col("best.y")).alias("y"))


def _open(index: DataFrame, label: DataFrame) -> tuple[DataFrame, int]:
    """The rows of signatures whose rows are not all connected, with their labels, and how many pairs they hold at most."""
    placed = index.select("sig", "row", "n").join(label.withColumnRenamed("vertex", "row"), "row", "left")
    placed = written(placed.select("sig", "row", "n", F.coalesce("label", "row").alias("label")), "placed-index")
    sizes = placed.groupBy("sig", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("sig")
    sizes = sizes.agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.max(F.struct("c", "label")).alias("largest"))
    mixed = sizes.where("squares < c * c").select("sig", "c", F.col("largest.label").alias("largest"), ((F.col("c") * F.col("c") - F.col("squares")) / 2).alias("pairs"))
    mixed = written(mixed, "open-signatures")
    pairs = mixed.agg(F.sum("pairs")).first()[0] or 0
    return written(salted_join(placed, mixed.drop("pairs"), ["sig"], "row"), "open-index"), int(pairs)


def _towards_largest(open_index: DataFrame, sets: Sets, number: int) -> DataFrame:
    """For each row outside the largest class of a signature a few members of that class, others every round."""
    draw = F.xxhash64("row", "sig", F.lit(number))
    of_largest = F.when(F.col("label") == F.col("largest"), F.struct(draw.alias("h"), F.col("row").alias("y"), F.col("n").alias("m")))
    member = open_index.groupBy("sig").agg(F.min(of_largest).alias("p"), F.count_if(F.col("label") != F.col("largest")).alias("c"))
    outside = open_index.where("label <> largest").select("sig", "row", "n")
    pairs = salted_join(outside, written(member, "members"), ["sig"], "row")
    pairs = pairs.select(F.col("row").alias("x"), "n", F.col("p.y").alias("y"), F.col("p.m").alias("m")).where(sets.may_link)
    counted = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"))
    some = counted.groupBy("x").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("c"), F.xxhash64("y", F.lit(number)).alias("h"), "y"))), 1, TRIES).alias("some"))
    return some.select("x", F.explode("some.y").alias("y"))


def _met(rows: DataFrame) -> DataFrame:
    """Every row once for each two blocks (lo, hi) in which it meets others: its own, and each that shares a signature with its own."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # each signature of a block once a batch
            size = np.diff(batch.column("sigs").offsets.to_numpy())
            number = np.repeat(np.arange(batch.num_rows), size)
            columns = [batch.column(c).to_numpy()[number] for c in ("cluster", "i")]
            sig = batch.column("sigs").flatten().to_numpy()
            order = np.lexsort((sig, columns[1], columns[0]))
            cells = [x[order] for x in (*columns, sig)]
            new = np.ones(len(sig), dtype=bool)
            if len(sig):
                new[1:] = np.any([x[1:] != x[:-1] for x in cells], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(x[new]) for x in cells], ["cluster", "i", "sig"])

    touched = map_arrow(rows.where("cuts > 1").select("cluster", "i", "sigs"), held, "cluster long, i int, sig long")
    # Many signatures touch the same blocks.
    blocks = touched.groupBy("cluster", "sig").agg(F.sort_array(F.collect_set("i")).alias("b")).where("size(b) > 1").select("cluster", "b").distinct()
    two = blocks.select("cluster", F.expr("explode(flatten(transform(b, x -> transform(filter(b, y -> y > x), y -> struct(x AS lo, y AS hi)))))").alias("t"))
    two = written(two.select("cluster", "t.lo", "t.hi").distinct(), "block-pairs")
    sides = two.select("cluster", F.col("lo").alias("i"), "lo", "hi").union(two.select("cluster", F.col("hi").alias("i"), "lo", "hi"))
    met = rows.join(sides, ["cluster", "i"]).select("cluster", "lo", "hi", "i", "row", "n", "label", "sigs")
    return met.union(rows.select("cluster", F.col("i").alias("lo"), F.col("i").alias("hi"), "i", "row", "n", "label", "sigs"))


def _resolved(open_index: DataFrame, sets: Sets) -> DataFrame:
    """Links that connect what is left: every pair of a signature's rows is verified unless they are connected by then."""
    percent, width = sets.percent, sets.width
    least = written(open_index.groupBy("sig").agg(F.min("row").alias("y"), F.count(F.lit(1)).alias("c")), "least")
    edges = salted_join(open_index.select("sig", "row"), least, ["sig"], "row").where("row <> y").select(F.col("row").alias("x"), "y").distinct()
    cluster = connect(written(edges, "clusters")).select(F.col("vertex").alias("row"), F.col("label").alias("cluster"))
    rows = open_index.groupBy("row").agg(F.first("label").alias("label"), F.first("n").alias("n"), F.collect_list("sig").alias("sigs"))  # a row's own signatures
    rows = written(rows.join(cluster, "row"), "open-rows")
    sizes = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("c"), F.ceil(F.greatest(F.sum("n") / BLOCK_ELEMENTS, F.count(F.lit(1)) / BLOCK_ROWS)).cast("int").alias("cuts"))
    small = 1 + int((rows.agg(F.sum("n")).first()[0] or 0) / BLOCK_ELEMENTS)
    placed = salted_join(rows, written(sizes, "cluster-sizes"), ["cluster"], "row")
    # Rows of a large cluster stand by the smallest signature they have, and where too many have that one, by themselves.
    first = F.array_min("sigs")
    homes = placed.where("cuts > 1").groupBy(first.alias("home")).agg(F.greatest(F.sum("n") / BLOCK_ELEMENTS, F.count(F.lit(1)) / BLOCK_ROWS).alias("share")).where("share > 0.5")
    placed = placed.withColumn("home", first).join(homes, "home", "left")
    spread = F.pmod(F.xxhash64("row"), F.ceil(2 * F.coalesce("share", F.lit(0))).cast("int") + 1)
    i = F.pmod(F.xxhash64("home", spread), F.col("cuts")).cast("int")
    placed = placed.withColumn("i", F.when(F.col("cuts") > 1, i).otherwise(0))
    placed = placed.withColumn("cluster", F.when(F.col("cuts") == 1, F.pmod(F.xxhash64("cluster"), F.lit(small))).otherwise(F.col("cluster") + (1 << 62)))
    placed = written(placed.select("cluster", "cuts", "i", "row", "n", "label", "sigs"), "placed-rows")

    def work(group: pd.DataFrame) -> pd.DataFrame:
        within = bool((group["lo"] == group["hi"]).all())
        side = (group["i"] == group["hi"]).to_numpy()
        row, n = group["row"].to_numpy(), group["n"].to_numpy()
        held_sets = [np.sort(unpacked(s, width)) for s in group["shingles"]]
        held = np.array([len(s) for s in held_sets])
        _, label = np.unique(group["label"].to_numpy(), return_inverse=True)
        parent = list(range(int(label.max()) + 1))

        def root(v: int) -> int:
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        number = np.repeat(np.arange(len(row)), [len(s) for s in group["sigs"]])
        sig = np.concatenate([np.asarray(s, dtype=np.int64) for s in group["sigs"]])
        order = np.argsort(sig, kind="stable")
        sig, number = sig[order], number[order]
        first, length = runs(sig)
        begin = np.repeat(first, length)[np.argsort(order, kind="stable")]
        count = dict(zip(first.tolist(), length.tolist(), strict=True))
        own = np.cumsum([0, *(len(s) for s in group["sigs"])])
        links = []
        for x in range(len(row)):
            if not within and side[x]:
                continue
            others = np.unique(np.concatenate([number[b : b + count[b]] for b in begin[own[x] : own[x + 1]].tolist()]))
            others = others[others > x] if within else others[side[others]]
            common = np.minimum(held[x], held[others])
            others = others[(100 * common >= percent * (n[x] + n[others] - common)) & (label[others] != label[x])]
            others = others[[root(v) != root(int(label[x])) for v in label[others].tolist()]] if len(others) else others
            if not len(others):
                continue
            every = np.concatenate([held_sets[y] for y in others.tolist()])
            at = np.minimum(np.searchsorted(held_sets[x], every), held[x] - 1)
            common = tx.per_doc(held_sets[x][at] == every, np.concatenate([[0], np.cumsum(held[others])]))
            for y in others[100 * common >= percent * (n[x] + n[others] - common)].tolist():
                a, b = root(int(label[x])), root(int(label[y]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    links.append((row[x], row[y]))
        return pd.DataFrame(links, columns=["x", "y"], dtype="int64")

    whole = _met(placed).join(sets.rows.select("row", "shingles"), "row")
    return whole.groupBy("cluster", "lo", "hi").applyInPandas(work, "x long, y long")


def classes(index: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, width: int) -> DataFrame:
    """vertex, label of every row that links with another; the label is the smallest row of its class.

    `index` (sig, row, n) is read twice. `sets_of` gets the rows (row, n) that share a signature with others and
    gives their sets, as `Sets` holds them; no other set is looked at.
    """
    index = written(_distinct_signatures(index), "shared-index")
    candidates = written(index.select("row", "n").distinct(), "candidates")
    sets = Sets(written(sets_of(candidates), "candidate-sets"), percent, width)
    links = written(sets.verified(_stars(index, candidates, sets)), "links")
    label = connect(links)
    enough = candidates.count()
    open_index, left = _open(index, label)
    for number in range(ROUNDS):
        if left <= 4 * enough:
            break
        more = written(sets.verified(_towards_largest(open_index, sets, number)), "links")
        links = links.union(more)
        label = connect(links)
        open_index, left = _open(open_index.select("sig", "row", "n"), label)
        if 20 * more.count() < enough:
            break
    if left:
        label = connect(links.union(written(_resolved(open_index, sets), "links")))
    return label


def placed_rows(rows: DataFrame, member: DataFrame, label: DataFrame) -> DataFrame:
    """row, doc_id, n, component_id (the smallest id of the class) of all `rows` (row, doc_id, n); `member` (row, rep)
    names the row whose set stands for an equal one, for rows whose set another row has."""
    placed = rows.join(member, "row", "left").select("row", "doc_id", "n", F.coalesce("rep", "row").alias("rep"))
    placed = placed.join(label.toDF("rep", "label"), "rep", "left").select("row", "doc_id", "n", F.coalesce("label", "rep").alias("label"))
    placed = written(placed, "placed")
    least = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("c")).where("c > 1")
    together = salted_join(placed, written(least, "classes"), ["label"], "row").select("row", F.col("component_id").alias("least"), F.lit(True).alias("several"))
    out = placed.join(together, "row", "left")
    return out.select("row", "doc_id", "n", F.when(F.col("several"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def equal_sets(rows: DataFrame) -> DataFrame:
    """row, rep of the rows (row, n, a, b) whose whole set, known by n, a and b, another row has, too. `rows` is read twice."""
    rows = rows.select("row", "n", "a", "b")
    same = rows.groupBy("n", "a", "b").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1")
    return written(salted_join(rows, written(same, "equal-sets"), ["n", "a", "b"], "row").select("row", "rep"), "copies")

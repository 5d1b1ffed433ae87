"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text gets a space in front and its spaces become the whitespace marker; its segmentation is the one
of the highest sum of piece scores. A character that no piece covers costs more than any piece and is
written in byte pieces. Where no piece holds a marker after another character, as is checked, the best
segmentation of a text is that of its units (markers, then other characters), so each distinct unit is
segmented once a task, many at a time: at every start all units walk the trie together in numpy. In a
unit of LONG bytes, as in prose without spaces, all starts walk the trie at once instead.

Defined results: a null or empty text has no pieces and decodes to an empty text; a marker character in
the text itself decodes to a space; repeated rows are encoded alike; a text of any length is encoded
whole, a single unit's time being linear in its length; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from pathloom.llm import text as tx
from pathloom.llm.bpe import UnitCache
from pathloom.llm.shared import map_arrow

MARKER = "▁"
#: How far an uncovered character's score is below the lowest piece's.
UNKNOWN_PENALTY = 10.0


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class DoubleArray:
    """A trie in two arrays: from node s on byte c to t = base[s] + c, if check[t] == s; value[t] >= 0 ends a piece."""

    def __init__(self, pieces: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for piece, number in pieces.items():
            at = 0
            for c in piece:
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    ends.append(-1)
                at = children[at][c]
            ends[at] = number
        size = 2 * len(children) + 512
        base, check, value = np.zeros(size, dtype=np.int32), np.full(size, -1, dtype=np.int32), np.full(size, -1, dtype=np.int32)
        taken = np.zeros(size, dtype=bool)
        taken[0] = True
        place = {0: 0}
        wide = free = 257  # no place before it: a base is positive and a byte at most 255
        for node, kids in enumerate(children):  # parents come before their children
            s = place.pop(node)
            value[s] = ends[node]
            if not kids:
                continue
            codes = np.array(sorted(kids))
            while taken[free]:
                free += 1
            b, tries = (free if len(codes) == 1 else max(free, wide)) - int(codes[0]), 0
            while True:
                if b + 256 >= len(base):
                    grow = len(base)
                    base, check, value, taken = (np.concatenate([a, np.full(grow, f, dtype=a.dtype)]) for a, f in ((base, 0), (check, -1), (value, -1), (taken, False)))
                if not taken[b + codes].any():
                    break
                b, tries = b + 1, tries + 1
            if len(codes) > 1 and tries > 30:  # crowded so far: later nodes of several children look further on
                wide = b + int(codes[0])
            base[s] = b
            taken[b + codes] = True
            check[b + codes] = s
            for c in codes.tolist():
                place[kids[c]] = b + c
        self.base, self.check, self.value = base, check, value


@dataclass
class Pieces:
    """What a model file holds: the trie, scores, bytes of each piece, and the ids of the byte pieces."""

    trie: DoubleArray
    scores: np.ndarray
    raw: np.ndarray
    offsets: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    by_unit: bool
    longest: int


def load_pieces(path: str | None = None) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path or default_model())
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    byte_ids = np.full(256, model.unk_id(), dtype=np.uint32)
    raw, plain = [], {}
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            raw.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            raw.append(name.replace(MARKER, " ").encode())
            plain[raw[-1]] = i
    by_unit = all(b" " not in p.lstrip(b" ") for p in plain)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    scores = np.array([model.get_score(i) for i in range(n)], dtype=np.float64)
    return Pieces(DoubleArray(plain), scores, np.frombuffer(b"".join(raw), dtype=np.uint8), offsets, byte_ids, model.unk_id(), by_unit, max(map(len, plain)))


_SIZE = np.ones(256, dtype=np.int64)
_SIZE[0xC0:0xE0], _SIZE[0xE0:0xF0], _SIZE[0xF0:] = 2, 3, 4


def viterbi(p: Pieces, grid: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best segmentation of every row of `grid` (bytes; `length` of them count), and how many each has."""
    n, width = grid.shape
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0
    came, piece = np.zeros((n, width + 1), dtype=np.int32), np.full((n, width + 1), -1, dtype=np.int32)
    low = p.scores.min() - UNKNOWN_PENALTY
    for i in range(width):
        rows = np.flatnonzero((length > i) & (best[:, i] > -np.inf))
        if not len(rows):
            continue
        char_end = np.minimum(i + _SIZE[grid[rows, i]], length[rows])
        single = np.zeros(n, dtype=bool)
        walk, node = rows, np.zeros(len(rows), dtype=np.int64)
        for j in range(i, min(width, i + p.longest)):
            to = p.trie.base[node] + grid[walk, j].astype(np.int64)
            ok = (p.trie.check[to] == node) & (p.trie.base[node] > 0)
            walk, node = walk[ok], to[ok]
            if not len(walk):
                break
            ends = p.trie.value[node] >= 0
            at, number = walk[ends], p.trie.value[node[ends]]
            score = best[at, i] + p.scores[number]
            better = score > best[at, j + 1]
            at, number = at[better], number[better]
            best[at, j + 1], came[at, j + 1], piece[at, j + 1] = score[better], i, number
            single[walk[ends]] |= i + _SIZE[grid[walk[ends], i]] == j + 1
            more = length[walk] > j + 1
            walk, node = walk[more], node[more]
        alone = ~single[rows]
        at, end = rows[alone], char_end[alone]
        score = best[at, i] + low
        better = score > best[at, end]
        at, end = at[better], end[better]
        best[at, end], came[at, end], piece[at, end] = score[better], i, -1
    # Back from each row's end: (row, start, end, piece), then byte pieces for what no piece covers.
    rows, end, steps = np.arange(n), length.copy(), []
    while len(rows):
        live = end > 0
        rows, end = rows[live], end[live]
        begin = came[rows, end].astype(np.int64)
        steps.append((rows, begin, end, piece[rows, end].astype(np.int64)))
        end = begin
    row, begin, end, number = (np.concatenate([s[k] for s in steps]) if steps else np.empty(0, dtype=np.int64) for k in range(4))
    order = np.lexsort((begin, row))
    row, begin, end, number = row[order], begin[order], end[order], number[order]
    count = np.where(number >= 0, 1, end - begin)
    where = np.repeat(np.arange(len(row)), count)
    column = tx.spans(begin, count)
    ids = np.where(number[where] >= 0, number[where], p.byte_ids[grid[row[where], np.minimum(column, width - 1)]]).astype(np.uint32)
    return ids, np.bincount(row, weights=count, minlength=n).astype(np.int64)


def viterbi_long(p: Pieces, data: np.ndarray) -> np.ndarray:
    """Ids of the best segmentation of one long unit, the same as `viterbi` gives.

    All starts walk the trie together, a depth a step; what is left one after the other is the maximum over the
    pieces found, in the order of their starts.
    """
    n = len(data)
    starts, ends, numbers = [], [], []
    at, node = np.arange(n), np.zeros(n, dtype=np.int64)
    covered = np.zeros(n, dtype=bool)
    for depth in range(min(p.longest, n)):
        inside = at + depth < n
        at, node = at[inside], node[inside]
        to = p.trie.base[node] + data[at + depth].astype(np.int64)
        ok = (p.trie.check[to] == node) & (p.trie.base[node] > 0)
        at, node = at[ok], to[ok]
        if not len(at):
            break
        found = p.trie.value[node] >= 0
        starts.append(at[found])
        ends.append(at[found] + depth + 1)
        numbers.append(p.trie.value[node[found]].astype(np.int64))
        covered[at[found][_SIZE[data[at[found]]] == depth + 1]] = True
    alone = np.arange(n)[~covered]
    starts.append(alone)
    ends.append(np.minimum(alone + _SIZE[data[alone]], n))
    numbers.append(np.full(len(alone), -1))
    start, end, number = np.concatenate(starts), np.concatenate(ends), np.concatenate(numbers)
    order = np.argsort(start, kind="stable")
    start, end, number = start[order], end[order], number[order]
    score = np.where(number >= 0, p.scores[number], p.scores.min() - UNKNOWN_PENALTY)
    none = float("-inf")
    best, came = [none] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    for k, (i, j, v) in enumerate(zip(start.tolist(), end.tolist(), score.tolist(), strict=True)):
        v += best[i]
        if v > best[j]:
            best[j], came[j] = v, k
    ids, i = [], n
    while i:
        k = came[i]
        begin = int(start[k])
        ids.append(np.array([number[k]]) if number[k] >= 0 else p.byte_ids[data[begin:i]])
        i = begin
    return np.concatenate(ids[::-1]).astype(np.uint32) if ids else np.empty(0, dtype=np.uint32)


#: Bytes from which a unit is segmented by itself.
LONG = 512


class Encoder(UnitCache):
    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def _learn(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, buf: np.ndarray) -> None:
        length = ends - starts
        for u in np.flatnonzero(length >= LONG).tolist():
            ids = viterbi_long(self.pieces, buf[starts[u] : ends[u]])
            self._keep(hashes[u : u + 1], [ids], [np.array([len(ids)])])
        short = np.flatnonzero(length < LONG)
        hashes, starts, ends, length = hashes[short], starts[short], ends[short], length[short]
        order = np.argsort(length, kind="stable")
        i = 0
        while i < len(order):  # units of about one length, as many as fit a grid of bounded size
            top = max(16, int(2 ** np.ceil(np.log2(length[order[i]]))))
            j = min(int(np.searchsorted(length[order], top, side="right")), i + max(1, (1 << 20) // top))
            part = order[i:j]
            width = int(length[part].max())
            grid = np.zeros((len(part), width), dtype=np.uint8)
            at = np.repeat(np.arange(len(part)), length[part])
            grid[at, tx.spans(np.zeros(len(part), dtype=np.int64), length[part])] = buf[tx.spans(starts[part], length[part])]
            ids, counts = viterbi(self.pieces, grid, length[part])
            self._keep(hashes[part], [ids], [counts])
            i = j

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids, how many each text has, and the texts as they are encoded, with their offsets."""
        marker = MARKER.encode()
        if marker[:2] in buf.tobytes():
            texts = [buf[a:b].tobytes().replace(marker, b" ") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
        full = np.diff(offsets) > 0
        buf = np.insert(buf, offsets[:-1][full], 32)
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        first = buf == 32
        if self.pieces.by_unit:
            first[1:] &= buf[:-1] != 32
        else:
            first[:] = False
        first[offsets[:-1][full]] = True
        starts = np.flatnonzero(first)
        ids, size = self.ids(buf, starts, np.append(starts[1:], len(buf)))
        return ids, tx.per_doc(size, np.searchsorted(starts, offsets)), buf, offsets


def decode(p: Pieces, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts of all ids, each text's first space still there."""
    size = (p.offsets[1:] - p.offsets[:-1])[ids]
    raw = p.raw[tx.spans(p.offsets[ids], size)]
    return raw, np.concatenate([[0], np.cumsum(tx.per_doc(size, np.concatenate([[0], np.cumsum(counts)])))])


def decode_text(p: Pieces, ids: list[int]) -> str:
    raw, _ = decode(p, np.array(ids, dtype=np.int64), np.array([len(ids)]))
    return raw.tobytes().decode("utf-8", "replace").removeprefix(" ")


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, n_ids, n_fallback (byte pieces), ids_crc32, round_trip (whether decoding gives the text back), and the ids."""
    pieces = load_pieces(path)
    is_byte = np.zeros(len(pieces.scores), dtype=bool)
    is_byte[pieces.byte_ids] = True
    is_byte[pieces.unknown] = False
    names = ["doc_id", "n_ids", "n_fallback", "ids_crc32", "round_trip", *(["ids"] if with_ids else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces)
        for batch in batches:
            for i, j, buf, offsets in tx.groups(batch.column("text")):
                ids, counts, whole, at = encoder.encode(buf, offsets)
                cut = np.concatenate([[0], np.cumsum(counts)])
                raw, places = decode(pieces, ids, counts)
                if np.array_equal(raw, whole) and np.array_equal(places, at):
                    same = np.ones(j - i, dtype=bool)
                else:
                    same = np.array([np.array_equal(raw[a:b], whole[c:d]) for a, b, c, d in zip(places[:-1], places[1:], at[:-1], at[1:], strict=True)])
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                columns = [batch.column("doc_id").slice(i, j - i), pa.array(counts), pa.array(tx.per_doc(is_byte[ids], cut)), pa.array(crc, pa.int64()), pa.array(same)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(docs.select("doc_id", "text"), work, "doc_id long, n_ids long, n_fallback long, ids_crc32 long, round_trip boolean" + (", ids array<int>" if with_ids else ""))

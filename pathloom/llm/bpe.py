"""Ids of a public byte-level BPE vocabulary for many texts at once.

The vocabulary's split never joins what stands before a run of white space with that run, so a text is
cut there into units, each distinct unit is encoded once per task, and ids are gathered by unit. Texts
with white space beyond ASCII are encoded whole. Texts are cut at the vocabulary's added tokens before
that, as the tokenizers library does. `tests/llm` compares the ids with that library.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
import public_tokenizers
import tiktoken

from pathloom.llm import text as tx

#: The white space characters of Unicode above ASCII.
_OTHER_SPACE = re.compile("[\x85\xa0  -     　]")
#: Distinct units a task remembers; beyond that it starts anew.
UNITS_KEPT = 400_000


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[bytes, int]:
    """The added tokens that the library's file beside the rank file names."""
    path = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
            raise ValueError(f"added token {t['content']!r} of {path} is not matched as plain text")
    return {t["content"].encode(): t["id"] for t in tokens}


class UnitCache:
    """Ids of distinct units (segments of a buffer), found once and kept by the units' hashes."""

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        """Units known so far: their hashes in order, the row of each, and by row where its ids stand."""
        self.hashes, self.rows = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1, dtype=np.int64)

    def _enter(self, ids: list[np.ndarray], lengths: list[np.ndarray]) -> None:
        """New rows, in the order given."""
        ids, used = np.concatenate(ids), self.ends[-1]
        if used + len(ids) > len(self.flat):
            grown = np.empty(2 * (used + len(ids)), dtype=np.uint32)
            grown[:used] = self.flat[:used]
            self.flat = grown
        self.flat[used : used + len(ids)] = ids
        self.ends = np.concatenate([self.ends, used + np.cumsum(np.concatenate(lengths))])

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each unit, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.rows[at], -1)

    def _learn(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, buf: np.ndarray) -> None:
        raise NotImplementedError

    def _keep(self, hashes: np.ndarray, ids: list[np.ndarray], lengths: list[np.ndarray]) -> None:
        rows = len(self.ends) - 1 + np.arange(len(hashes))
        self._enter(ids, lengths)
        known = np.concatenate([self.hashes, hashes])
        order = np.argsort(known, kind="stable")
        self.hashes, self.rows = known[order], np.concatenate([self.rows, rows])[order]

    def ids(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units one after the other, and how many each has."""
        if len(self.hashes) > UNITS_KEPT:
            self._forget()
        if not len(starts):
            return np.empty(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        hashes, at, back = np.unique(tx.segment_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        row = self._find(hashes)
        new = np.flatnonzero(row < 0)
        if len(new):
            new = new[np.argsort(at[new])]
            self._learn(hashes[new], starts[at[new]], ends[at[new]], buf)
            row = self._find(hashes)
        begin, size = self.ends[row], (self.ends[1:] - self.ends[:-1])[row][back]
        return self.flat[tx.spans(begin[back], size)], size


class Encoder(UnitCache):
    def __init__(self, path: str | None = None):
        path = path or default_vocabulary()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        self.sizes[list(ranks.values())] = [len(t) for t in ranks]
        self.added = added_tokens(path)
        longest = sorted(self.added, key=len, reverse=True)
        self.any_added = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        super().__init__()

    def _learn(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, buf: np.ndarray) -> None:
        """Encodes units not met before. Those that begin with white space and end without are encoded as one text."""
        chained = ~tx.IS_WORD[buf[starts]] & tx.IS_WORD[buf[ends - 1]]
        s, e = starts[chained], ends[chained]
        all_ids, lengths = [np.empty(0, dtype=np.uint32)], [np.empty(0, dtype=np.int64)]
        if len(s):
            raw = buf[tx.spans(s, e - s)].tobytes().decode("utf-8", "replace")
            ids = np.array(self.encoding.encode_ordinary(raw), dtype=np.uint32)
            cut = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(e - s)) + 1
            all_ids.append(ids)
            lengths.append(np.diff(cut, prepend=0))
        for k in np.flatnonzero(~chained):
            ids = self.encoding.encode_ordinary(buf[starts[k] : ends[k]].tobytes().decode("utf-8", "replace"))
            all_ids.append(np.array(ids, dtype=np.uint32))
            lengths.append(np.array([len(ids)]))
        self._keep(np.concatenate([hashes[chained], hashes[~chained]]), all_ids, lengths)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        raw = buf.tobytes()
        if self.any_added is None or not self.any_added.search(raw):
            return self._between(buf, offsets)
        found = [m for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for m in self.any_added.finditer(raw, a, b)]
        starts, ends = (np.array([m.span()[k] for m in found], dtype=np.int64) for k in (0, 1))
        plain = np.ones(len(buf), dtype=bool)
        plain[tx.spans(starts, ends - starts)] = False
        # Parts: texts without the added tokens, cut where those stood.
        edges = np.sort(np.concatenate([offsets, starts]))
        ids, sizes = self._between(buf[plain], np.concatenate([[0], np.cumsum(plain)])[edges])
        part = np.searchsorted(offsets, starts, side="right") + np.arange(len(found))
        ids = np.insert(ids, np.cumsum(sizes)[part - 1], np.array([self.added[m[0]] for m in found], dtype=ids.dtype))
        sizes[part] += 1
        return ids, tx.per_doc(sizes, np.arange(len(offsets)) + np.searchsorted(starts, offsets))

    def _between(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        if _OTHER_SPACE.search(buf.tobytes().decode("utf-8", "replace")):
            return self._whole(buf, offsets)
        inside = tx.IS_WORD[buf]
        first = ~inside
        first[1:] &= inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(buf)]
        first[edges] = True
        starts = np.flatnonzero(first)
        ids, size = self.ids(buf, starts, np.append(starts[1:], len(buf)))
        return ids, tx.per_doc(size, np.searchsorted(starts, offsets))

    def _whole(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [buf[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        ids = [np.array(self.encoding.encode_ordinary(t), dtype=np.uint32) for t in texts]
        return np.concatenate(ids) if ids else np.empty(0, dtype=np.uint32), np.array([len(x) for x in ids], dtype=np.int64)

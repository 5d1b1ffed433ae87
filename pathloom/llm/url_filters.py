"""Glob rules over URLs, all simulated at once by a bit-parallel Shift-And automaton.

A URL is made canonical as "." + host + path (`canonical`), so that a rule of a host also fits its
subdomains. In a pattern `*` is any run without "/", `**` any run, `?` one byte other than "/"; a
pattern covers the whole canonical URL. Every position of every pattern is a bit in a row of 64-bit
words. A state set D moves on a byte c as

    D' = ((D << 1 | starts) & accepts[c]) | (D & loops[c])

where loops holds the bits that stay on a wildcard, and skips let a wildcard match nothing. The rows of
many URLs advance together, one byte position at a time, carries going from word to word.

Defined results: host and path of a null URL, or one without "://", are empty and fit no rule; repeated
rows come out each time; URLs of any length cost one step a byte; non-ASCII bytes match wildcards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom.llm import text as tx
from pathloom.llm.shared import map_arrow

U64 = np.uint64


class GlobSet:
    """Patterns packed into multiword masks."""

    def __init__(self, patterns: Sequence[str]):
        self.patterns = list(patterns)
        steps: list[tuple[str, bytes]] = []  # what a position takes: one byte, any but "/", loops
        starts, ends = [], []
        for pattern in self.patterns:
            raw, i = pattern.encode(), 0
            starts.append(len(steps))
            while i < len(raw):
                if raw[i : i + 2] == b"**":
                    steps.append(("all", b""))
                    i += 2
                    continue
                c = raw[i : i + 1]
                steps.append(("run", b"") if c == b"*" else ("one", b"") if c == b"?" else ("byte", c))
                i += 1
            steps.append(("end", b""))
            ends.append(len(steps) - 1)
        self.words = max(1, (len(steps) + 63) // 64)
        self.ends = np.array(ends, dtype=np.int64)
        #: Bit i of a state set: pattern position i is the next to be read.
        self.step = np.zeros((256, self.words), dtype=U64)  # reading c at i leads to i + 1
        self.stay = np.zeros((256, self.words), dtype=U64)  # reading c at i leads to i
        self.skip = np.zeros(self.words, dtype=U64)  # i leads to i + 1 without a byte
        self.start = np.zeros(self.words, dtype=U64)
        every, but_slash = np.arange(256), np.delete(np.arange(256), ord("/"))
        for i, (kind, c) in enumerate(steps):
            word, bit = divmod(i, 64)
            mask = U64(1 << bit)
            if kind == "byte":
                self.step[c[0], word] |= mask
            elif kind == "one":
                self.step[but_slash, word] |= mask
            elif kind in ("run", "all"):
                self.stay[but_slash if kind == "run" else every, word] |= mask
                self.skip[word] |= mask
        for i in starts:
            self.start[i // 64] |= U64(1 << (i % 64))
        self.start = self._closed(self.start[None, :])[0]  # a wildcard at the start may match nothing

    @staticmethod
    def _shifted(d: np.ndarray) -> np.ndarray:
        out = d << U64(1)
        out[:, 1:] |= d[:, :-1] >> U64(63)
        return out

    def _closed(self, d: np.ndarray) -> np.ndarray:
        """The set with what wildcards reach by matching nothing."""
        while True:
            more = d | self._shifted(d & self.skip)
            if not np.any(more ^ d):
                return more
            d = more

    def match(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Boolean (texts, patterns): which patterns cover each text."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        at, size = offsets[:-1][order], lengths[order]
        state = np.repeat(self.start[None, :], len(order), axis=0)
        for k in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -k, side="left"))  # texts longer than k
            d, c = state[:live], buf[at[:live] + k]
            state[:live] = self._closed(self._shifted(d & self.step[c]) | (d & self.stay[c]))
        hit = (state[:, self.ends // 64] >> (self.ends % 64).astype(U64)) & U64(1)
        out = np.empty((len(order), len(self.ends)), dtype=bool)
        out[order] = hit.astype(bool)
        return out


def canonical(pages: DataFrame, url: str = "url") -> DataFrame:
    """`pages` with columns host and path: the part after the first "://", without query and fragment."""
    mark = f"instr(`{url}`, '://')"
    rest = F.coalesce(F.expr(f"CASE WHEN {mark} > 0 THEN substring(`{url}`, {mark} + 3) END"), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return pages.withColumns({"host": F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "path": path})


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], globs: Sequence[tuple[str, str]], default: str = "allow") -> DataFrame:
    """`pages` (with host and path) with columns rule and verdict, in place of columns of these names that it may have.

    `rules` are (host, path, verdict): of those that fit, the longest decides. Where none fits, the
    first of `globs` (pattern, verdict) that fits decides, else `default`.
    """
    pages = pages.drop("rule", "verdict")
    ranked = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    automaton = GlobSet([f"*.{h}{_literal(p)}**" for h, p, _ in ranked] + [g for g, _ in globs])
    names = np.array([h + p for h, p, _ in ranked] + [None], dtype=object)
    verdicts = np.array([v for _, _, v in ranked] + [v for _, v in globs] + [default], dtype=object)
    schema = T.StructType([*pages.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType(), False)])
    columns = pages.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([f".{h or ''}{p or ''}" for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)], pa.string())
            for i, j, buf, offsets in tx.groups(keys, 1 << 18):
                fits = automaton.match(buf, offsets)
                fits = np.concatenate([fits, np.ones((j - i, 1), dtype=bool)], axis=1)
                best = np.argmax(fits, axis=1)
                rule = names[np.minimum(best, len(ranked))]
                added = [pa.array(rule, pa.string()), pa.array(verdicts[best], pa.string())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in columns), *added], [*columns, "rule", "verdict"])

    return map_arrow(pages, work, schema)


def _literal(path: str) -> str:
    if "*" in path or "?" in path:
        raise ValueError("rules are literal; give wildcards as globs")
    return path

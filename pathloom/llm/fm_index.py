"""Suffix-rank intervals over a delimited vocabulary, and search schemes with one error over them.

The words of a vocabulary stand one after the other, a delimiter before each. The index holds the rank of
every suffix; all places where a string ends are one interval of ranks, and one step to the left takes the
interval of a string to that of the string with one more character before it (`step`). An index over
reversed words takes steps to the right instead. `Both` holds one of each: a search matches the half of a
query that must be exact first, whichever end it stands at, and goes on across the other half.

All work is on numpy arrays over many queries at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from pathloom.llm.text import spans

#: Queries searched at once.
BATCH = 20_000


def _flat(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words, and where each begins."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    return points, np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)


class SuffixRanks:
    """An index of distinct words in ascending order, read from the end of a word to its beginning."""

    def __init__(self, words: Sequence[str]):
        points, bounds = _flat(words)
        self.letters, codes = np.unique(points, return_inverse=True)
        self.n_words, n = len(words), len(points) + len(words)
        lengths = np.diff(bounds)
        symbol = np.zeros(n, dtype=np.int64)
        begin = bounds[:-1] + np.arange(self.n_words)
        symbol[spans(begin + 1, lengths)] = codes + 1
        # Every delimiter is a symbol of its own, in the order of words, so that no two suffixes are equal.
        rank = symbol + self.n_words - 1
        rank[begin] = np.arange(self.n_words)
        reach = 1
        while True:
            key = rank * (int(rank.max()) + 1) + np.roll(rank, -reach)
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            if n == 1 or rank[order[-1]] == n - 1:
                break
            reach *= 2
        self.n = n
        #: The symbol before each suffix, by rank; 0 is the delimiter.
        self.before = symbol[order - 1]
        #: All (symbol before, rank), sorted: where a pair stands here is the rank of the suffix one longer.
        self.steps = np.sort(self.before * (n + 1) + np.arange(n))

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; -1 where no word has one."""
        at = np.searchsorted(self.letters, points)
        found = self.letters[np.minimum(at, len(self.letters) - 1)] == points
        return np.where(found, at + 1, -1)

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals with one more symbol each; empty where the symbol is none of the index."""
        base = symbol * (self.n + 1)
        lo, hi = np.searchsorted(self.steps, base + lo), np.searchsorted(self.steps, base + hi)
        return lo, np.where(symbol < 0, lo, hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of every interval all intervals with one more letter: the interval's number, letter, lo, hi."""
        size, most = hi - lo, len(self.letters)
        few = np.flatnonzero(size <= most)
        state = np.repeat(few, size[few])
        pair = np.unique(state * (most + 1) + self.before[spans(lo[few], size[few])])
        many = np.flatnonzero(size > most)  # by letters, as rows would be more
        pair = np.concatenate([pair, (many[:, None] * (most + 1) + np.arange(1, most + 1)).ravel()])
        state, letter = pair // (most + 1), pair % (most + 1)
        state, letter = state[letter > 0], letter[letter > 0]
        a, b = self.step(letter, lo[state], hi[state])
        there = a < b
        return state[there], letter[there], a[there], b[there]

    def one_error(self, queries: Sequence[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of all words that have the last `exact` letters of a query and differ by exactly one
        inserted, deleted or replaced letter before them. Queries are read from their end, too.

        Of several places that give the same word only one counts: a letter of a run is inserted or
        deleted at the run's end (in reading order) alone.
        """
        found = [self._one_error(queries[i : i + BATCH], exact[i : i + BATCH]) for i in range(0, len(queries), BATCH)]
        return np.concatenate([q + i * BATCH for i, (q, _) in enumerate(found)] or [np.empty(0, np.int64)]), np.concatenate([w for _, w in found] or [np.empty(0, np.int64)])

    def _one_error(self, queries: Sequence[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points, bounds = _flat(queries)
        codes = np.concatenate([self.codes(points), [0]])
        length = np.diff(bounds)
        last = bounds[1:] - 1
        q = np.arange(len(queries))
        lo, hi = np.zeros(len(q), dtype=np.int64), np.full(len(q), self.n_words, dtype=np.int64)
        for k in range(int(exact.max()) if len(exact) else 0):
            going = exact[q] > k
            stay = ~going
            a, b = self.step(codes[last[q] - k], lo, hi)
            lo, hi = np.where(stay, lo, a), np.where(stay, hi, b)
            there = lo < hi
            q, lo, hi = q[there], lo[there], hi[there]
        rest = length - exact

        def letter(q: np.ndarray, k: int) -> np.ndarray:
            """What a query holds k places into its second half; the delimiter behind its last letter."""
            return np.where(rest[q] > k, codes[np.where(rest[q] > k, last[q] - exact[q] - k, 0)], 0)

        one = (np.empty(0, np.int64),) * 3
        out_q, out_w = [], []
        for k in range(int(rest.max()) + 1 if len(rest) else 0):
            want, after, ends = letter(q, k), letter(q, k + 1), rest[q] == k
            state, c, a, b = self.branches(lo, hi)
            inserted = c != want[state]
            replaced = inserted & ~ends[state]
            deleted = ~ends & (want != after)
            one = tuple(np.concatenate(x) for x in zip(one, (q[state][inserted], a[inserted], b[inserted]), strict=True))
            oq, (a1, b1) = one[0], self.step(letter(one[0], k), one[1], one[2])
            there = a1 < b1
            oq, a1, b1 = oq[there], a1[there], b1[there]
            over = rest[oq] == k
            out_q.append(oq[over])
            out_w.append(a1[over])  # behind the delimiter a whole word is one suffix, and its rank the word's number
            one = tuple(
                np.concatenate(x)
                for x in zip((oq[~over], a1[~over], b1[~over]), (q[state][replaced], a[replaced], b[replaced]), (q[deleted], lo[deleted], hi[deleted]), strict=True)
            )
            a, b = self.step(want, lo, hi)
            there = ~ends & (a < b)
            q, lo, hi = q[there], a[there], b[there]
        return np.concatenate(out_q or [q]), np.concatenate(out_w or [q])


class Both:
    """A bidirectional index: the same words read to the left and to the right."""

    def __init__(self, words: Sequence[str]):
        self.forward = sorted(set(words))
        self.backward = sorted(w[::-1] for w in self.forward)

    def left_exact(self, queries: Sequence[str]) -> list[tuple[int, str]]:
        """Words with the first half of a query and one error behind it."""
        index = SuffixRanks(self.backward)
        found = index.one_error([w[::-1] for w in queries], np.array([len(w) // 2 for w in queries], dtype=np.int64))
        return [(q, self.backward[w][::-1]) for q, w in zip(*(x.tolist() for x in found), strict=True)]

    def right_exact(self, queries: Sequence[str]) -> list[tuple[int, str]]:
        """Words with the second half of a query and one error before it, but not its first half."""
        index = SuffixRanks(self.forward)
        found = index.one_error(queries, np.array([len(w) - len(w) // 2 for w in queries], dtype=np.int64))
        pairs = [(q, self.forward[w]) for q, w in zip(*(x.tolist() for x in found), strict=True)]
        return [(q, w) for q, w in pairs if not w.startswith(queries[q][: len(queries[q]) // 2])]

    def near(self, queries: Sequence[str]) -> list[tuple[int, str]]:
        """(query number, word) of all words that differ by exactly one error, each once."""
        return self.left_exact(queries) + self.right_exact(queries)

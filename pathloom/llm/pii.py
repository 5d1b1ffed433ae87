"""Personal data in texts: fixed patterns, and a character BiLSTM with CRF transitions that adds to them.

`base_spans` finds emails, IP addresses, card and phone numbers by pattern; a match that fails its
check is dropped and not tried anew, so a phone number with a card number right after it is missed.
The network (`Tagger`) labels characters; its spans are added where they pass their kind's check and
touch no other span.

Training, in numpy on the driver, uses at most MAX_TRAIN whole texts, and PER_TEXT spans and stretches drawn over
the length of each: spans the patterns find there, with their digits drawn anew, are set one after the
other into stretches that hold none, so every label is known. Tagging cuts a text into windows of WIDTH characters, STRIDE apart. A window with
neither a digit nor "@" can hold no span of these kinds and is not run. Spans of all windows of a text
are reconciled together: those cut off by a window's edge give way to the neighbour's, and of
overlapping ones the set of the highest total score stays.

Defined results: a null or empty text has no spans; repeated rows are found alike; a text of any length
is tagged in windows; without a text to train on nothing is added; an empty table gives an empty
result; further columns are carried or ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathloom.llm import text as tx
from pathloom.llm.shared import map_arrow

KINDS = ("email", "ip", "card", "phone")
#: The patterns and what their matches must pass.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")  # possessive: a long run of digits is read once
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, end, number of the kind

#: Bound of the training sample: texts, and spans and stretches drawn over each whole text.
MAX_TRAIN, PER_TEXT = 1500, 40
WIDTH, STRIDE = 160, 80
TRAIN_WIDTH, TRAIN_WINDOWS, EPOCHS, BATCH, RATE = 96, 1800, 8, 60, 0.01
HIDDEN, EMBED = 16, 8
N_TAGS = 1 + 2 * len(KINDS)  # none; first and further character of each kind
N_CHARS = 100
_POLICY = np.full(128, 98, dtype=np.int64)
_POLICY[32:127] = np.arange(95)
_POLICY[10] = 95


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def passes(kind: int, s: str) -> bool:
    """The check of a match beyond its pattern."""
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in s.split("."))
    if kind == 2:
        d = _digits(s)
        return 14 <= len(d) <= 19 and _luhn(d)
    if kind == 3:
        return 10 <= len(_digits(s)) <= 15
    return True


def whole(kind: int, s: str) -> bool:
    """Whether a string is a span of the kind from end to end."""
    if kind == 0:
        at = s.find("@")
        return at > 0 and not s[:at].strip(LOCAL) and not s[:at].lstrip(LOCAL) and DOMAIN.fullmatch(s, at + 1) is not None
    pattern = (None, IP, CARD, PHONE)[kind]
    return pattern.fullmatch(s) is not None and passes(kind, s)


def base_spans(text: str) -> list[Span]:
    out = []
    free, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        free = max(free, text.rfind("@", free, at) + 1)  # no part before an address holds the sign, so each letter is read once
        start = free + len(text[free:at].rstrip(LOCAL))
        if domain and start < at:
            out.append((start, domain.end(), 0))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
        if domain is None:
            free = max(free, start)  # what stands before is no part of a later address
    for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if passes(kind, m.group())]
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    out = np.full(len(points), 99, dtype=np.int64)
    low = points < 128
    out[low] = _POLICY[points[low]]
    letters = (points >= 0xC0) & (points < 0x250)
    out[letters] = 97
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Embedding, one LSTM a direction, an output layer and CRF transitions."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {
            "embed": r.normal(0, 0.3, (N_CHARS, EMBED)),
            "w": r.normal(0, 1 / np.sqrt(EMBED + h), (2, EMBED + h, 4 * h)),
            "b": np.tile(np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]), (2, 1, 1)).reshape(2, 1, 4 * h),
            "out": r.normal(0, 1 / np.sqrt(2 * h), (2 * h, N_TAGS)),
            "bias": np.zeros(N_TAGS),
            "next": np.zeros((N_TAGS, N_TAGS)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def emissions(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Scores (windows, characters, tags) of code arrays (windows, characters)."""
        n, t = x.shape
        h, p = HIDDEN, self.p
        e = p["embed"][x]
        both = np.stack([e, e[:, ::-1]]).transpose(2, 0, 1, 3)  # step, direction, window, value
        into = both @ p["w"][None, :, :EMBED] + p["b"][None]
        u = p["w"][:, EMBED:]
        state, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        states = np.empty((t, 2, n, h), np.float32)
        kept = []
        for i in range(t):
            z = into[i] + state @ u
            gates = _sigmoid(z[..., : 3 * h])
            new = np.tanh(z[..., 3 * h :])
            last = cell
            cell = gates[..., h : 2 * h] * last + gates[..., :h] * new
            squash = np.tanh(cell)
            before = state
            state = gates[..., 2 * h :] * squash
            states[i] = state
            if keep:
                kept.append((gates, new, last, squash, before))
        joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=-1).transpose(1, 0, 2)
        return joined @ p["out"] + p["bias"], {"kept": kept, "both": both, "joined": joined}

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        n, t = x.shape
        h, p = HIDDEN, self.p
        e, memory = self.emissions(x, keep=True)
        e = e.astype(np.float64)
        trans = p["next"].astype(np.float64)
        a, b = np.empty((t, n, N_TAGS)), np.zeros((t, n, N_TAGS))
        a[0] = e[:, 0]
        for i in range(1, t):
            s = a[i - 1][:, :, None] + trans
            top = s.max(axis=1)
            a[i] = e[:, i] + top + np.log(np.exp(s - top[:, None]).sum(axis=1))
        for i in range(t - 2, -1, -1):
            s = trans[None] + (e[:, i + 1] + b[i + 1])[:, None, :]
            top = s.max(axis=2)
            b[i] = top + np.log(np.exp(s - top[:, :, None]).sum(axis=2))
        top = a[-1].max(axis=1)
        log_z = top + np.log(np.exp(a[-1] - top[:, None]).sum(axis=1))
        d_e = np.exp(a + b - log_z[None, :, None]).transpose(1, 0, 2)
        joint = np.zeros((N_TAGS, N_TAGS))
        for i in range(1, t):
            joint += np.exp(a[i - 1][:, :, None] + trans + (e[:, i] + b[i])[:, None, :] - log_z[:, None, None]).sum(axis=0)
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(t)[None], y].sum() + trans[y[:, :-1], y[:, 1:]].sum()
        d_e[rows, np.arange(t)[None], y] -= 1
        np.subtract.at(joint, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        d_e = (d_e / n).astype(np.float32)
        g = {"next": (joint / n).astype(np.float32), "bias": d_e.sum(axis=(0, 1))}
        joined = memory["joined"]
        g["out"] = joined.reshape(-1, 2 * h).T @ d_e.reshape(-1, N_TAGS)
        d_joined = (d_e @ p["out"].T).transpose(1, 0, 2)
        d_states = np.stack([d_joined[..., :h], d_joined[::-1, :, h:]], axis=1)
        u = p["w"][:, EMBED:].transpose(0, 2, 1)
        d_into = np.empty((t, 2, n, 4 * h), np.float32)
        d_u = np.zeros((2, h, 4 * h), np.float32)
        d_state, d_cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        for i in range(t - 1, -1, -1):
            gates, new, last, squash, before = memory["kept"][i]
            d_state = d_state + d_states[i]
            o = gates[..., 2 * h :]
            d_cell = d_cell + d_state * o * (1 - squash**2)
            d_gates = np.concatenate([d_cell * new, d_cell * last, d_state * squash], axis=-1) * gates * (1 - gates)
            z = np.concatenate([d_gates, d_cell * gates[..., :h] * (1 - new**2)], axis=-1)
            d_into[i] = z
            d_u += before.transpose(0, 2, 1) @ z
            d_state = z @ u
            d_cell = d_cell * gates[..., h : 2 * h]
        both = memory["both"]
        d_w = np.einsum("tdne,tdnz->dez", both, d_into, optimize=True)
        g["w"] = np.concatenate([d_w, d_u], axis=1)
        g["b"] = d_into.sum(axis=(0, 2))[:, None, :]
        d_both = d_into @ p["w"][None, :, :EMBED].transpose(0, 1, 3, 2)
        d_x = d_both[:, 0].transpose(1, 0, 2) + d_both[::-1, 1].transpose(1, 0, 2)
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], x, d_x)
        return float(log_z.sum() - gold) / n, g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> list[float]:
        """Adam over shuffled batches; the mean loss of every epoch."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step, losses = 0, []
        total = epochs * -(-len(x) // BATCH)
        for _ in range(epochs):
            order, seen = r.permutation(len(x)), []
            for i in range(0, len(x), BATCH):
                part = order[i : i + BATCH]
                loss, g = self.gradients(x[part], y[part])
                seen.append(loss)
                step += 1
                norm = np.sqrt(sum(float((d**2).sum()) for d in g.values()))
                rate = RATE * (1 - 0.95 * step / (total + 1))
                for k, d in g.items():
                    d = d * min(1.0, 5.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.99 * v[k] + 0.01 * d**2
                    self.p[k] = self.p[k] - (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(seen)))
        return losses

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags (windows, characters), and how far each one's score is above "none"."""
        e, _ = self.emissions(x)
        n, t = x.shape
        trans = self.p["next"]
        back = np.empty((t, n, N_TAGS), dtype=np.int8)
        s = e[:, 0]
        for i in range(1, t):
            way = s[:, :, None] + trans
            back[i] = way.argmax(axis=1)
            s = way.max(axis=1) + e[:, i]
        tags = np.empty((n, t), dtype=np.int64)
        tags[:, -1] = s.argmax(axis=1)
        for i in range(t - 1, 0, -1):
            tags[:, i - 1] = back[i][np.arange(n), tags[:, i]]
        return tags, np.take_along_axis(e, tags[:, :, None], axis=2)[:, :, 0] - e[:, :, 0]


def stretches(text: str, seed: int, most: int = PER_TEXT) -> tuple[list[tuple[int, str]], list[str]]:
    """Found spans, with their kinds, and stretches without any, of a whole text: at most so many of each, drawn over its length."""
    r = np.random.default_rng(seed & (1 << 62) - 1)
    spans = base_spans(text)
    named = [(k, text[s:e]) for s, e, k in spans if e - s <= 60]
    named = [named[i] for i in sorted(r.permutation(len(named))[:most].tolist())]
    taken = np.zeros(max(1, -(-len(text) // TRAIN_WIDTH)) + 1, dtype=bool)  # windows a span reaches into
    for s, e, _ in spans:
        taken[s // TRAIN_WIDTH : (e - 1) // TRAIN_WIDTH + 1] = True
    free = np.flatnonzero(~taken[:-1])
    chosen = np.sort(r.permutation(free)[:most]) * TRAIN_WIDTH
    return named, [text[i : i + TRAIN_WIDTH] for i in chosen.tolist()]


def training_windows(found: list[tuple[list[tuple[int, str]], list[str]]], n: int = TRAIN_WINDOWS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of windows made of stretches without spans and of found spans with new digits."""
    r = np.random.default_rng(seed)
    pool: dict[int, list[str]] = {k: [] for k in range(len(KINDS))}
    plain, other = [], []
    for named, pieces in found:
        for k, s in named:
            pool[k].append(s)
        for piece in pieces:
            if not re.search("[0-9@]", piece):
                plain.append(piece)
            elif not any(p.search(piece) for p in (IP, PHONE)) and "@" not in piece and not re.search("[0-9]{14}", piece):
                other.append(piece)
    kinds = [k for k in pool if pool[k]]
    if not kinds or not plain:
        return np.empty((0, TRAIN_WIDTH), dtype=np.int64), np.empty((0, TRAIN_WIDTH), dtype=np.int64)

    def drawn(k: int) -> str:
        s = pool[k][int(r.integers(len(pool[k])))]
        if k == 1:
            return ".".join(str(int(r.integers(1, 256))) for _ in range(4))
        return "".join(str(int(r.integers(10))) if c.isdigit() and i > 1 else c for i, c in enumerate(s))

    xs, ys = [], []
    for i in range(n):
        base = plain[int(r.integers(len(plain)))]
        if other and i % 4 == 0:
            base = other[int(r.integers(len(other)))]
            xs.append(base)
            ys.append([(0, len(base), -1)])
            continue
        cut = int(r.integers(0, max(1, min(len(base), 50))))
        if r.random() < 0.6:  # between words
            cut = base.rfind(" ", 0, cut + 1) + 1
        made, tags = base[:cut], [(0, cut, -1)]
        for j in range(int(r.integers(1, 4))):
            if j:
                gap = " " if r.random() < 0.75 else (", ", ". ", "; ", "\n")[int(r.integers(4))]
                made += gap
            k = kinds[int(r.integers(len(kinds)))]
            s = drawn(k)
            tags.append((len(made), len(made) + len(s), k))
            made += s
        made += (" ", ". ", ", ", "\n", "")[int(r.integers(5))] + base[cut:].lstrip()
        if len(made) > TRAIN_WIDTH and r.random() < 0.5:
            shift = int(r.integers(0, min(cut + 1, len(made) - TRAIN_WIDTH + 1)))
            made, tags = made[shift:], [(max(0, s - shift), e - shift, k) for s, e, k in tags]
        xs.append(made)
        ys.append(tags)
    x = np.full((n, TRAIN_WIDTH), _POLICY[32], dtype=np.int64)
    y = np.zeros((n, TRAIN_WIDTH), dtype=np.int64)
    for i, (s, tags) in enumerate(zip(xs, ys, strict=True)):
        c = codes(s[:TRAIN_WIDTH])
        x[i, : len(c)] = c
        for a, b, k in tags:
            if k >= 0 and a < TRAIN_WIDTH:
                y[i, a:b] = 2 + 2 * k
                y[i, a] = 1 + 2 * k
    return x, y


def train(docs: DataFrame, limit: int = MAX_TRAIN) -> Tagger | None:
    """A tagger trained on spans and stretches of at most `limit` different whole texts that hold a digit or "@", those of the smallest hashes."""
    some = docs.where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("h"), "text")
    hashes = [r["h"] for r in some.select("h").distinct().orderBy("h").limit(limit).collect()]
    last = hashes[-1] if hashes else 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text"), strict=True):
                if h not in seen:
                    seen.add(h)  # at most `limit`
                    named, pieces = stretches(text.as_py(), h)
                    columns = [pa.array([x]) for x in ([k for k, _ in named], [s for _, s in named], pieces)]
                    types = [pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.string())]
                    yield pa.RecordBatch.from_arrays([pa.array([h]), *(c.cast(t) for c, t in zip(columns, types, strict=True))], ["h", "kinds", "spans", "pieces"])

    drawn = map_arrow(some.where(F.col("h") <= last), work, "h long, kinds array<int>, spans array<string>, pieces array<string>")
    rows = sorted({r["h"]: r for r in drawn.dropDuplicates(["h"]).collect()}.items())  # at most `limit` rows of PER_TEXT short strings
    x, y = training_windows([(list(zip(r["kinds"], r["spans"], strict=True)), r["pieces"]) for _, r in rows])
    if not len(x):
        return None
    tagger = Tagger()
    tagger.fit(x, y)
    return tagger


def _window_spans(tags: np.ndarray, margin: np.ndarray, start: int, size: int, cut_left: bool, cut_right: bool) -> list[tuple[float, int, int, int, bool, bool]]:
    """score, start, end, kind of each run of tags, and whether the window's left or right edge cuts it off."""
    out, i = [], 0
    on = np.flatnonzero(tags[:size])
    while len(on):
        i = int(on[0])
        kind, j = (int(tags[i]) - 1) // 2, i + 1
        while j < size and tags[j] == 2 + 2 * kind:
            j += 1
        out.append((float(margin[i:j].sum()), start + i, start + j, kind, cut_left and i == 0, cut_right and j == size))
        on = on[on >= j]
    return out


def joined(found: list[tuple[float, int, int, int, bool, bool]]) -> list[tuple[float, int, int, int]]:
    """Whole spans, and those put together of pieces that the edges of neighbouring windows cut off.

    A span of at most the windows' overlap is whole in one of them, and its pieces give way to it.
    """
    out = [(v, s, e, k) for v, s, e, k, left, right in found if not left and not right]
    kept: tuple[float, int, int, int] | None = None
    for v, s, e, k, left, right in sorted((f for f in found if f[4] or f[5]), key=lambda f: (f[1], f[2])):
        fits = left and kept is not None and kept[3] == k and s <= kept[2]
        if not left:
            kept = (v, s, e, k) if right else kept
        elif fits:
            kept = (kept[0] + v, kept[1], max(e, kept[2]), k)
            if not right:
                if kept[2] - kept[1] > STRIDE:
                    out.append(kept)
                kept = None
    return out


def reconciled(found: list[tuple[float, int, int, int]]) -> list[Span]:
    """Of spans from all windows of a text, the set without overlaps that has the highest total score."""
    best: dict[tuple[int, int, int], float] = {}
    for score, s, e, k in found:
        best[(s, e, k)] = max(score, best.get((s, e, k), 0.0))
    items = sorted(best, key=lambda x: (x[1], x[0], x[2]))
    ends = [e for _, e, _ in items]
    value, take = [0.0], []
    for i, (s, e, k) in enumerate(items):
        j = int(np.searchsorted(ends[:i], s, side="right"))
        gain = value[j] + max(best[(s, e, k)], 1e-9)
        take.append((gain > value[i], j))
        value.append(max(gain, value[i]))
    out, i = [], len(items)
    while i:
        chosen, j = take[i - 1]
        if chosen:
            out.append(items[i - 1])
        i = j if chosen else i - 1
    return out[::-1]


def tag(texts: list[str], tagger: Tagger, batch: int = 128) -> list[list[Span]]:
    """The network's spans of every text, reconciled, before any check."""
    windows = []
    for d, text in enumerate(texts):
        c = codes(text)
        hot = np.concatenate([[0], np.cumsum(((c >= 16) & (c <= 25)) | (c == 32))])
        for start in range(0, max(1, len(c) - WIDTH + STRIDE), STRIDE):
            end = min(start + WIDTH, len(c))
            if hot[end] > hot[start]:
                windows.append((d, start, c[start:end], start > 0, end < len(c)))
    found: list[list[tuple[float, int, int, int, bool, bool]]] = [[] for _ in texts]
    for i in range(0, len(windows), batch):
        part = windows[i : i + batch]
        x = np.full((len(part), max(len(w[2]) for w in part)), _POLICY[32], dtype=np.int64)
        for k, w in enumerate(part):
            x[k, : len(w[2])] = w[2]
        tags, margin = tagger.decode(x)
        for k, (d, start, c, left, right) in enumerate(part):
            found[d] += _window_spans(tags[k], margin[k], start, len(c), left, right)
    return [reconciled(joined(f)) for f in found]


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of every text."""
    base = [base_spans(t) for t in texts]
    added = tag(texts, tagger) if tagger else [[] for _ in texts]
    out = []
    for text, fixed, more in zip(texts, base, added, strict=True):
        taken = sorted((s, e) for s, e, _ in fixed)
        more = [(e - len(text[s:e].lstrip()), s + len(text[s:e].rstrip()), k) for s, e, k in more]
        extra = [(s, e, k) for s, e, k in more if whole(k, text[s:e]) and not any(s < b and a < e for a, b in taken)]
        out.append((fixed, sorted(fixed + extra, key=lambda s: (s[0], s[2], s[1]))))
    return out


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span (spans that overlap as one) replaced by the kind in brackets."""
    out, at = [], 0
    for s, e, k in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


_HOT = np.zeros(256, dtype=bool)
_HOT[48:58] = _HOT[64] = True


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, list[str]]]:
    """Rows from and to, the places of texts that hold a digit or "@", and these texts."""
    for i, j, buf, offsets in tx.groups(column):
        hot = np.flatnonzero(tx.per_doc(_HOT[buf], offsets))
        yield i, j, hot, [buf[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", "replace") for d in hot.tolist()]


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """doc_id, counts of base spans by kind, their digest, and all spans as text."""
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hot, texts in _texts(batch.column("text")):
                counts = np.zeros((len(KINDS), j - i), dtype=np.int64)
                digest = np.full(j - i, hashlib.sha256(b"").hexdigest(), dtype=object)
                spans = np.full(j - i, "", dtype=object)
                for d, (base, every) in zip(hot.tolist(), all_spans(texts, tagger), strict=True):
                    for _, _, k in base:
                        counts[k, d] += 1
                    digest[d] = hashlib.sha256(shown(base).encode()).hexdigest()
                    spans[d] = shown(every)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *map(pa.array, counts), pa.array(digest, pa.string()), pa.array(spans, pa.string())], names)

    return map_arrow(docs.select("doc_id", "text"), work, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """The documents with all spans replaced, and n_chars counted anew where there is such a column."""
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hot, texts in _texts(batch.column("text")):
                columns = {c: batch.column(c).slice(i, j - i) for c in names}
                if len(hot):
                    new = columns["text"].to_pylist()
                    n_chars = columns["n_chars"].to_pylist() if "n_chars" in names else None
                    for d, text, (_, every) in zip(hot.tolist(), texts, all_spans(texts, tagger), strict=True):
                        if every:
                            new[d] = redacted(text, every)
                            if n_chars is not None:
                                n_chars[d] = len(new[d])
                    columns["text"] = pa.array(new, pa.string())
                    if n_chars is not None:
                        columns["n_chars"] = pa.array(n_chars, columns["n_chars"].type)
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return map_arrow(docs, work, T.StructType(docs.schema.fields))

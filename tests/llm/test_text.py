import re

import numpy as np
import pyarrow as pa
from hypothesis import example, given, settings
from hypothesis import strategies as st

from pathloom.llm import text as tx
from pathloom.llm.bpe import Encoder
from pathloom.llm.quality_rules import measure

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet="aAbB #*é\n\t日 \x1c-", max_size=60), min_size=1, max_size=6)


def group(texts):
    return next(tx.groups(pa.array(texts), 1 << 40))[2:]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    buf, offsets = group(texts)
    words = tx.Words(buf, offsets)
    found = [buf[s:e].tobytes().decode() for s, e in zip(words.starts, words.ends)]
    assert found == [w for t in texts for w in WORD.findall(t)]
    assert words.counts.tolist() == [len(WORD.findall(t)) for t in texts]
    hashes = words.hashes(lower=True)
    plain = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]
    assert len(set(zip(plain, hashes.tolist()))) == len(set(plain)) == len(set(hashes.tolist()))


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    buf, offsets = group(["a bb ccc " * 50, "x" * 500, "a bb ccc"])
    whole = tx.Words(buf, offsets).hashes(lower=False)
    monkeypatch.setattr(tx, "_BLOCK", 16)
    assert (tx.Words(buf, offsets).hashes(lower=False) == whole).all()


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_measures(texts):
    got = measure(*group(texts))
    for i, t in enumerate(texts):
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        cover = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(8)}
        expected = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(cover))
        assert tuple(int(got[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")) == expected


def test_repeated_windows():
    w = "a b c d e f g h"
    got = measure(*group([f"{w} {w} x", w, "q " * 9]))
    assert got["n_repeat_words"].tolist() == [16, 0, 9]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(alphabet=" \n\tab'1é.  ", max_size=40), min_size=1, max_size=5))
def test_bpe_ids_are_those_of_the_library(encoders, texts):
    ours, theirs = encoders
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, counts = ours.encode(*group(texts))
    cut = np.concatenate([[0], np.cumsum(counts)])
    assert [ids[a:b].tolist() for a, b in zip(cut[:-1], cut[1:])] == [theirs.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "a", " ", " b", "\n", "é\xa0", "1"]), max_size=9).map("".join), min_size=1, max_size=5))
@example(["a <|endoftext|> b"])
@example(["", "<|endoftext|>", "", "x<|endof", "text|>y", "<|endoftext|><|endoftext|>", "a <|endoftext|>", "<|endoftext|> a"])
def test_added_tokens_are_those_of_the_library(unchanged, texts):
    ours, theirs = unchanged
    ids, counts = ours.encode(*group(texts))
    cut = np.concatenate([[0], np.cumsum(counts)])
    assert [ids[a:b].tolist() for a, b in zip(cut[:-1], cut[1:])] == [theirs.encode(t, add_special_tokens=False).ids for t in texts]


import public_tokenizers  # noqa: E402
import pytest  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402


@pytest.fixture(scope="module")
def encoders():
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    theirs.encode_special_tokens = True
    return Encoder(), theirs


@pytest.fixture(scope="module")
def unchanged():
    return Encoder(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

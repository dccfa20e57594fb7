"""The numpy kernel of words and windows."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sparkmine.llm.words import Words, chunks

TEXTS = ["one two  three", None, "", " \t\n", "one", "two three one two three", "é\x0bü x", "end\n", "\x00 a\x00 a b"]


def by_hand(texts):
    return [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_words(limit):
    got = []
    for first, last, w in chunks(pa.array(TEXTS), limit):
        raw = w.data.tobytes()
        got += [[raw[s:e].decode() for s, e in zip(w.starts[a:b], w.ends[a:b])] for a, b in zip(w.bounds, w.bounds[1:])]
        assert last - first == len(w.bounds) - 1
    assert got == by_hand(TEXTS)


@pytest.mark.parametrize("type_", [pa.string(), pa.large_string()])
def test_equal_windows_have_equal_hashes_and_others_do_not(type_):
    random.seed(3)
    texts = [" ".join(random.choices("abc", k=random.randint(0, 30))) for _ in range(200)]
    seen: dict[tuple, int] = {}
    for k in (1, 2, 5):
        for limit in (1, 300):
            for first, _, w in chunks(pa.array(texts, type_), limit):
                starts, hashes = w.windows(k)
                text = np.searchsorted(w.bounds, starts, "right") - 1
                for s, t, h in zip(starts, text, hashes.tolist()):
                    words = texts[first + t].split()[s - w.bounds[t] : s - w.bounds[t] + k]
                    assert len(words) == k
                    assert seen.setdefault(tuple(words), h) == h
    assert len(set(seen.values())) == len(seen)


def test_sliced_array():
    whole = pa.array(["a b", "c d e", "f"])
    assert [len(w) for _, _, w in chunks(whole.slice(1, 2))] == [4]
    assert list(chunks(pa.array([], pa.string()))) == []


def test_long_patterns_have_hashes_of_their_own():
    """Words of 1,024 letters in the order for which every polynomial modulo 2^64 is
    the same, and with a blank between the letters, as windows."""
    order = [bin(i).count("1") % 2 for i in range(2048)]
    one, other = ("".join("ab"[b ^ flip] for b in order) for flip in (0, 1))
    raw = f"{one} {other} {one}".encode()
    held = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert held.hashes[0] == held.hashes[2] != held.hashes[1]
    raw = " ".join(one[:1024] + "x" * k for k in range(3)).encode()
    assert len(set(Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).hashes.tolist())) == 3

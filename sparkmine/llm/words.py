"""Words and word windows of many texts at once, as numpy arrays.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return. A short word's hash is a polynomial of its bytes modulo
2^64, a window's one of its words' hashes; both are read off running sums, so
a window costs the same whatever its length. Such a polynomial is zero for some
patterns of 1,024 terms and more, so words from ``LONG_WORD`` bytes on have the
XXH3 hash of their bytes; windows are short. Equal words have equal hashes, and
ordinary different ones differ but for a chance of about 2^-64 a pair; against
words that are worked out to collide no fixed hash of 64 bits is proof.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 1 << 20  # texts are taken together up to this many bytes
LONG_WORD = 128

# Odd multipliers of the polynomials and of the finishing steps.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False


_known_powers: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    if len(_known_powers.get(base, ())) < size:
        out = np.full(1 << max(16, (size - 1).bit_length()), base, np.uint64)
        out[0] = 1
        _known_powers[base] = np.multiply.accumulate(out)
    return _known_powers[base]


def _range_sums(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values[i] * base^(i - start)`` over each range, modulo 2^64."""
    size = len(values) + 1
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, size)[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * _powers(pow(base, -1, 1 << 64), size)[starts]


def mix(x: np.ndarray) -> np.ndarray:
    for by, shift in zip(MIX, (30, 27)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of consecutive texts. Word ``i`` lies at ``data[starts[i]:
    ends[i]]``; text ``t`` has the words ``bounds[t]`` to ``bounds[t + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = _IN_WORD[data]
        begin = inside[1:] & ~inside[:-1]
        stop = ~inside[1:] & inside[:-1]
        # A text ends a word even where no blank follows it.
        cut = offsets[(offsets > 0) & (offsets < len(data))]
        cut = cut[inside[cut] & inside[cut + 1]]
        begin[cut] = True
        stop[cut] = True
        self.data, self.offsets = data, offsets
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(stop)
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hashes = mix(_range_sums(data.astype(np.uint64) + np.uint64(1), BYTE_BASE, self.starts, self.ends))
        for i in np.flatnonzero(self.ends - self.starts >= LONG_WORD).tolist():
            self.hashes[i] = xxhash.xxh3_64_intdigest(data[self.starts[i] : self.ends[i]].tobytes())

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of runs of words."""
        return mix(_range_sums(self.hashes, WORD_BASE, starts, ends) + (ends - starts).astype(np.uint64))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every window of ``k`` words of one text."""
        n = np.maximum(self.counts - k + 1, 0)
        starts = np.arange(int(n.sum())) + np.repeat(self.bounds[:-1] - (np.cumsum(n) - n), n)
        return starts, self.spans(starts, starts + k)

    def kept(self, keep: np.ndarray) -> bytes:
        """The chosen words, joined by one blank."""
        raw = self.data.tobytes()
        return b" ".join([raw[s:e] for s, e in zip(self.starts[keep].tolist(), self.ends[keep].tolist())])


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """``(first, last, words)`` of consecutive texts, ``limit`` bytes or one
    text at a time. A null text has no words."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, Words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last

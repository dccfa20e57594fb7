"""Documents that hold benchmark items, also paraphrased or edited ones.

The test items are the stated query set: they are taken in blocks of bounded
size, each block goes to all executors, and every block meets every document.
For each block:

1. Words are lower-case ASCII, ASCII punctuation read as blank. Two item words
   that are neighbours or have one word between them are a pair; a document
   holds it if the two words, in order, are neighbours there or have one word
   between them. One pass over the whole corpus counts the documents that hold
   each pair.
2. An item's seeds are the pairs that begin at its rarest places, as many places
   as ``seed_places`` says. Counts choose the places, not how many there are, so
   whatever the corpus holds, no passage can be without seeds.
3. A second pass finds seeds in documents. Around every hit lies the passage
   where the item would stand, with room for as many insertions as the score
   allows; overlapping passages of one item are one. Passages with enough seeds
   and words of the item are aligned with it by Smith-Waterman (match +2,
   mismatch and gap -1), and the score is divided by that of a whole exact
   copy. From ``MIN_SCORE`` = 0.5 on the document is contaminated.

Why no such passage is missed: let ``M`` of ``m`` item words match, with ``X``
mismatches and gaps, so ``2 M - X >= m`` and ``X <= m``. Of the ``M - 1`` steps from
one match to the next let ``a`` have no error, ``b`` one and ``c`` more: ``b + 2 c <= X``,
hence ``2 a + b >= m - 2``. The steps with at most one error are pairs, so pairs
begin at ``a + b >= (m - 2) / 2`` of the item's ``m - 1`` places.

Defined results: null text holds nothing; an item with fewer than ``N`` = 3 words
has no seed and matches nothing; repeated items and documents are reported one
by one; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.words import WORD_BASE, Words, chunks, mix

N = 3
SHARE = 4  # one in so many of the pairs that a passage must hold is asked of its seeds
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
BLOCK_WORDS = 500_000  # item words in one block; about 30 MB of arrays
FILTER_BITS = 20

# A-Z to a-z, ASCII punctuation to blank.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[65:91] += 32
PLAIN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 32

MATCHES = "doc_id long, item_id long, score double, first_word long, last_word long"


def plain_chunks(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    for first, last, words in chunks(texts):
        yield first, last, Words(PLAIN[words.data], words.offsets)


def pairs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every two words of one text that are neighbours
    or have one word between them."""
    starts, hashes = [], []
    for step in (1, 2):
        n = np.maximum(words.counts - step, 0)
        start = np.arange(int(n.sum())) + np.repeat(words.bounds[:-1] - (np.cumsum(n) - n), n)
        starts.append(start)
        hashes.append(mix(words.hashes[start] * np.uint64(WORD_BASE) + words.hashes[start + step]))
    return np.concatenate(starts), np.concatenate(hashes)


def seed_places(size: int) -> tuple[int, int]:
    """Places of an item of ``size`` words whose pairs are seeds, and at how many
    of them every passage from ``MIN_SCORE`` on has one."""
    held = (size - 1) // 2  # (size - 2) / 2, rounded up
    least = max(1, held // SHARE)
    return size - 1 - held + least, least


@dataclass
class Block:
    """Items and their pairs. Place ``i`` says that pair ``grams[gram[i]]``
    starts at word ``offset[i]`` of item ``item[i]``; ``places`` are sorted by
    pair and ``first[g]`` is the first place of pair ``g``."""

    ids: list
    words: list[np.ndarray]
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(ids: list, words: list[np.ndarray], places: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Block:
        none = np.empty(0, np.int64)
        gram = np.concatenate([p[0] for p in places]) if places else none.astype(np.uint64)
        item = np.concatenate([p[1] for p in places]) if places else none
        offset = np.concatenate([p[2] for p in places]) if places else none
        order = np.argsort(gram, kind="stable")
        grams, first = np.unique(gram[order], return_index=True)
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[grams & np.uint64((1 << FILTER_BITS) - 1)] = True
        return Block(ids, words, grams, np.append(first, len(order)), item[order], offset[order], bits)

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and pair number of every pair of the block."""
        starts, grams = pairs(words)
        likely = np.flatnonzero(self.bits[grams & np.uint64((1 << FILTER_BITS) - 1)])
        at = np.searchsorted(self.grams, grams[likely])
        found = at < len(self.grams)
        found[found] = self.grams[at[found]] == grams[likely][found]
        return starts[likely[found]], at[found]

    def rarest(self, documents: np.ndarray) -> Block:
        """The block with the pairs at each item's rarest places only."""
        number = np.repeat(np.arange(len(self.grams)), np.diff(self.first))
        keep = np.zeros(len(number), bool)
        order = np.argsort(self.item, kind="stable")
        for places in np.split(order, np.flatnonzero(np.diff(self.item[order])) + 1):
            if len(places):
                size = len(self.words[self.item[places[0]]])
                seen = np.bincount(self.offset[places], documents[number[places]], size - 1)
                chosen = np.zeros(size - 1, bool)
                chosen[np.argsort(seen, kind="stable")[: seed_places(size)[0]]] = True
                keep[places] = chosen[self.offset[places]]
        gram = self.grams[number]
        return Block.of(self.ids, self.words, [(gram[keep], self.item[keep], self.offset[keep])])


def blocks(items: DataFrame) -> Iterator[Block]:
    """The items in blocks of bounded size; the driver holds one block."""
    ids, words, places, size = [], [], [], 0
    for row in items.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        for _, _, held in plain_chunks(pa.array([row["text"]], pa.string())):
            start, gram = pairs(held) if len(held) >= N else (np.empty(0, np.int64), np.empty(0, np.uint64))
            places.append((gram, np.full(len(gram), len(ids)), start))
            ids.append(row["item_id"])
            words.append(held.hashes)
            size += len(held)
        if size >= BLOCK_WORDS:
            yield Block.of(ids, words, places)
            ids, words, places, size = [], [], [], 0
    if ids:
        yield Block.of(ids, words, places)


def _document_counts(docs: DataFrame, block: Block) -> np.ndarray:
    """Documents that hold each pair of the block, over the whole corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        total = np.zeros(len(held.grams), np.int64)
        for batch in batches:
            for _, _, words in plain_chunks(batch.column("text")):
                start, gram = held.hits(words)
                doc = np.searchsorted(words.bounds, start, "right") - 1
                total += np.bincount(np.unique(doc * len(total) + gram) % max(1, len(total)), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.record_batch({"gram": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})

    out = np.zeros(len(block.grams), np.int64)
    for row in docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[row["gram"]] = row["n"]  # one row per pair of the block at most
    return out


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score and the last matched word of item and passage."""
    ramp = np.arange(len(passage), dtype=np.int32) * -GAP
    above = np.zeros(len(passage) + 1, np.int32)
    best = (0, -1, -1)
    for i, word in enumerate(item):
        cell = above[:-1] + np.where(passage == word, MATCH, MISMATCH).astype(np.int32)
        np.maximum(cell, above[1:] + GAP, out=cell)
        np.maximum(cell, 0, out=cell)
        # A run of gaps along the passage costs GAP a step.
        cell = np.maximum.accumulate(cell + ramp) - ramp
        at = int(cell.argmax())
        if cell[at] > best[0]:
            best = (int(cell[at]), i, at)
        above[1:] = cell
    return best


def _matches(words: Words, block: Block) -> list[tuple[int, int, float, int, int]]:
    """``(text, item, score, first word, last word)`` of contaminated texts."""
    start, gram = block.hits(words)
    if not len(start):
        return []
    n = block.first[gram + 1] - block.first[gram]
    place = np.repeat(block.first[gram], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start, item = np.repeat(start, n), block.item[place]
    text = np.searchsorted(words.bounds, start, "right") - 1
    begin = start - block.offset[place]
    order = np.lexsort((begin, item, text))
    text, item, begin, offset = text[order], item[order], begin[order], block.offset[place][order]
    size = np.array([len(w) for w in block.words])
    # A hit's passage has room for as many insertions as the item has words, on both sides.
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > 3 * size[item[1:]])
    region = np.cumsum(new) - 1
    first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(new)) - 1
    longest = int(size.max())
    held = np.bincount(np.unique(region * longest + offset) // longest, minlength=len(first))
    least = np.array([seed_places(n)[1] for n in size.tolist()])
    enough = np.flatnonzero(held >= least[item[first]])
    first, last = first[enough], last[enough]
    room = size[item[first]]
    regions = zip(text[first].tolist(), item[first].tolist(), (begin[first] - room).tolist(), (begin[last] + 2 * room).tolist())
    out: dict[tuple[int, int], tuple[float, int, int]] = {}
    for t, j, lo, hi in regions:
        lo, hi = max(lo, int(words.bounds[t])), min(hi, int(words.bounds[t + 1]))
        asked, passage = block.words[j], words.hashes[lo:hi]
        if 2 * np.isin(asked, passage).sum() < len(asked):
            continue
        score, last_item, last = align(asked, passage)
        share = score / (MATCH * len(asked))
        if share >= MIN_SCORE and share > out.get((t, j), (0.0,))[0]:
            _, _, back = align(asked[: last_item + 1][::-1], passage[: last + 1][::-1])
            at = lo - int(words.bounds[t])
            out[t, j] = (share, at + last - back, at + last)
    return [(t, j, *found) for (t, j), found in out.items()]


def _seeded(docs: DataFrame, items: DataFrame) -> Iterator:
    for block in blocks(items):
        if len(block.grams):
            yield docs.sparkSession.sparkContext.broadcast(block.rarest(_document_counts(docs, block)))


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word``: the contaminated
    documents with each item they hold, best passage first and last word
    (numbered from 0 among the normalised words)."""
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = docs.sparkSession.createDataFrame([], MATCHES)
    for shared in _seeded(asked, items):

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                ids = batch.column("doc_id")
                for first, _, words in plain_chunks(batch.column("text")):
                    rows = _matches(words, block)
                    yield pa.record_batch({
                        "doc_id": ids.take(pa.array([first + r[0] for r in rows], pa.int64())),
                        "item_id": pa.array([block.ids[r[1]] for r in rows], pa.int64()),
                        "score": pa.array([r[2] for r in rows], pa.float64()),
                        "first_word": pa.array([r[3] for r in rows], pa.int64()),
                        "last_word": pa.array([r[4] for r in rows], pa.int64()),
                    })

        found = found.union(asked.mapInArrow(search, MATCHES))
    return found


def without(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    for shared in list(_seeded(docs.select(F.col("text").cast("string").alias("text")), items)):

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, _, words in plain_chunks(batch.column("text").cast(pa.string())):
                    for row in _matches(words, shared.value):
                        keep[first + row[0]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs

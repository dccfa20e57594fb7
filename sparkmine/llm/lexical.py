"""Ranked lexical search: the best documents for each item of a query set.

Terms are runs of letters and digits of ASCII and of characters beyond it; A-Z is
read as a-z. The score of a document is a sum over the item's terms of a weight
by rarity times a saturating share of the term's count, in whole numbers.

The items are the stated query set, taken in blocks of bounded size. For each
block:

1. One pass over all documents restricts each to the terms of the block: term
   numbers and counts, and how many terms the text has in all. This table is
   written; the texts are read no more. Number of documents, their terms, and the
   documents that hold each term are aggregates over it.
2. Every task reads restricted documents up to ``ENTRIES`` counts and lays them out
   as FP-trees: terms ordered by frequency, the rarest first, so that documents
   with equal beginnings share a path. There is one tree for each band of ``m``
   (``m`` grows with the length), since lengths decide how high a score can get.
   A node knows the largest count of its term among the documents below it, the
   largest count of all terms further down, and the smallest ``m``.
3. Per item, depth-first branch-and-bound: the bound of a node is what the path
   gives with the node's maxima and the smallest ``m``, plus what the item's
   commoner terms could give below. The child with the highest bound goes first,
   and a subtree goes as soon as its bound is below the score of the item's k-th
   document so far; equal bounds are followed, since a smaller id wins a tie.
   Subtrees of up to ``LEAF`` documents are scored by document, those with the
   highest bounds first and several at a time.
4. The tasks' best ``k`` per item meet in a ranking that Spark cuts to ``k`` rows
   before the exchange. Their table is written and the block released before the
   next block is taken.

Defined results: null text has no term, and a document without a term counts
nowhere; a null item text or an item without known terms has no result; rows that
repeat an id are ranked one by one, a null id before all others of its score;
items that repeat an id are ranked as separate items under one id; empty tables
give an empty result; further columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.tables import prepare
from sparkmine.plans.skew import top_k
from sparkmine.plans.workspace import materialize

BLOCK_TERMS = 500_000  # item terms, with repeats, in one block
ENTRIES = 1 << 21  # counts of restricted documents that one set of trees holds
LEAF = 32
MOST_AT_ONCE = 1024  # documents of small subtrees scored together
BANDS = 8  # bands of m per doubling

# Bytes that end a term become blanks, A-Z become a-z.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
RANKED = "item long, doc_id long, score long"


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(PLAIN).split()


def share(count, m):
    """Saturating share of a count, in units of 1e-6; works on numbers and arrays."""
    return 1_000_000_000 * count // (1000 * count + 12 * m)


@dataclass
class Block:
    """Items by number: their ids and, as arrays, their distinct terms and how often
    each occurs; ``vocabulary`` numbers the terms of all items."""

    ids: list[int | None]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    vocabulary: dict[bytes, int]


def blocks(items: DataFrame) -> Iterator[Block]:
    """The items in blocks of bounded size; the driver holds one block."""
    block, size = Block([], [], [], {}), 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string").cast("binary")).toLocalIterator():
        held = terms_of(row[1] and bytes(row[1]))
        counts = Counter(block.vocabulary.setdefault(t, len(block.vocabulary)) for t in held)
        block.ids.append(row[0])
        block.terms.append(np.fromiter(counts.keys(), np.int64, len(counts)))
        block.repeats.append(np.fromiter(counts.values(), np.int64, len(counts)))
        size += len(held)
        if size >= BLOCK_TERMS:
            yield block
            block, size = Block([], [], [], {}), 0
    if block.ids:
        yield block


def restricted(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, terms, counts``: per document with a term, the number of its
    terms, and those of the broadcast vocabulary with their counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            keep, sizes, terms, counts = [], [], [], []
            for at, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                held = terms_of(text)
                if not held:
                    continue
                seen = Counter(map(number.get, held))
                seen.pop(None, None)
                keep.append(at)
                sizes.append(len(held))
                terms.append(list(seen.keys()))
                counts.append(list(seen.values()))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(keep, pa.int64())),
                "n": pa.array(sizes, pa.int64()),
                "terms": pa.array(terms, pa.list_(pa.int32())),
                "counts": pa.array(counts, pa.list_(pa.int32())),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, VECTORS)


@dataclass
class Ranking:
    """What a task needs to rank: totals of the corpus, and the block's items with
    their terms by place in the order of the trees (rarest first) and weights."""

    n_docs: int
    n_terms: int
    place: np.ndarray
    terms: list[np.ndarray]
    weights: list[np.ndarray]

    @staticmethod
    def of(block: Block, n_docs: int, n_terms: int, df: np.ndarray) -> Ranking:
        place = np.empty(len(df), np.int64)
        place[np.lexsort((np.arange(len(df)), df))] = np.arange(len(df))
        rarity = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        terms, weights = [], []
        for t, r in zip(block.terms, block.repeats):
            t, r = t[df[t] > 0], r[df[t] > 0]
            order = np.argsort(place[t])
            terms.append(place[t][order])
            weights.append((rarity[t] * r)[order])
        return Ranking(n_docs, n_terms, place, terms, weights)

    def m(self, n: np.ndarray) -> np.ndarray:
        wide = int(n.max(initial=0)) * 25 * self.n_docs >= 1 << 62
        n = n.astype(object) if wide else n
        return (100 - 25 + 25 * n * self.n_docs // max(1, self.n_terms)).astype(np.int64)


class Tree:
    """An FP-tree of documents, given as ``first`` entry, and per entry the place of
    the term and its count, by place within a document. Nodes are laid out level by
    level, so that the children of a node follow one another."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, sizes: np.ndarray, place: np.ndarray, count: np.ndarray):
        first = np.cumsum(sizes) - sizes
        # Documents in the order of their vectors; a vector comes before those it begins.
        keys = [place[s : s + n].astype(">u4").tobytes() for s, n in zip(first.tolist(), sizes.tolist())]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        self.ids, self.m, sizes = ids[order], m[order], sizes[order]
        at = np.repeat(first[order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        self.place, self.count = place[at], count[at]
        self.first = np.append(0, np.cumsum(sizes))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        depth = np.arange(len(doc)) - self.first[doc]
        # The largest count further down the same document.
        below = np.zeros(len(doc), np.int64)
        by_depth = np.argsort(depth, kind="stable")
        levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)
        for level in reversed(levels[:-1]):
            inner = level[level + 1 < self.first[doc[level] + 1]]
            below[inner] = np.maximum(self.count[inner + 1], below[inner + 1])
        # A node is a run of documents with one term at one depth and one node before it.
        node = np.zeros(len(doc), np.int64)
        starts, parents, total = [], [np.empty(0, np.int64)], 0
        for level in levels if len(doc) else []:
            parent = node[level - 1] if total else np.full(len(level), -1)
            new = np.ones(len(level), bool)
            new[1:] = (parent[1:] != parent[:-1]) | (self.place[level][1:] != self.place[level][:-1])
            node[level] = total + np.cumsum(new) - 1
            starts.append(level[new])
            parents.append(parent[new])
            total += int(new.sum())
        entry = np.concatenate(starts) if starts else np.empty(0, np.int64)
        bounds = np.searchsorted(node[by_depth], np.arange(total))
        held = self.m[doc[by_depth]]
        self.term = self.place[entry]
        self.most = np.maximum.reduceat(self.count[by_depth], bounds) if total else entry
        self.deeper = np.maximum.reduceat(below[by_depth], bounds) if total else entry
        self.least_m = np.minimum.reduceat(held, bounds) if total else entry
        self.doc = doc[entry]
        self.n_docs = np.diff(np.append(bounds, len(doc)))
        # Documents that end at a node come first among its documents.
        last = self.first[doc + 1] - 1 == np.arange(len(doc))
        self.ending = np.add.reduceat(last[by_depth].astype(np.int64), bounds) if total else entry
        parent = np.concatenate(parents)
        self.child = np.searchsorted(parent, np.arange(-1, total))  # of node i at i + 1; the root's at 0
        self.child = np.append(self.child, total)
        self.top_m = int(self.m.min(initial=1 << 62))

    def children(self, node: int) -> slice:
        return slice(int(self.child[node + 1]), int(self.child[node + 2]))


class Best:
    """The ``k`` best of one item: highest score, then smallest id, null first."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    @property
    def least(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for at in np.flatnonzero(scores >= self.least).tolist():
            entry = (int(scores[at]), -int(ids[at]))
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


class Search:
    """Branch-and-bound for one item over trees of one task."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, k: int, size: int):
        self.terms, self.weights, self.best = terms, weights, Best(k)
        self.weight = np.zeros(size, np.int64)
        self.weight[terms] = weights
        self.scored = 0

    def bound(self, most: np.ndarray | int, m: int) -> int:
        """Of any document with ``m`` or more and these counts at most."""
        return int((self.weights * share(most, m)).sum())

    def run(self, tree: Tree, most: np.ndarray) -> None:
        """``most``: the largest count of each of the item's terms in the tree."""
        stack = [(0, -1)] if self.bound(most, tree.top_m) >= self.best.least else []
        bounds = [1 << 62] * len(stack)
        while stack:
            path, node = stack.pop()
            if bounds.pop() < self.best.least:
                continue
            if node >= 0:
                doc = int(tree.doc[node])
                self.score(tree, np.arange(doc, doc + int(tree.ending[node])))
            kids = tree.children(node)
            term, m = tree.term[kids], tree.least_m[kids]
            paths = path + self.weight[term] * share(tree.most[kids], m)
            # The item's terms behind a child's own, with the counts possible below it.
            counts = np.minimum(most[None, :], tree.deeper[kids][:, None])
            counts[self.terms[None, :] <= term[:, None]] = 0
            rest = (self.weights * share(counts, m[:, None])).sum(axis=1)
            total = paths + rest
            good = np.flatnonzero(total >= self.best.least)
            good = good[np.argsort(total[good], kind="stable")]
            small = tree.n_docs[kids][good] <= LEAF
            self.leaves(tree, good[small][::-1] + kids.start, total[good[small]][::-1])
            good = good[~small]
            stack += zip(paths[good].tolist(), (good + kids.start).tolist())
            bounds += total[good].tolist()

    def leaves(self, tree: Tree, nodes: np.ndarray, bounds: np.ndarray) -> None:
        """Small subtrees by falling bound, ever more of them at a time, up to the
        first whose bound is below the score to beat."""
        at, some = 0, LEAF
        while at < len(nodes) and bounds[at] >= self.best.least:
            last = max(at + 1, int(np.searchsorted(np.cumsum(tree.n_docs[nodes[at : at + some]]), some, "right")) + at)
            first, n = tree.doc[nodes[at:last]], tree.n_docs[nodes[at:last]]
            self.score(tree, np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum())))
            at, some = last, min(2 * some, MOST_AT_ONCE)

    def score(self, tree: Tree, docs: np.ndarray) -> None:
        if not len(docs):
            return
        self.scored += len(docs)
        first, sizes = tree.first[docs], tree.first[docs + 1] - tree.first[docs]
        doc = np.repeat(np.arange(len(docs)), sizes)
        entry = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(doc))
        weight = self.weight[tree.place[entry]]
        held = np.flatnonzero(weight)
        doc = doc[held]
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, doc, weight[held] * share(tree.count[entry[held]], tree.m[docs[doc]]))
        self.best.offer(scores, tree.ids[docs])


NO_ID = -(1 << 63)  # a null id in the trees; before all others


def _trees(ranking: Ranking, ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> list[Tree]:
    """One tree for each band of ``m``."""
    m, place = ranking.m(n), ranking.place[terms]
    doc = np.repeat(np.arange(len(n)), sizes)
    order = np.lexsort((place, doc))
    place, counts = place[order], counts[order]
    first = np.cumsum(sizes) - sizes
    band = np.floor(np.log2(m) * BANDS).astype(np.int64)
    trees = []
    for b in np.unique(band).tolist():
        docs = np.flatnonzero((band == b) & (sizes > 0))
        at = np.repeat(first[docs] - (np.cumsum(sizes[docs]) - sizes[docs]), sizes[docs]) + np.arange(int(sizes[docs].sum()))
        if len(docs):
            trees.append(Tree(ids[docs], m[docs], sizes[docs], place[at], counts[at]))
    return trees


def ranked_here(ranking: Ranking, k: int, trees: list[Tree]) -> Iterator[tuple[int, int, int]]:
    """``(item, doc_id, score)`` of each item's best documents in the trees."""
    size = len(ranking.place)
    most = np.zeros((len(trees), size), np.int64)
    for row, tree in zip(most, trees):
        np.maximum.at(row, tree.place, tree.count)
    for item, (terms, weights) in enumerate(zip(ranking.terms, ranking.weights)):
        if not len(terms):
            continue
        search = Search(terms, weights, k, size)
        # The band with the highest bound goes first.
        reach = [(search.bound(most[b][terms], tree.top_m), b) for b, tree in enumerate(trees)]
        for _, b in sorted(reach, key=lambda x: (-x[0], x[1])):
            search.run(trees[b], most[b][terms])
        for score, doc in search.best.heap:
            yield item, -doc, score


def _rank_block(vectors: DataFrame, shared, k: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries = [], 0
        for batch in batches:
            # Few documents hold very many terms, so a batch is bounded like a tree.
            held.append(batch)
            entries += len(batch.column("terms").flatten())
            if entries >= ENTRIES:
                yield answered(held)
                held, entries = [], 0
        if held:
            yield answered(held)

    def answered(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        lists = table["terms"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        ids = table["doc_id"].combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)
        n = table["n"].to_numpy()
        terms = lists.flatten().to_numpy().astype(np.int64)
        counts = table["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
        item, doc, score = (list(c) for c in zip(*ranked_here(shared.value, k, _trees(shared.value, ids, n, sizes, terms, counts)))) if len(n) else ([], [], [])
        return pa.record_batch({"item": pa.array(item, pa.int64()), "doc_id": pa.array([None if d == NO_ID else d for d in doc], pa.int64()), "score": pa.array(score, pa.int64())})

    return vectors.mapInArrow(rows, RANKED)


def rank(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` highest-scoring documents
    with a score above 0; equal scores by ascending id."""
    spark = prepare(docs.sparkSession)
    context = spark.sparkContext
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks(items):
        if not block.vocabulary:
            continue
        vocabulary = context.broadcast(block.vocabulary)
        vectors = materialize(restricted(docs, vocabulary), "vectors")
        vocabulary.destroy()
        n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(block.vocabulary), np.int64)
        for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toLocalIterator():
            df[row["term"]] = row["df"]  # one row per term of the block at most
        ranking = context.broadcast(Ranking.of(block, n_docs, n_terms, df))
        best = top_k(_rank_block(vectors, ranking, k), ["item"], [F.desc("score"), F.asc_nulls_first("doc_id")], k)
        names = spark.createDataFrame([(j, i) for j, i in enumerate(block.ids)], "item long, item_id long")
        best = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # the block's items
        out = out.union(materialize(best, "ranked"))
        ranking.destroy()
    return out

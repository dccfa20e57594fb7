"""Removal of long repeated word sequences by De Bruijn compaction.

Windows of ``K`` = 13 consecutive words are the edges of a De Bruijn graph
(their 12-word ends the nodes). Consecutive windows with one minimizer (the
5-word piece of smallest hash among the nine in a window) form a *path*: a
stretch of text that is handled as one row, about one per six windows. Where
two documents share a passage, their paths inside it are the same; only the
paths at its two ends can be cut differently.

1. A minimizer found in one document only cannot lie in a repeated window.
   Grouping by minimizer (smallest and largest document, summed on the map
   side) leaves the repeated ones, and a join leaves their paths.
2. Equal paths are compacted into one, with the smallest document that has it.
3. A minimizer with a single distinct path does not branch: every window of
   the path starts in that smallest document. Where different paths share a
   minimizer, the graph may branch: each distinct path goes back to its source
   document, its windows are hashed, and each window gets the smallest document
   of all paths it lies in.
4. Per document, the paths (or the places in a branching path) that a smaller
   document also has are joined to its text, which yields the words to remove.

The text travels compressed. Only hashes of 64 bits decide equality.

Defined results: null text has no words; documents with equal ids are one
document, none of them smaller than another; a document with a null id is
neither larger nor smaller than any other, so it keeps all its words; an empty
table gives an empty result; columns other than ``doc_id`` and ``text`` are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.words import Words, chunks
from sparkmine.plans.workspace import materialize

K = 13
PIECE = 5


def paths(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window (exclusive) and minimizer of every path."""
    n = np.maximum(words.counts - K + 1, 0)
    if not n.sum():
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64)
    at = np.arange(len(words) - PIECE + 1)
    least, width = words.spans(at, at + PIECE), 1
    while width < K - PIECE + 1:  # smallest of `width` neighbours, doubling
        step = min(width, K - PIECE + 1 - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    text = np.repeat(np.arange(len(n)), n)
    windows = np.arange(len(text)) + np.repeat(words.bounds[:-1] - (np.cumsum(n) - n), n)
    least = least[windows]
    new = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([windows[new[1:] - 1], windows[-1:]]) + 1
    return windows[new], last, least[new]


def _path_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for first, last, words in chunks(batch.column("text")):
            start, end, piece = paths(words)
            if not len(start):
                continue
            path = words.spans(start, end + K - 1)
            doc = ids[first:last][np.searchsorted(words.bounds, start, "right") - 1]
            # A document counts once for a path, however often it has it.
            once = _first_of(doc, path)
            yield pa.record_batch({"piece": pa.array(piece[once].view(np.int64)), "path": pa.array(path[once].view(np.int64)), "doc": pa.array(doc[once])})


def _first_of(doc: np.ndarray, path: np.ndarray) -> np.ndarray:
    order = np.lexsort((path, doc))
    d, p = doc[order], path[order]
    return np.sort(order[np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1])])])


def _packed(docs: DataFrame) -> DataFrame:
    """Documents with their text compressed, for the way through an exchange."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [z.compress(t.encode()) if t else None for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "packed": pa.array(texts, pa.binary())})

    return docs.mapInArrow(pack, "doc_id long, packed binary")


def _unpacked(packed: bytes | None) -> Words:
    raw = zstandard.ZstdDecompressor().decompress(packed) if packed else b""
    return Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the asked paths of a document: ``path, place, window, doc``."""
    for batch in batches:
        for doc, packed, asked in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "paths"))):
            words = _unpacked(packed)
            start, end, _ = paths(words)
            path = words.spans(start, end + K - 1).view(np.int64)
            _, once = np.unique(path, return_index=True)
            once = once[np.isin(path[once], np.array(asked, np.int64))]
            size = end[once] - start[once]
            place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            at = np.repeat(start[once], size) + place
            yield pa.record_batch({
                "path": pa.array(np.repeat(path[once], size)),
                "place": pa.array(place.astype(np.int32)),
                "window": pa.array(words.spans(at, at + K).view(np.int64)),
                "doc": pa.array(np.full(len(at), doc, np.int64)),
            })


def _clean_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the kept words, given ``hits``: paths that repeat an earlier
    document, each with the places of the repeated windows (null: all)."""
    for batch in batches:
        out = []
        for packed, hits in zip(batch.column("packed").to_pylist(), batch.column("hits").to_pylist()):
            if not hits:
                words = (zstandard.ZstdDecompressor().decompress(packed) if packed else b"").split()
                out.append((len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest()))
                continue
            words = _unpacked(packed)
            start, end, _ = paths(words)
            path = words.spans(start, end + K - 1).view(np.int64)
            places = {h["path"]: h["places"] for h in hits}
            windows = [np.arange(s, e) if places[p] is None else s + np.array(places[p]) for s, e, p in zip(start.tolist(), end.tolist(), path.tolist()) if p in places]
            depth = np.zeros(len(words) + 1, np.int64)
            at = np.concatenate(windows) if windows else np.empty(0, np.int64)
            np.add.at(depth, at, 1)
            np.add.at(depth, at + K, -1)
            keep = np.cumsum(depth[:-1]) == 0
            out.append((len(words), int((~keep).sum()), hashlib.sha256(words.kept(keep)).hexdigest()))
        n_words, n_removed, digest = zip(*out) if out else ((), (), ())
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_sha256": pa.array(digest, pa.string()),
        })


def repeated(docs: DataFrame) -> DataFrame:
    """``doc, hits``: per document the paths that a smaller document also has,
    as an array of ``(path, places)``; ``places`` null means every window."""
    rows = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(_path_rows, "piece long, path long, doc long")
    shared = rows.groupBy("piece").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi").select("piece")
    found = materialize(rows.join(shared, "piece"), "paths")
    compact = materialize(found.groupBy("piece", "path").agg(F.min("doc").alias("first")), "compact")
    branching = compact.groupBy("piece").agg(F.count("*").alias("n")).filter("n > 1").select("piece")
    branching = materialize(branching, "branching")  # so that the join deals both sides anew
    asked = compact.join(branching, "piece").groupBy("first").agg(F.collect_list("path").alias("paths"))
    sources = _packed(docs.filter("doc_id IS NOT NULL AND text IS NOT NULL"))
    sources = sources.join(asked, F.col("doc_id") == F.col("first")).select("doc_id", "packed", "paths")
    windows = materialize(sources.mapInArrow(_window_rows, "path long, place int, window long, doc long"), "windows")
    # Windows of one path only are left out, and the rest is written first, so
    # that the join deals both sides anew and a window of many paths is split.
    least = windows.groupBy("window").agg(F.min("doc").alias("least"), F.count("*").alias("n")).filter("n > 1")
    least = materialize(least.select("window", "least"), "shared-windows")
    place = F.struct("place", F.coalesce("least", "doc").alias("least"))
    places = windows.join(least, "window", "left").groupBy("path").agg(F.sort_array(F.collect_set(place)).alias("places"))
    # Per distinct path: its smallest document and, where the graph branches,
    # the smallest document of every window.
    known = compact.select("path", "first").join(places, "path", "left")
    hits = found.select("path", "doc").join(known, "path")
    earlier = F.transform(F.filter("places", lambda p: p["least"] < F.col("doc")), lambda p: p["place"])
    hits = hits.select("doc", "path", F.when(F.col("places").isNotNull(), earlier).alias("places"), "first")
    hits = hits.filter(F.when(F.col("places").isNull(), F.col("first") < F.col("doc")).otherwise(F.size("places") > 0))
    return hits.groupBy("doc").agg(F.collect_list(F.struct("path", "places")).alias("hits"))


def clean(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = repeated(docs)
    joined = _packed(docs).join(hits, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "packed", "hits")
    return joined.mapInArrow(_clean_rows, "doc_id long, n_words long, n_removed long, kept_sha256 string")

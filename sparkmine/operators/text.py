"""Documents as words, word weights and feature vectors.

Documents come as ``(doc_id, text)``, one document per row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import IDF, VarianceThresholdSelector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sparkmine.functions.text import tokens
from sparkmine.plans.workspace import discard, materialize

NUM_FEATURES = 1 << 20  # fixed value: width of the hashed vectors
CHARS_PER_PART = 8 << 20  # text that one task turns into words
STORED = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"  # vectors of Spark ML
BROADCAST_SLOTS = 1 << 22  # widest vectors whose slot weights are broadcast, 32 MiB


def by_document(docs: DataFrame, chars: int = CHARS_PER_PART) -> DataFrame:
    """Documents dealt out by id while they are still one row each, which is
    less to move than the rows their words become. Later steps that group by
    document and word find their rows in place, in parts that grow in number
    with the text and not in size."""
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // chars))
    return docs.repartition(parts, "doc_id")


def tokenize(docs: DataFrame) -> DataFrame:
    """One row per word occurrence: ``(doc_id, pos, term)``."""
    return docs.select("doc_id", F.posexplode(tokens("text")).alias("pos", "term"))


def term_frequency(words: DataFrame) -> DataFrame:
    """Occurrences of each word in each document."""
    return words.groupBy("doc_id", "term").agg(F.count("*").cast("double").alias("weight"))


def _counted(docs: DataFrame, words: Column) -> DataFrame:
    """The distinct values of ``words`` in order and how often each occurs, as
    ``(doc_id, idx, val)``. Worked out inside the row; nothing is moved."""
    ordered = docs.select("doc_id", F.sort_array(words).alias("all"))  # null text has no words
    ordered = ordered.withColumn("all", F.coalesce("all", F.array().cast(ordered.schema["all"].dataType)))
    ends = F.transform("all", lambda w, i: F.when(F.coalesce(w != F.get("all", i + 1), F.lit(True)), i + 1))
    ends = ordered.select("doc_id", "all", F.filter(ends, lambda e: e.isNotNull()).alias("ends"))
    runs = F.transform("ends", lambda e, i: (e - F.coalesce(F.get("ends", i - 1), F.lit(0))).cast("double"))
    return ends.select("doc_id", F.array_distinct("all").alias("idx"), runs.alias("val"))


def document_tf(docs: DataFrame) -> DataFrame:
    """Word frequencies straight from the documents, one row per document."""
    counted = _counted(docs, tokens("text"))
    cells = counted.select("doc_id", F.explode(F.arrays_zip("idx", "val")).alias("cell"))
    return cells.select("doc_id", F.col("cell.idx").alias("term"), F.col("cell.val").alias("weight"))


def idf(tf: DataFrame, n_docs: int, key: str = "term") -> DataFrame:
    """Inverse document frequency ln((n+1)/(df+1)) per word."""
    return tf.groupBy(key).agg(F.count("*").alias("df")).withColumn("idf", _idf(n_docs))


def _idf(n_docs: int) -> Column:
    return F.log(F.lit(float(n_docs + 1)) / (F.col("df") + 1))


def tfidf(tf: DataFrame, n_docs: int, key: str = "term") -> DataFrame:
    """Word frequency times inverse document frequency. The vocabulary grows
    with the data, so the join side is left to adaptive execution."""
    weights = idf(tf, n_docs, key).select(key, "idf")
    return tf.join(weights, key).select("doc_id", key, (F.col("weight") * F.col("idf")).alias("weight"))


def vectorize(docs: DataFrame, features: str = "tf", num_features: int = NUM_FEATURES) -> DataFrame:
    """Hashed word vectors ``(id, idx, val)``: parallel arrays of the slots in
    use, in order, and their weights. ``features`` is ``tf`` or ``tfidf``.

    A document stays one row from its text to its vector; only the document
    counts per slot, at most one row per slot and task, are exchanged.
    """
    kind = features.lower()
    if kind not in ("tf", "tfidf"):
        raise ValueError(f"unknown features {features!r}")
    counted = docs.select(F.col("doc_id").alias("id"), _slot_counts("text", num_features).alias("cells"))
    vectors = counted.select("id", "cells.idx", "cells.val")
    if kind == "tf":
        return vectors
    vectors = materialize(vectors, "tf")
    used = vectors.select(F.explode("idx").alias("slot"))
    weights = idf(used, vectors.count(), "slot").select("slot", "idf")
    if num_features <= BROADCAST_SLOTS:
        return vectors.withColumn("val", _weighted(weights, num_features))
    return _weighted_by_join(vectors, weights)


def _counter(num_features: int, hashes):
    """Texts as parallel lists of the slots of their words (``tokens``), in order, and how
    often each occurs. A word is hashed once per batch. Built inside a function so that it
    travels to the tasks by value."""

    def counted(text: pa.Array) -> tuple[pa.Array, pa.Array]:
        cut = pc.ascii_rtrim(text, characters=" ")
        blank = pc.and_(pc.equal(cut, ""), pc.not_equal(text, ""))
        words = pc.split_pattern(pc.if_else(blank, None, cut), " ")  # null text has no words
        coded = words.flatten().dictionary_encode()
        slots = hashes(coded.dictionary.cast(pa.binary()).to_pylist()) % num_features
        sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        cells = np.repeat(np.arange(len(words)) * num_features, sizes) + slots[coded.indices.to_numpy(zero_copy_only=False)]
        cells.sort()
        at = np.flatnonzero(np.diff(cells, prepend=-1))
        ends = pa.array(np.searchsorted(cells[at], np.arange(len(words) + 1) * num_features), pa.int32())
        parts = (cells[at] % num_features).astype(np.int32), np.diff(at, append=len(cells)).astype(float)
        return tuple(pa.ListArray.from_arrays(ends, pa.array(x)) for x in parts)

    return counted


def _slot_counts(text: str, num_features: int) -> Column:
    """Word counts of texts by slot, as ``functions.hashing.slot`` numbers them."""

    def hashes(words: list[bytes]) -> np.ndarray:
        return np.array([int.from_bytes(hashlib.md5(w, usedforsecurity=False).digest()[:4], "big") for w in words], np.int64)

    counted = _counter(num_features, hashes)

    @F.arrow_udf("struct<idx:array<int>,val:array<double>>")
    def cells(text: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(counted(text), ["idx", "val"])

    return cells(text)


def _hashed(text: str, num_features: int) -> Column:
    """Word counts of texts by slot, as ``HashingTF`` of Spark ML numbers them, in vectors as Spark
    ML stores them. ``HashingTF`` itself hashes and counts word by word."""

    def rotated(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

    def mixed(x: np.ndarray) -> np.ndarray:
        return rotated(x * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)

    def hashes(words: list[bytes]) -> np.ndarray:  # murmur3, all words of a length together
        out, sizes = np.zeros(len(words), np.int64), np.array([len(w) for w in words], np.int64)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            text = np.frombuffer(b"".join(words[r] for r in rows), np.uint8).reshape(len(rows), size)
            h, whole = np.full(len(rows), 42, np.uint32), size // 4 * 4
            for block in np.ascontiguousarray(text[:, :whole]).view("<u4").T:
                h = rotated(h ^ mixed(block), 13) * np.uint32(5) + np.uint32(0xE6546B64)
            tail = np.zeros(len(rows), np.uint32)
            for n in range(whole, size):
                tail |= text[:, n].astype(np.uint32) << np.uint32(8 * (n - whole))
            h ^= mixed(tail) ^ np.uint32(size)
            for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
                h = (h ^ (h >> np.uint32(shift))) * np.uint32(by)
            out[rows] = (h ^ (h >> np.uint32(16))).view(np.int32)
        return out

    counted, stored = _counter(num_features, hashes), _stored_vectors()

    @F.arrow_udf(STORED)
    def vectors(text: pa.Array) -> pa.Array:
        return stored(num_features, *counted(text))

    return vectors(text)


def _stored_vectors():
    """Slots and weights as the sparse vectors that Spark ML stores."""

    def stored(width: int, idx: pa.Array, val: pa.Array) -> pa.Array:
        kinds = pa.array(np.zeros(len(idx), np.int8)), pa.array(np.full(len(idx), width, np.int32))
        return pa.StructArray.from_arrays([*kinds, idx, val], ["type", "size", "indices", "values"])

    return stored


def _weighted(weights: DataFrame, num_features: int) -> Column:
    table = weights.toArrow().to_pandas()
    dense = np.zeros(num_features)
    dense[table["slot"].to_numpy()] = table["idf"].to_numpy()
    held = weights.sparkSession.sparkContext.broadcast(dense)

    @F.arrow_udf("array<double>")
    def weighted(idx: pa.Array, val: pa.Array) -> pa.Array:
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(idx).to_numpy(zero_copy_only=False))))
        flat = val.flatten().to_numpy() * held.value[idx.flatten().to_numpy()]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

    return weighted("idx", "val")


def _weighted_by_join(vectors: DataFrame, weights: DataFrame) -> DataFrame:
    cells = vectors.select("id", F.explode_outer(F.arrays_zip("idx", "val")).alias("cell"))
    cells = cells.select("id", F.col("cell.idx").alias("slot"), F.col("cell.val").alias("val"))
    cells = cells.join(weights, "slot", "left")
    cell = F.when(F.col("slot").isNotNull(), F.struct("slot", (F.col("val") * F.col("idf")).alias("val")))
    grouped = cells.groupBy("id").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return grouped.select("id", F.col("cells.slot").alias("idx"), F.col("cells.val").alias("val"))


def dense_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Plain number arrays in the ``(id, idx, val)`` form."""
    places = F.sequence(F.lit(0), F.size(vec_col) - 1)
    return df.select(F.col(id_col).alias("id"), places.alias("idx"), F.col(vec_col).alias("val"))


def ml_tfidf(docs: DataFrame, num_features: int = NUM_FEATURES) -> DataFrame:
    """TF-IDF vectors ``(id, features)`` for the Spark ML solvers.

    Slots that are the same in every document, above all the unused ones, do
    not change any distance and are cut out: the solvers sum dense vectors.
    """
    hashed = docs.select(F.col("doc_id").alias("id"), _hashed("text", num_features).alias("all"))  # words are hashed once
    hashed = materialize(hashed, "hashed", StructType([hashed.schema["id"], StructField("all", VectorUDT())]))
    used = VarianceThresholdSelector(featuresCol="all", outputCol="tf", varianceThreshold=0.0).fit(hashed).selectedFeatures
    tf = hashed.select("id", _selected(hashed, np.array(used, np.int64), num_features).alias("tf"))
    tf = materialize(tf, "ml-tf", StructType([hashed.schema["id"], StructField("tf", VectorUDT())]))
    discard(hashed)
    return IDF(inputCol="tf", outputCol="features").fit(tf).transform(tf).select("id", "features")


def _selected(hashed: DataFrame, used: np.ndarray, num_features: int) -> Column:
    """The sparse vectors ``all`` cut to the slots in use, as Spark ML stores them. Its
    own selector walks through all slots for every vector."""
    places = np.full(num_features, -1, np.int32)
    places[used] = np.arange(len(used), dtype=np.int32)
    held, width, stored = hashed.sparkSession.sparkContext.broadcast(places), len(used), _stored_vectors()

    @F.arrow_udf(STORED)
    def selected(vectors: pa.Array) -> pa.Array:
        idx, val = vectors.field("indices"), vectors.field("values")
        places, ends = held.value[idx.flatten().to_numpy()], np.concatenate(([0], np.cumsum(pc.list_value_length(idx))))
        kept = places >= 0
        starts = pa.array(np.concatenate(([0], np.cumsum(kept)))[ends], pa.int32())
        cells = places[kept], val.flatten().to_numpy()[kept]
        return stored(width, *(pa.ListArray.from_arrays(starts, pa.array(c)) for c in cells))

    return selected(F.unwrap_udt("all"))

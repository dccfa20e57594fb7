"""Near-duplicates by SimHash fingerprints, found through Golay codewords.

Fingerprints have 64 bits and link at ``RADIUS`` = 2 or fewer differing bits.
They are cut into three segments of 22, 21 and 21 bits. Of two errors spread
over three segments, some segment has none, and of the other two one has at
most one. So every linked pair agrees in one of three settings: a segment that
is equal, and the segment before it (in the circle of three) with at most one
error.

The segment that may hold the error is decoded with the perfect binary Golay
code of 23 bits, where every word lies within 3 bits of exactly one codeword.
If two words differ in one bit, either both decode to one codeword, or both
lie 3 bits from theirs and each lies 4 bits from the other's. The keys of a
word are therefore the index of its codeword and, for words 3 bits off, those
of the five codewords 4 bits off as well: up to six keys, and words one bit
apart always share one. A key joined with the equal segment is a bucket of
about 33 bits.

Buckets of up to ``SMALL`` fingerprints are joined pair by pair and verified.
In larger buckets a fingerprint is listed under itself and its 64 neighbours
at one bit; two of them share such a point exactly if they differ in two bits
or fewer, and every point links its fingerprints to the smallest one. So no
group is ever expanded into all its pairs, and no link is lost.

Equal fingerprints are one node, so exact copies cost one row each.

Defined results: a null or blank text has fingerprint zero and is linked like
any other; rows with one id are separate rows with the same component; a null
id never becomes a component id unless the whole group has none; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.components import components
from sparkmine.llm.tables import placed
from sparkmine.plans.workspace import materialize

SEED = 42
SHINGLE = 3
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
SMALL = 16
SHINGLES_AT_ONCE = 1 << 16

# Fixed value: generator polynomial of the binary Golay code of length 23,
# x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def fingerprint(text: str | None) -> int:
    """Bits set in over half the XXH64 hashes of the 3-word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))), len(words) - SHINGLE + 1
    set_bits = np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    for at in range(0, n, SHINGLES_AT_ONCE):
        some = np.fromiter(hashes, np.uint64, min(SHINGLES_AT_ONCE, n - at))
        set_bits += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.int64)[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprints(texts: Column) -> Column:
    return F.pandas_udf(_fingerprints, "long")(texts.cast("string"))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _remainder(words: np.ndarray) -> np.ndarray:
    """Of 23-bit words, as polynomials, by the generator."""
    out = words.copy()
    for bit in range(22, 10, -1):
        out = np.where(out >> bit & 1, out ^ (GENERATOR << (bit - 11)), out)
    return out


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """Per remainder, the errors that lead to the nearest codeword and, where
    that is 3 bits off, to the five codewords 4 bits off; -1 where there is no
    more."""
    table = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)
    for weight in range(5):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        remainders = _remainder(errors)
        if weight < 4:
            table[remainders, 0] = errors
            filled[remainders] = 1 if weight == 3 else 6
        else:
            for r, e in zip(remainders.tolist(), errors.tolist()):
                if filled[r] < 6:
                    table[r, filled[r]] = e
                    filled[r] += 1
    return table


def golay_keys(words: np.ndarray) -> np.ndarray:
    """Up to six 12-bit codeword indices per word of 23 bits or fewer; -1 fills."""
    errors = _errors()[_remainder(words)]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(index of the fingerprint, bucket)`` of all buckets."""
    u = fps.view(np.uint64)
    parts = [((u >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows, keys = [], []
    for setting in range(3):
        near, equal = golay_keys(parts[setting]), parts[(setting + 1) % 3]
        row, col = np.nonzero(near >= 0)
        rows.append(row)
        keys.append((setting << 40) | (near[row, col] << 22) | equal[row])
    return np.concatenate(rows), np.concatenate(keys)


def _bucket_rows(batches):
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        rows, keys = bucket_keys(fps)
        yield pa.record_batch({"bucket": pa.array(keys), "fp": pa.array(fps[rows])})


def links(fps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` among distinct fingerprints ``(fp)`` that connect
    exactly those that a chain of steps of at most 2 bits connects."""
    keyed = materialize(fps.select("fp").mapInArrow(_bucket_rows, "bucket long, fp long"), "buckets")
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    shared = materialize(keyed.join(sizes, "bucket"), "shared")
    small = shared.filter(F.col("size") <= SMALL)
    pairs = small.select("bucket", F.col("fp").alias("a")).join(small.select("bucket", F.col("fp").alias("b")), "bucket")
    pairs = pairs.filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).select("a", "b")
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(64)])
    points = shared.filter(F.col("size") > SMALL).select("fp").distinct()
    points = points.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("point"))
    hubs = points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).filter("a < last").select("point", "a")
    starred = points.join(hubs, "point").filter("fp > a").select("a", F.col("fp").alias("b"))
    return pairs.union(starred).distinct()


def _rooted(marked: DataFrame) -> DataFrame:
    """``fp, root`` of every fingerprint of ``marked``."""
    nodes = materialize(marked.select("fp").distinct(), "nodes")
    roots = components(links(nodes))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id among all documents that
    chains of near-duplicates connect."""
    marked = materialize(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")), "fingerprints")
    rooted = materialize(_rooted(marked), "roots")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = rooted.join(least, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, place: Column | None = None) -> DataFrame:
    """One document of each class, with all its columns: that with the smallest
    id; of rows that repeat the id, one. ``place`` is an expression that names
    each row the same in every scan; without one, a numbered copy is written."""
    docs, place, names = placed(docs, place)
    doc = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), place.alias("place")).alias("doc")
    marked = materialize(docs.select(doc, fingerprints(F.col("text")).alias("fp")), "fingerprints")
    first = marked.groupBy("fp").agg(F.min("doc").alias("doc")).join(_rooted(marked), "fp").groupBy("root").agg(F.min("doc").alias("doc"))
    packed = docs.select(F.struct(*names).alias("doc"), place.alias("place"))
    return packed.join(first.select(F.col("doc.place").alias("kept")), F.col("place") == F.col("kept")).select("doc.*")

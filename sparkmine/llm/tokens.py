"""Token ids in Arrow files of equal-length sequences.

Documents are sorted by id into ranges; each range is one shard, written by the
task that holds it. A shard is two files in the Arrow random-access file format
(the stream format plus a footer that lists its batches):

``shard-N.arrow``       ``ids`` and ``mask``, both fixed-size lists of one
                        length, in batches of equal row counts. The ids of all
                        documents of the shard follow each other; only the last
                        sequence is padded (mask false).
``shard-N.docs.arrow``  ``doc_id``, ``offset`` into that run of ids, ``n_tokens``.

Uncompressed fixed-size lists have no offsets: sequence ``i`` lies at a place
known from ``i`` alone, so a memory-mapped file yields any sequence without a
copy. Ids take 16 bits while the vocabulary allows, 32 otherwise.

Defined results: null text is an empty text (its only token is the end id);
rows with equal or null ids keep the order of the input, nulls first; an empty
table gives no shard; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkmine.plans.workspace import materialize

BATCH_IDS = 1 << 19  # ids in one batch of a shard

# The settings under which blanks and the borders of ASCII words
# separate tokens, so that words can be encoded one by one.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_STEPS = ("NFC", "Replace", "Lowercase")

_PLAIN = re.compile(rb"[!-&(-~]+")  # printable ASCII, no apostrophe
_PIECE = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")
_LETTERS_THEN_MARKS = re.compile(r"(\w+)([!-&(-/:-@\[-`{-~]+)")


class Encoder:
    """Texts to ids. With a tokenizer that lower-cases, drops white space and
    never joins characters across it, every word is encoded once and looked up
    afterwards (at most ``keep`` words are held); any other tokenizer gets the
    whole texts. Both give the ids of ``encode`` on the whole text."""

    def __init__(self, path: str, keep: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.by_word = by_word(self.tokenizer)
        self.words = _Words(self.tokenizer, self.dtype, keep)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if self.by_word:
            known = self.words.__getitem__
            return [b"".join(map(known, _folded(t.encode()).split())) if t else b"" for t in texts]
        found = self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]


def _folded(text: bytes) -> bytes:
    """Lower-case, so that more words are known. Not where a special token, told
    apart by its case, may stand, nor where a letter may still be composed with
    the mark behind it."""
    return text.lower() if text.isascii() and b"<|" not in text else text


class _Words(dict):
    """Word (without ASCII blanks) -> its ids as bytes."""

    def __init__(self, tokenizer: Tokenizer, dtype: np.dtype, keep: int):
        self.tokenizer, self.model, self.dtype, self.keep = tokenizer, tokenizer.model, dtype, keep

    def __missing__(self, word: bytes) -> bytes:
        ids = self._ids(word)
        if len(self) < self.keep:
            self[word] = ids
        return ids

    def _ids(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters: what the steps before the model would leave as it is
            return np.array([t.id for t in self.model.tokenize(word.lower().decode())], self.dtype).tobytes()
        if _PLAIN.fullmatch(word) and b"<|" not in word:
            pieces = _PIECE.findall(word.lower())
            if len(pieces) > 1:
                return b"".join(self[p] for p in pieces)
        text = word.decode()
        if (m := _LETTERS_THEN_MARKS.fullmatch(text)) and m[1].lower().isalpha() and "<|" not in m[2]:
            return self[m[1].encode()] + self[m[2].encode()]
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()


def by_word(tokenizer: Tokenizer) -> bool:
    spec = json.loads(tokenizer.to_str())
    steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        tuple(steps) == WORD_STEPS
        and [s["type"] for s in splits] == ["Split", "ByteLevel"]
        and splits[0]["pattern"] == {"Regex": WORD_SPLIT}
        and splits[0]["behavior"] == "Removed"
        and not splits[1]["add_prefix_space"]
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer, kept over tasks."""
    return Encoder(path)


def _files(root: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        return pa.fs.FileSystem.from_uri(root)
    return pa.fs.LocalFileSystem(), root


class _Replaced:
    """A file written under a name of its own and moved into place when whole,
    so that a repeated task leaves one whole file."""

    def __init__(self, fs: pa.fs.FileSystem, path: str, schema: pa.Schema):
        self.fs, self.path, self.own = fs, path, f"{path}.{uuid.uuid4().hex}"
        self.sink = fs.open_output_stream(self.own)
        self.writer = pa.ipc.new_file(self.sink, schema)

    def close(self) -> None:
        self.writer.close()
        self.sink.close()
        self.fs.move(self.own, self.path)


class _Sequences:
    """Cuts a run of ids into sequences and writes them in batches."""

    def __init__(self, out: _Replaced, dtype: np.dtype, length: int):
        self.out, self.dtype, self.length = out, dtype, length
        self.rows = max(1, BATCH_IDS // length)
        self.held: list[bytes] = []
        self.size = 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids) // self.dtype.itemsize
        if self.size >= self.rows * self.length:
            self.flush(last=False)

    def flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), self.dtype)
        step = self.rows * self.length
        whole = len(ids) // step * step
        for at in range(0, whole, step):
            self._write(ids[at : at + step], step)
        rest = ids[whole:]
        self.held, self.size = [rest.tobytes()], len(rest)
        if last and len(rest):
            self._write(rest, -(-len(rest) // self.length) * self.length)

    def _write(self, ids: np.ndarray, room: int) -> None:
        mask = np.arange(room) < len(ids)
        full = np.zeros(room, self.dtype)
        full[: len(ids)] = ids
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (full, mask)]
        self.out.writer.write_batch(pa.record_batch(lists, schema=_sequence_schema(self.dtype, self.length)))


def _sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


DOC_SCHEMA = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())])


def write(docs: DataFrame, root: str, tokenizer: str, end_id: int = 1, length: int = 1024) -> DataFrame:
    """Encode all documents in order of ``doc_id`` into shards below ``root``;
    returns the written shards as ``(shard, first, n_tokens)``, ``first`` being
    the number of ids in the shards before it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    parts = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        enc, (fs, folder) = encoder(tokenizer), _files(root)
        fs.create_dir(folder, recursive=True)
        number = TaskContext.get().partitionId()
        name = f"{folder}/shard-{number:06d}"
        out = _Replaced(fs, f"{name}.arrow", _sequence_schema(enc.dtype, length))
        index = _Replaced(fs, f"{name}.docs.arrow", DOC_SCHEMA)
        sequences, end, at = _Sequences(out, enc.dtype, length), np.array([end_id], enc.dtype).tobytes(), 0
        for batch in (b for held in ([first], batches) for b in held):
            sizes = []
            for ids in enc.encode(batch.column("text").to_pylist()):
                sequences.add(ids + end)
                sizes.append(len(ids) // enc.dtype.itemsize + 1)
            sizes = np.array(sizes, np.int64)
            starts = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            index.writer.write_batch(pa.record_batch([batch.column("doc_id"), pa.array(starts), pa.array(sizes)], schema=DOC_SCHEMA))
        sequences.flush(last=True)
        out.close()
        index.close()
        yield pa.record_batch({"shard": pa.array([number], pa.int32()), "n_tokens": pa.array([at], pa.int64())})

    written = materialize(parts.select("doc_id", "text").mapInArrow(shard, "shard int, n_tokens long"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return written.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read(shards: DataFrame, root: str) -> DataFrame:
    """What the shards hold per document: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32`` of its ids as
    little-endian 32-bit integers. One task reads one shard, batch by batch."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _files(root)
        for batch in batches:
            for number, first in zip(batch.column("shard").to_pylist(), batch.column("first").to_pylist()):
                name = f"{folder}/shard-{number:06d}"
                with fs.open_input_file(f"{name}.arrow") as held, fs.open_input_file(f"{name}.docs.arrow") as index:
                    ids = _Run(pa.ipc.open_file(held))
                    docs = pa.ipc.open_file(index)
                    for i in range(docs.num_record_batches):
                        part = docs.get_batch(i)
                        sums = [ids.crc32(n) for n in part.column("n_tokens").to_pylist()]
                        starts = part.column("offset").to_numpy() + first
                        yield pa.record_batch(
                            [part.column("doc_id"), pa.array(starts, pa.int64()), part.column("n_tokens"), pa.array(sums, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    n = max(1, shards.count())
    return shards.repartitionByRange(n, "shard").select("shard", "first").mapInArrow(
        documents, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


class _Run:
    """The unmasked ids of a shard, taken in order."""

    def __init__(self, reader: pa.ipc.RecordBatchFileReader):
        self.reader, self.next, self.left = reader, 0, np.empty(0, "<u2")

    def crc32(self, n: int) -> int:
        crc = 0
        while n:
            if not len(self.left):
                batch = self.reader.get_batch(self.next)
                self.next += 1
                ids = batch.column("ids").flatten().to_numpy()
                mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
                self.left = ids if mask.all() else ids[mask]
            taken, self.left = self.left[:n], self.left[n:]
            crc = zlib.crc32(taken.astype("<u4").tobytes(), crc)
            n -= len(taken)
        return crc


def sequence(path: str, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence ``i`` and its mask from a shard on a local disk; the ids are a
    view of the memory-mapped file."""
    reader = pa.ipc.open_file(pa.memory_map(path))
    rows = max(1, BATCH_IDS // reader.schema.field("ids").type.list_size)
    batch = reader.get_batch(i // rows)
    ids = batch.column("ids")[i % rows].values.to_numpy(zero_copy_only=True)
    return ids, batch.column("mask")[i % rows].values.to_numpy(zero_copy_only=False)

"""Language identification in two steps: family, then language.

Features are the frequencies of byte pairs and triples of the lower-case text,
hashed into ``SLOTS`` places and rooted, so that every text is a vector of
length one whatever its size. Linear support vector machines, one for each pair
of classes, decide first between language families and then between the
languages of the chosen family; the class with the largest sum of bounded
margins wins. More than ``WIDEST`` classes are first put into groups of classes
with like texts, and machines decide between the groups, so the number of
machines stays small however many languages there are.

The machines learn from at most about ``PER_LANGUAGE`` texts of each language
that the corpus labels, chosen by a hash of the id. Texts are predicted from
their characters alone.

Defined results: null text and text without a letter is ``und`` with score 0,
and so is every text if there is nothing to learn from; with one language to
learn, every text with a letter has it, with score 1. Ids and languages may be
null: such rows are predicted, not learned from. Empty tables give an empty
result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.plans.workspace import materialize

SLOTS = 2048
PER_LANGUAGE = 600
WIDEST = 64  # classes that are held against one another directly
ROUNDS = 25
REGULARISATION = 1e-3
SLICE = 1 << 20  # bytes of a text that are turned into features at once
UNKNOWN = "und"
LEAST_SCORE = 0.25  # below this a text counts as in no known language

# Language family by ISO 639-1 code. A code that is not listed is
# a family of its own.
FAMILIES = {
    "germanic": "af da de en fo is lb nl nn no nb sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "celtic": "br cy ga gd",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tk uz",
    "indic": "bn gu hi mr ne pa si ur",
    "dravidian": "kn ml ta te",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "malayic": "id jv ms su tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def vector(text: str) -> np.ndarray:
    """Rooted frequencies of the hashed byte pairs and triples."""
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    counts = np.zeros(SLOTS, np.int64)
    shift = np.uint32(32 - SLOTS.bit_length() + 1)
    for at in range(0, len(raw), SLICE):
        b = raw[at : at + SLICE + 2].astype(np.uint32)
        pair = b[:-1] << np.uint32(8) | b[1:]
        triple = pair[:-1] << np.uint32(8) | b[2:]
        for codes, salt in ((pair[:SLICE], 0x85EBCA6B), (triple[:SLICE], 0x9E3779B1)):
            counts += np.bincount((codes * np.uint32(salt)) >> shift, minlength=SLOTS)
    return np.sqrt(counts / max(1, counts.sum()))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [vector(t) for t in batch.column("text").to_pylist()]
        flat = pa.array(np.concatenate(rows) if rows else np.empty(0))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * SLOTS, pa.int32()), flat)
        yield pa.record_batch({"lang": batch.column("lang"), "x": lists})


def sample(docs: DataFrame) -> DataFrame:
    """``lang, text`` to learn from: a bounded number of texts per language."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = known.groupBy("lang").count().orderBy("lang").collect()  # one row per language
    if not counts:
        return known.select("lang", "text").filter("false")
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, PER_LANGUAGE / r["count"]))])
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30) < share[F.col("lang")]
    return known.filter(F.coalesce(drawn, F.lit(False))).filter(has_letter(F.col("text"))).select("lang", "text")


class Machines:
    """One machine for each pair of classes: weights and intercepts by pair."""

    def __init__(self, classes: list[str], pairs: list[tuple[int, int]], weights: np.ndarray, intercepts: np.ndarray):
        self.classes, self.pairs, self.weights, self.intercepts = classes, pairs, weights, intercepts

    @staticmethod
    def learn(rows: DataFrame, label: str, classes: list[str]) -> Machines:
        pairs = list(combinations(range(len(classes)), 2))
        weights, intercepts = np.zeros((len(pairs), SLOTS)), np.zeros(len(pairs))
        solver = LinearSVC(featuresCol="features", labelCol="y", maxIter=ROUNDS, regParam=REGULARISATION, standardization=False)
        for k, (a, b) in enumerate(pairs):
            two = rows.filter(F.col(label).isin(classes[a], classes[b]))
            model = solver.fit(two.select("features", (F.col(label) == classes[a]).cast("double").alias("y")))
            weights[k], intercepts[k] = model.coefficients.toArray(), model.intercept
        return Machines(classes, pairs, weights, intercepts)

    def vote(self, x: np.ndarray) -> tuple[str, float]:
        """The winning class, and the least share it has against another."""
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        share = 1 / (1 + np.exp(-2 * np.clip(self.weights @ x + self.intercepts, -20, 20)))
        votes, least = np.zeros(len(self.classes)), np.ones(len(self.classes))
        for (a, b), p in zip(self.pairs, share):
            votes[a] += p
            votes[b] += 1 - p
            least[a], least[b] = min(least[a], p), min(least[b], 1 - p)
        best = int(votes.argmax())
        return self.classes[best], float(least[best])


class Tree:
    """Machines between groups of classes, and below them those of each group."""

    def __init__(self, groups: Machines, below: dict[str, Machines | Tree]):
        self.groups, self.below = groups, below
        self.classes = sorted(c for b in below.values() for c in b.classes)

    @staticmethod
    def learn(rows: DataFrame, label: str, classes: list[str]) -> Machines | Tree:
        if len(classes) <= WIDEST:
            return Machines.learn(rows, label, classes)
        members = {str(k): group for k, group in enumerate(_alike(rows, label, classes))}
        of = F.create_map(*[F.lit(v) for k, group in members.items() for c in group for v in (c, k)])
        grouped = rows.withColumn("group", of[F.col(label)])  # null for other classes
        return Tree(Machines.learn(grouped, "group", list(members)), {k: Tree.learn(rows, label, group) for k, group in members.items()})

    def vote(self, x: np.ndarray) -> tuple[str, float]:
        group, sure = self.groups.vote(x)
        best, share = self.below[group].vote(x)
        return best, sure * share


def _alike(rows: DataFrame, label: str, classes: list[str]) -> list[list[str]]:
    """The classes in at most ``WIDEST`` groups of equal size, each a class and
    those with the nearest mean vectors."""
    means = rows.filter(F.col(label).isin(classes)).groupBy(label).agg(Summarizer.mean(F.col("features")).alias("mean")).collect()  # one row per class
    mean = {r[label]: r["mean"].toArray() for r in means}
    size = math.ceil(len(classes) / min(WIDEST, math.ceil(math.sqrt(len(classes)))))
    left, groups = list(classes), []
    while left:
        near = sorted(left, key=lambda c: (float(((mean[c] - mean[left[0]]) ** 2).sum()), c))[:size]
        groups.append(sorted(near))
        left = [c for c in left if c not in near]
    return groups


class Model:
    def __init__(self, families: Machines | Tree | None, languages: dict[str, Machines | Tree]):
        self.families, self.languages = families, languages

    def predict(self, text: str) -> tuple[str, float]:
        if self.families is None:
            return UNKNOWN, 0.0
        x = vector(text)
        family, sure = self.families.vote(x)
        language, share = self.languages[family].vote(x)
        return language, sure * share


def learn(docs: DataFrame) -> Model:
    rows = materialize(sample(docs).mapInArrow(_vectors, "lang string, x array<double>"), "language-sample")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return Model(None, {})
    family = {lang: FAMILY_OF.get(lang, lang) for lang in languages}
    of = F.create_map(*[F.lit(v) for pair in family.items() for v in pair])
    rows = rows.select("lang", of[F.col("lang")].alias("family"), array_to_vector("x").alias("features")).cache()
    groups = {f: [x for x in languages if family[x] == f] for f in sorted(set(family.values()))}
    try:
        return Model(Tree.learn(rows, "family", list(groups)), {f: Tree.learn(rows, "lang", own) for f, own in groups.items()})
    finally:
        rows.unpersist()


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, taken from ``text`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) if ok else (UNKNOWN, 0.0) for t, ok in zip(batch.column("text").to_pylist(), batch.column("lettered").to_pylist())]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64()),
            })

    text = F.col("text").cast("string")
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), has_letter(text).alias("lettered"), text.alias("text"))
    return asked.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, with all their columns, that are in a known language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def known(text: str) -> bool:
        language, score = shared.value.predict(text)
        return language != UNKNOWN and score >= LEAST_SCORE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([known(t) for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.filter(has_letter(F.col("text").cast("string"))).mapInArrow(run, docs.schema)

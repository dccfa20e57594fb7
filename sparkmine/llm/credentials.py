"""Secrets in texts: fixed forms, and values that would be hard to guess.

Three forms are found by pattern: an assignment to a name such as ``password``, an
access key id, a long hexadecimal number. The patterns know neither passwords with
punctuation nor contexts in other words. There the *guess cost* decides: a value in
a credential context (``CONTEXT``, or the password in an address) is a secret if
the cheapest way to put it together costs ``MIN_BITS`` or more.

The cost is a minimum over all cuts of the value into segments, found by dynamic
programming from left to right. A segment costs ``KIND`` bits for its kind and

* word: the bits of its share among all words of the corpus, ``WORD_BITS`` at most,
  and bits for capitals and for digits or signs that stand for letters (``LEET``);
* date: a year, or day, month and year, with or without separators;
* repeat: the distance, up to ``FAR``, to what it repeats, and ``LENGTH`` bits;
* walk: the first key, then ``TURN`` bits where the direction on the keyboard (or
  along the alphabet and the digits) changes and ``AHEAD`` where it does not;
* brute force: the bits of every character's class.

Bits above ``MOST_BITS`` are not told apart, so a long value needs no whole scan.

How it runs: one pass over the texts yields, per document, the fixed spans and the
values in contexts, and per task the counts of the words that lie outside of both;
it is written, and the texts are read no more. Word counts are summed over the whole
corpus. Distinct values list the strings in them that could be words, which are
joined with the counts; each value is judged once. Both joins are salted, so a
value or string that a third of the documents have is spread over ``SALT`` keys.

Defined results: null text is empty; rows are judged one by one whatever their
ids; a value within a fixed span adds nothing; variables (``$x``), addresses and
calls are no values; an empty table gives an empty result; columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.plans.workspace import materialize

KINDS = ("assign", "access", "hex", "guess")

# The forms and their least lengths.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16

# Contexts of values. Quoted values run to the quote, others to a blank.
# After "is" and "bearer", which prose has too, a bare value needs a digit.
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|credentials?|token|(?:api|access|private|secret|auth|client)[_-]?(?:key|secret|token))["']?[ \t]*(?:=>|:=|[:=]|(?ai:is)(?=[ \t]+(?:["']|\S*\d)))|(?ai:bearer)(?=[ \t]+\S*\d))[ \t]*"""
    r"""(?:"([^"\n]{4,})"|'([^'\n]{4,})'|([^\s"'`,;<>(){}\[\]]{4,}))"""
    r"""|://[^\s/:@]*:([^\s/@]{4,})@"""
)
NO_VALUE = re.compile(r"\$[A-Za-z_{]|%[A-Za-z(]|.*://", re.S)
TAIL = ".,;:"

WORD = re.compile(r"[^\W\d_]+")
SHORTEST, LONGEST = 3, 24  # letters of a word
FEWEST = 3  # occurrences that make a word
COUNTS = 400_000  # distinct words a task holds
SALT = 16

MIN_BITS = math.log2(1e8)  # the least guesses of a value that is safe against attacks over a network
MOST_BITS = 128.0
KIND = math.log2(5)
WORD_BITS = 20.0
LENGTH, AHEAD, TURN = 3.0, 0.5, 3.0
FAR = 32

# Signs read as letters; rows of the keyboard, plain and shifted.
LEET = str.maketrans("4@3!10$57", "aaeiiosst")
KEYS = ("`1234567890-=", "\tqwertyuiop[]\\", "\tasdfghjkl;'", "\tzxcvbnm,./")
SHIFTED = ("~!@#$%^&*()_+", "\tQWERTYUIOP{}|", '\tASDFGHJKL:"', "\tZXCVBNM<>?")
STEPS = ((0, 1), (0, -1), (-1, 0), (-1, 1), (1, 0), (1, -1))  # each row lies half a key to the right
START = math.log2(47)
PLACE = {c: (r, k) for rows in (KEYS, SHIFTED) for r, row in enumerate(rows) for k, c in enumerate(row) if c != "\t"}

DATES = re.compile(r"(?:19|20)\d\d|\d{1,2}([-/.]?)\d{1,2}\1(?:19|20)\d\d|(?:19|20)\d\d([-/.]?)\d{1,2}\2\d{1,2}")
YEAR_BITS, DATE_BITS, CUT_BITS = math.log2(200), math.log2(200 * 366), 2.0

SCAN = (
    "doc_id long, fixed array<struct<start: long, kind: int, end: long>>, "
    "held array<struct<start: long, end: long, value: string>>, word string, n long"
)
_FIXED = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_HELD = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))


def fixed_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed forms, in code points, by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def values(text: str, fixed: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """``(start, end, value)`` of values in credential contexts that no fixed span holds."""
    out = []
    for m in CONTEXT.finditer(text):
        start, end = m.span(m.lastindex)
        value = m.group(m.lastindex)
        if m.lastindex == 3:
            value = value.rstrip(TAIL)
            end = start + len(value)
        if NO_VALUE.match(value) or any(s <= start and end <= e for s, _, e in fixed):
            continue
        out.append((start, end, value))
    return out


def _outside(text: str, spans: list[tuple[int, int]]) -> Iterator[str]:
    at = 0
    for start, end in sorted(spans):
        if start > at:
            yield text[at:start]
        at = max(at, end)
    yield text[at:]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter[str] = Counter()
    for batch in batches:
        fixed, held = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans = fixed_spans(text)
            found = values(text, spans)
            fixed.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
            held.append([{"start": s, "end": e, "value": v} for s, e, v in found])
            for part in _outside(text, [(s, e) for s, _, e in spans] + [(s, e) for s, e, _ in found]):
                words.update(WORD.findall(part.lower()))
        rows = len(fixed)
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            "fixed": pa.array(fixed, _FIXED),
            "held": pa.array(held, _HELD),
            "word": pa.nulls(rows, pa.string()),
            "n": pa.nulls(rows, pa.int64()),
        })
        if len(words) > COUNTS:
            yield _counted(words)
            words.clear()
    yield _counted(words)


def _counted(words: Counter[str]) -> pa.RecordBatch:
    kept = [(w, n) for w, n in words.items() if SHORTEST <= len(w) <= LONGEST]
    return pa.record_batch({
        "doc_id": pa.nulls(len(kept), pa.int64()),
        "fixed": pa.nulls(len(kept), _FIXED),
        "held": pa.nulls(len(kept), _HELD),
        "word": pa.array([w for w, _ in kept], pa.string()),
        "n": pa.array([n for _, n in kept], pa.int64()),
    })


def possible_words(value: str) -> set[str]:
    """What may be a word in the value: letters after ``LEET``, in lower case."""
    plain = _plain(value)
    out = set()
    for m in WORD.finditer(plain):
        for i in range(m.start(), m.end() - SHORTEST + 1):
            for j in range(i + SHORTEST, min(m.end(), i + LONGEST) + 1):
                out.add(plain[i:j])
    return out


def _plain(value: str) -> str:
    # Character by character, so that places stay the same.
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in value).translate(LEET)


@lru_cache(maxsize=4096)
def _class_bits(c: str) -> float:
    if "0" <= c <= "9":
        return math.log2(10)
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log2(26)
    return math.log2(33) if c < "\x80" else math.log2(1000)


def directions(a: str, b: str) -> set[int]:
    """Steps that lead from one key to the next."""
    out = set()
    if a in PLACE and b in PLACE:
        (r, k), (s, j) = PLACE[a], PLACE[b]
        if (s - r, j - k) in STEPS:
            out.add(STEPS.index((s - r, j - k)))
    if a.isascii() and b.isascii() and a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1:
        out.add(len(STEPS) + (ord(b) < ord(a)))
    return out


def word_bits(segment: str, plain: str, bits: float) -> float:
    """Of a word, written this way."""
    upper = sum(c.isupper() for c in segment)
    lower = sum(c.islower() for c in segment)
    if upper and not (segment[0].isupper() and upper == 1) and lower:
        bits += math.log2(sum(math.comb(upper + lower, k) for k in range(1, min(upper, lower) + 1)) + 1)
    elif upper:
        bits += 1
    return bits + sum(a.lower() != b for a, b in zip(segment, plain))


def date_bits(segment: str) -> float | None:
    if not DATES.fullmatch(segment):
        return None
    if len(segment) == 4:
        return YEAR_BITS
    return DATE_BITS + CUT_BITS * (not segment.isdigit())


def guess_bits(value: str, words: dict[str, float]) -> float:
    """The least bits of all cuts of the value; ``words`` has the bits of known words."""
    n, far = len(value), math.inf
    plain = _plain(value)
    cost = [0.0] + [far] * n
    brute, walks = far, [far] * (len(STEPS) + 2)
    copies = [far] * (FAR + 1)
    distance = [0.0] + [math.log2(p) for p in range(1, FAR + 1)]
    for j in range(1, n + 1):
        c = value[j - 1]
        brute = min(brute, cost[j - 1] + KIND) + _class_bits(c)
        best = brute
        for p in range(1, min(FAR, j - 1) + 1):
            if value[j - 1 - p] == c:
                copies[p] = min(copies[p], cost[j - 1] + KIND + LENGTH + distance[p])
                best = min(best, copies[p])
            else:
                copies[p] = far
        if j > 1:
            steps = directions(value[j - 2], c)
            turned = min(walks) + TURN
            began = cost[j - 2] + KIND + START + TURN
            walks = [min(walks[d] + AHEAD, turned, began) if d in steps else far for d in range(len(walks))]
            best = min(best, *walks)
        for i in range(max(0, j - LONGEST), j - SHORTEST + 1):
            bits = words.get(plain[i:j])
            if bits is not None:
                best = min(best, cost[i] + KIND + word_bits(value[i:j], plain[i:j], bits))
        if c.isdigit() and c.isascii():
            for i in range(max(0, j - 10), j - 3):
                bits = date_bits(value[i:j])
                if bits is not None:
                    best = min(best, cost[i] + KIND + bits)
        cost[j] = best
        # Whatever follows starts from one of these.
        if min(brute, best, *walks, *copies, *cost[max(0, j - LONGEST) : j]) >= MOST_BITS:
            return MOST_BITS
    return min(cost[n], MOST_BITS)


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, value in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist()):
            some = sorted(possible_words(value))
            for at in range(0, len(some), 10_000):
                part = some[at : at + 10_000]
                yield pa.record_batch({"key": pa.array([key] * len(part), pa.binary()), "word": pa.array(part, pa.string())})


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = []
        for value, words in zip(batch.column("value").to_pylist(), batch.column("words").to_pylist()):
            bits.append(guess_bits(value, {w["word"]: w["bits"] for w in words or ()}))
        yield pa.record_batch({"key": batch.column("key"), "bits": pa.array(bits, pa.float64())})


def judge(found: DataFrame, counts: DataFrame) -> DataFrame:
    """``key, bits`` of each distinct value of ``found`` (``key, value``), given
    ``word, n`` counts of the corpus."""
    distinct = materialize(found.groupBy("key").agg(F.min("value").alias("value")), "values")
    possible = materialize(distinct.mapInArrow(_possible, "key binary, word string"), "possible-words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(1)).alias("total"))
    known = counts.filter(F.col("n") >= FEWEST).join(possible.select("word").distinct(), "word", "left_semi")
    bits = F.least(F.log2(F.col("total") / F.col("n")), F.lit(WORD_BITS)).alias("bits")
    known = known.crossJoin(F.broadcast(total)).select("word", bits, F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))  # one row of totals
    salted = possible.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALT)).cast("int"))
    words = salted.join(known, ["word", "salt"]).groupBy("key").agg(F.collect_list(F.struct("word", "bits")).alias("words"))
    return distinct.join(words, "key", "left").mapInArrow(_judged, "key binary, bits double")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` of every document: ``(start, kind, end, bits)`` in code points,
    the end exclusive, by start and then kind, kinds by number in ``KINDS``; ``bits``
    are those of a value that its guess cost gave away."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = materialize(text.mapInArrow(_scan, SCAN).withColumn("row", F.monotonically_increasing_id()), "scanned")
    rows = scanned.filter("word IS NULL").select("row", "doc_id", "fixed", "held")
    counts = scanned.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    found = rows.select("row", F.explode("held").alias("v")).select("row", "v.start", "v.end", F.unhex(F.sha2("v.value", 256)).alias("key"), "v.value")
    found = materialize(found, "found")
    bits = materialize(judge(found.select("key", "value"), counts), "bits")
    costly = bits.filter(F.col("bits") >= MIN_BITS).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    asked = found.select("row", "start", "end", "key", F.pmod("row", F.lit(SALT)).cast("int").alias("salt"))
    added = asked.join(costly, ["key", "salt"]).groupBy("row").agg(F.collect_list(F.struct("start", F.lit(len(KINDS) - 1).alias("kind"), "end", "bits")).alias("added"))
    plain = F.transform("fixed", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(None).cast("double").alias("bits")))
    # Only documents with a value go through an exchange.
    without = rows.filter(F.size("held") == 0).select("doc_id", plain.alias("spans"))
    joined = rows.filter(F.size("held") > 0).join(added, "row", "left")
    within = joined.select("doc_id", F.array_sort(F.concat(plain, F.coalesce("added", F.array().cast("array<struct<start: bigint, kind: int, end: bigint, bits: double>>")))).alias("spans"))
    return without.union(within)


def digests(found: DataFrame) -> DataFrame:
    """Per document the number of spans of each fixed kind, their digest, and all spans
    as ``kind:start:end``, comma-joined."""

    def line(spans):
        name = lambda s: F.get(F.array(*map(F.lit, KINDS)), s["kind"])
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])],
        F.sha2(line(F.filter("spans", lambda s: s["kind"] < len(KINDS) - 1)), 256).alias("base_sha256"),
        line("spans").alias("spans"),
        number(3).alias("n_guess"),
    )

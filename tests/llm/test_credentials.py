"""Secret scan against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import time
from functools import lru_cache

import pytest

from sparkmine.llm import credentials as cr

NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def run_of(text, at, chars):
    end = at
    while end < len(text) and text[end] in chars:
        end += 1
    return end


def assign_at(text, at):
    """End of the match that starts here and its value's length, or None."""
    for name in NAMES:
        piece = text[at : at + len(name)]
        if not piece.isascii() or piece.lower() != name:
            continue
        for quote in (1, 0):
            k = at + len(name)
            if quote:
                if text[k : k + 1] not in ("'", '"') or k >= len(text):
                    continue
                k += 1
            k = run_of(text, k, " ")
            if text[k : k + 1] not in (":", "=") or k >= len(text):
                continue
            k = run_of(text, k + 1, " ")
            if text[k : k + 1] in ("'", '"') and k < len(text):
                k += 1
            end = run_of(text, k, VALUE)
            if end > k:
                return end, end - k
    return None


def fixed_by_hand(text):
    out, at = [], 0
    while at < len(text):
        hit = assign_at(text, at)
        if hit:
            if hit[1] >= 8:
                out.append((at, 0, hit[0]))
            at = hit[0]
        else:
            at += 1
    for kind, head, chars, least in ((1, "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 16), (2, "", set("0123456789abcdef"), 32)):
        at = 0
        while at < len(text):
            end = run_of(text, at + len(head), chars) if text.startswith(head, at) else at
            if end > at + len(head):
                if end - at >= least:
                    out.append((at, kind, end))
                at = end
            else:
                at += 1
    return sorted(out)


def test_fixed_forms():
    rnd = random.Random(1)
    parts = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "paſſword", "'", '"', " ", "  ", ":", "=", "abc", "Zz9+/_.", "12345678", "AKIA", "AKIA0123456789AB", "0123456789abcdef", "é", "\n", "-", ",", "toKen"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(8_000)]
    for t in texts:
        assert cr.fixed_spans(t) == fixed_by_hand(t), t
    assert {k for t in texts for _, k, _ in cr.fixed_spans(t)} == {0, 1, 2}


def bits_by_hand(value, words):
    """Every cut, one after another, from the rules of single segments."""
    plain = cr._plain(value)

    def segment(i, j):
        s, options = value[i:j], [sum(map(cr._class_bits, value[i:j]))]
        if plain[i:j] in words:
            options.append(cr.word_bits(s, plain[i:j], words[plain[i:j]]))
        if cr.date_bits(s) is not None:
            options.append(cr.date_bits(s))
        options += [cr.LENGTH + math.log2(p) for p in range(1, min(i, cr.FAR) + 1) if s == "".join(value[k - p] for k in range(i, j))]
        if j - i > 1:
            options += [cr.START + w for w in walks(s, None)]
        return cr.KIND + min(options)

    def walks(s, before):
        if len(s) == 1:
            yield 0.0
            return
        for d in cr.directions(s[0], s[1]):
            for rest in walks(s[1:], d):
                yield (cr.AHEAD if d == before else cr.TURN) + rest

    @lru_cache(None)
    def best(j):
        return min((best(i) + segment(i, j) for i in range(j)), default=0.0)

    return min(best(len(value)), cr.MOST_BITS)


def test_guess_bits():
    rnd = random.Random(2)
    words = {"pass": 4.0, "password": 6.0, "word": 5.0, "sword": 12.0, "dragon": 11.0, "monkey": 10.5, "one": 3.0, "ass": 14.0}
    parts = ["pass", "Password", "p4$$w0rd", "DRAGON", "dRaGoN", "monkey", "1999", "2001-05-12", "12052001", "qwerty", "asdf", "abc", "4321", "zxc", "aa", "xyxy", "!", "#", "Q", "é", "7"]
    for _ in range(250):
        value = "".join(rnd.choices(parts, k=rnd.randint(1, 4)))
        assert cr.guess_bits(value, words) == pytest.approx(bits_by_hand(value, words)), value


def test_order_of_costs():
    words = {"password": 6.0, "summer": 9.0, "correct": 12.0, "horse": 12.0, "battery": 13.0}
    for weak in ("password", "P4ssword", "Summer2019", "qwertyuiop", "aaaaaaaaaaaa", "abcabcabcabc", "12345678", "2001-05-12"):
        assert cr.guess_bits(weak, words) < cr.MIN_BITS, weak
    for strong in ("k8#Lq!vZ", "correct horse battery", "xK2$mP9&wQ", "Tz7!pass-2001-Rk%"):
        assert cr.guess_bits(strong, words) >= cr.MIN_BITS, strong


def test_long_values():
    start = time.time()
    assert cr.guess_bits("a" * 20_000, {}) < cr.MIN_BITS
    assert cr.guess_bits("x7#Q" + "k!9Z&w" * 20_000, {}) < cr.MOST_BITS
    rnd = random.Random(3)
    assert cr.guess_bits("".join(chr(rnd.randint(33, 126)) for _ in range(1_000_000)), {}) == cr.MOST_BITS
    text = "password: " * 30_000 + "x" * 300_000 + ' password="' * 20_000 + "https://" * 20_000
    cr.values(text, cr.fixed_spans(text))
    assert time.time() - start < 60


TEXTS = [
    "config: passphrase = \"Vq7 mm!x Zk#2\" end",
    "login with pwd: k8#Lq!vZ, please",
    "postgres://admin:Wq9!rT#4xL@db.example/x",
    "password: summer is over",
    "the secret is outsummered summer",
    "pwd=${DB_PASSWORD} pass: %s token => https://x.y/z",
    "password=abcd!efgh#1Kz and é password: 'abcdefgh1'",
    "Authorization: Bearer aZ4#kk!2Lm",
    None,
    "",
]


def test_find(spark, rows):
    prose = "summer over the horse is here and correct battery " * 30
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(50, prose), (50, prose), (None, "pwd: k8#Lq!vZ")] + [(100 + i, "pwd: k8#Lq!vZ") for i in range(40)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, row int, word string").repartition(3)
    counts = {}
    for _, t in docs:
        t = t or ""
        spans = cr.fixed_spans(t)
        for part in cr._outside(t, [(s, e) for s, _, e in spans] + [(s, e) for s, e, _ in cr.values(t, spans)]):
            for w in cr.WORD.findall(part.lower()):
                if 3 <= len(w) <= 24:
                    counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())
    words = {w: min(math.log2(total / n), cr.WORD_BITS) for w, n in counts.items() if n >= cr.FEWEST}
    want = []
    for i, t in docs:
        t = t or ""
        spans = [(s, k, e) for s, k, e in fixed_by_hand(t)]
        every = sorted(spans + [(s, 3, e) for s, e, v in cr.values(t, spans) if bits_by_hand(v, words) >= cr.MIN_BITS])
        line = lambda xs: ",".join(f"{cr.KINDS[k]}:{s}:{e}" for s, k, e in xs)
        want.append((i, *(sum(k == x for _, k, _ in spans) for x in range(3)), hashlib.sha256(line(spans).encode()).hexdigest(), line(every), len(every) - len(spans)))
    got = rows(cr.digests(cr.find(df)))
    assert got == sorted(want, key=repr)
    added = {r[0]: r[6] for r in got}
    assert [added[i] for i in range(8)] == [1, 1, 1, 0, 0, 0, 1, 1]
    assert TEXTS[0][got_span(got, 0)] == "Vq7 mm!x Zk#2"


def got_span(got, doc):
    _, start, end = next(r[5] for r in got if r[0] == doc).split(":")
    return slice(int(start), int(end))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert cr.digests(cr.find(df)).collect() == []

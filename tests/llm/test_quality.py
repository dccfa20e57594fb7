"""Quality counts by hand, and thresholds that follow the peers."""

from __future__ import annotations

import random
import re
from collections import Counter

from sparkmine.llm import quality


def by_hand(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= set(range(i, i + 8))
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def judged(spark, docs):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, lang string, source string, q string, n_words int")
    return quality.judge(df)


def test_counts(spark):
    random.seed(4)
    texts = [None, "", " \n\t", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 40, "l1\nl2\nl1\n \n \nl2 \n", "é#*$%&|<> é\x0bü\fz"]
    texts += [" ".join(random.choices("abc", k=random.randint(0, 60))) for _ in range(60)]
    texts += ["the same passage of nine words comes in here " + "filler %d " * 5 % (1, 2, 3, 4, 5) + "the same passage of nine words comes in here"]
    got = {r.doc_id: r for r in judged(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).collect()}
    for i, t in enumerate(texts):
        r, want = got[i], by_hand(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def prose(i, words=60):
    draw = random.Random(i)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(words))


def test_thresholds_follow_language_and_source(spark):
    """Prices are ordinary at a shop and not in news; a small source and a
    null source are judged by their language."""
    shop = [(i, prose(i) + " $" * 15, "en", "shop") for i in range(250)]
    news = [(1000 + i, prose(i), "en", "news") for i in range(400)]
    odd = [(2000, prose(1) + " $" * 15, "en", "news"), (2001, prose(2) + " #" * 200, "en", "shop"), (2002, prose(3) + " #" * 200, "en", None), (2003, prose(4) + " #" * 200, "en", "small"), (2004, prose(5), None, None)]
    got = {r.doc_id: r.kept for r in judged(spark, shop + news + odd).collect()}
    assert all(got[d[0]] for d in shop + news)
    assert [got[i] for i in (2000, 2001, 2002, 2003, 2004)] == [False, False, False, False, True]


def test_sketch_quantiles_are_near_the_true_ones(spark):
    from pyspark.sql import functions as F

    values = [random.Random(i).lognormvariate(0, 1) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(F.lit("g").alias("g"), F.lit("mean_chars").alias("ratio"), quality.bucket(F.col("v")).alias("bucket"))
    (r,) = quality.fences(df.groupBy("g", "ratio", "bucket").agg(F.count("*").alias("n")), ["g"]).collect()
    values.sort()
    low, mid, high = values[199], values[999], values[1799]
    assert abs(r.mean_chars_hi / (1.1 * high + 3 * (high - mid)) - 1) < 2 * (quality.GROWTH - 1) and r.size == 2000
    assert abs(r.mean_chars_lo - (0.9 * low - 3 * (mid - low))) < 4 * (quality.GROWTH - 1) * mid


def test_fences_decide_below_any_fixed_rate(spark):
    """A seventh of a symbol per word, words of nine letters: each ordinary in one
    source and out in the other, whatever is ordinary elsewhere."""
    wide = lambda i: " ".join("".join(random.Random(f"{i}-{k}").choices("abcdefgh", k=9)) for k in range(60))
    price = lambda i: prose(i) + " $" * (3 + i % 9)
    shop, news, law = [(i, price(i), "en", "shop") for i in range(250)], [(1000 + i, prose(i), "en", "news") for i in range(300)], [(2000 + i, wide(i), "en", "law") for i in range(250)]
    odd = [(3000, prose(1) + " $" * 4, "en", "shop"), (3001, prose(2) + " $" * 4, "en", "news"), (3002, wide(7), "en", "law"), (3003, wide(8), "en", "news"), (3004, " ".join(["ab"] * 0 + [f"{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]), "en", "law")]
    got = {r.doc_id: r.kept for r in judged(spark, shop + news + law + odd).collect()}
    assert all(got[d[0]] for d in shop + news + law)
    assert [got[i] for i in range(3000, 3005)] == [True, False, True, False, False]


def test_very_long_text(spark):
    """Every word of it counts."""
    text = "\n".join(prose(i, 20) for i in range(20_000))
    (r,) = judged(spark, [(1, text, "en", "a")]).collect()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == by_hand(text)[:4]


def test_empty_and_repeated(spark):
    assert judged(spark, []).collect() == []
    assert judged(spark, [(None, prose(1), "en", "a")] * 3).count() == 3

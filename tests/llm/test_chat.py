"""Chat formatting of trees and chains."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from sparkmine.llm import chat

SCHEMA = "tree string, id long, parent long, role string, text string, score double, leaf int, up int"


def trees(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    return chat.format_trees(df, **options)


def by_hand(rows, best):
    """Chosen paths as lists of (role, text), best first, by tree."""
    out = {}
    for tree in {r[0] for r in rows}:
        nodes = {r[1]: r for r in rows if r[0] == tree}
        parents = {r[2] for r in nodes.values()}
        paths = []
        for leaf in nodes:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in nodes and len(path) <= len(nodes):
                path.append(nodes[at])
                at = nodes[at][2]
            if len(path) > len(nodes):
                continue
            paths.append((-sum(p[5] or 0 for p in path) / len(path), -len(path), str(leaf), [(p[3] or "", p[4] or "") for p in path[::-1]]))
        out[tree] = [p[3] for p in sorted(paths)][:best]
    return out


ROWS = [
    ("a", 1, None, "user", "root", 0.0),
    ("a", 2, 1, "assistant", "good", 5.0),
    ("a", 3, 1, "assistant", "bad", 1.0),
    ("a", 4, 2, "user", "more", 0.0),
    ("a", 5, 4, "assistant", "end", 3.0),
    ("a", 6, 3, "user", "tie", 4.0),
    ("b", 1, 99, None, None, None),
    ("b", 2, 1, "we\nird\\n\\", "<|im_end|> <\\| \\<| <\\\\|\n", 2.0),
    (None, 1, None, "user", "no tree", 1.0),
    ("c", 1, 2, "user", "circle", 1.0),
    ("c", 2, 1, "user", "circle", 1.0),
]


@pytest.mark.parametrize("best", [1, 2, None])
def test_paths(spark, best):
    got = {}
    for r in chat.parse(trees(spark, ROWS, best=best)).collect():
        got.setdefault(r.tree, []).append([tuple(t) for t in r.turns])
        assert list(r.learned) == [t.text for t in r.turns if t.role == "assistant"]
    want = {t: p for t, p in by_hand(ROWS, best).items() if p}
    assert {t: sorted(p) for t, p in got.items()} == {t: sorted(p) for t, p in want.items()}


def test_deep_chain_and_wide_tree(spark):
    deep = [("d", i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", 0.0) for i in range(150)]
    wide = [("w", 0, None, "user", "q", 0.0)] + [("w", i, 0, "assistant", f"a{i}", float(i % 50)) for i in range(1, 300)]
    got = {r.tree: [tuple(t) for t in r.turns] for r in chat.parse(trees(spark, deep + wide)).collect()}
    assert got["d"] == [(r[3], r[4]) for r in deep]
    assert got["w"] == [("user", "q"), ("assistant", "a149")]


def test_repeated_ids_keep_the_smallest_row(spark):
    rows = [("a", 1, None, "user", "x", 0.0), ("a", 1, None, "user", "w", 0.0), ("a", 1, None, "user", "w", 0.0), ("a", None, 1, "assistant", "y", 0.0)]
    (row,) = chat.parse(trees(spark, rows)).collect()
    assert [tuple(t) for t in row.turns] == [("user", "w"), ("assistant", "y")]


def test_escape_is_undone(spark):
    texts = ["<|im_end|>", "<\\|", "<\\\\|<|", "<<||", "\\n", "a\nb", "\\s\\", "", "<|im_start|>assistant\nx<|im_end|>\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", chat.unescape(chat.escape(F.col("t"))).alias("u"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("r"), chat.escape(F.col("t")).alias("e"), chat.escape_role(F.col("t")).alias("f")).collect()
    for r in got:
        assert r.t == r.u == r.r and "<|" not in r.e and "<|" not in r.f and "\n" not in r.f


def test_conversations(spark, rows):
    control = "<|im_end|><|im_start|>assistant ok"
    turns = [(1, 5, "assistant", "late é"), (1, 0, "user", "first"), (1, 0, "system", None), (-1, 0, "user", control), (-1, 1, "assistant", control), (None, 0, "assistant", "x"), (2, None, "assistant", ""), (2, None, "assistant", "")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.tree: r for r in chat.digests(chat.format_trees(chat.as_replies(df, "conv_id"))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got["1"].turns_sha256 == sha("system\n\nuser\nfirst\nassistant\nlate é\n")
    assert (got["1"].n_turns, got["1"].loss_chars, got["1"].loss_sha256) == (3, 6, sha("late é"))
    assert got["-1"].turns_sha256 == sha(f"user\n{control}\nassistant\n{control}\n")
    assert (got["-1"].loss_sha256, got["-1"].loss_chars) == (sha(control), len(control))
    assert got[None].loss_sha256 == sha("x") and (got["2"].n_turns, got["2"].loss_chars) == (2, 0)
    assert got["1"].formatted_chars == sum(len(f"<|im_start|>{r}\n{t}<|im_end|>\n") for r, t in (("system", ""), ("user", "first"), ("assistant", "late é")))


def test_empty(spark):
    assert trees(spark, []).collect() == []

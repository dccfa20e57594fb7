"""Conversations out of reply trees, formatted for training.

A message has a tree, an id in it, and the id of the message it answers. The
paths from root to leaf are found by self-joins whose reach doubles: after
``k`` rounds every message knows its ancestor ``2^k`` steps up and the summed
score of the messages between, so a chain of any depth ``d`` takes about
``log2(d)`` joins. Leaves are ranked within their tree by the mean score of
their path; the paths of the chosen leaves are then read off the same tables,
again doubling, and each becomes one conversation.

A turn is written ``<|im_start|>role``, line end, text, ``<|im_end|>``, line
end. Inside roles and texts a backslash is put between ``<`` and ``|``, after
any backslashes that stand there already, which undoes exactly and leaves no
control string; line ends and backslashes inside roles are escaped too. The
loss mask lists the bytes of the texts of assistant turns.

Defined results: null text, role and score are empty, empty and 0; a message
whose parent is null or missing is a root; a null tree is a tree, a null id an
id nothing can answer; of rows with one id in one tree the smallest by parent,
role, text and score counts; messages that answer each other in a circle have
no root and appear in no conversation; an empty table gives an empty result;
further columns are ignored. One conversation is one row, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.plans.skew import top_k
from sparkmine.plans.workspace import materialize

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A backslash becomes ``\\s``, a line end ``\\n``."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def messages(rows: DataFrame) -> DataFrame:
    """``tree, id, parent, role, text, score`` with one row per message and
    parents that exist, written down."""
    names = set(rows.columns)
    tree = F.coalesce(F.concat(F.lit("t"), F.col("tree").cast("string")), F.lit("n"))
    own = F.coalesce(F.concat(F.lit("i"), F.col("id").cast("string")), F.concat(F.lit("r"), F.monotonically_increasing_id().cast("string")))
    body = F.struct(
        F.concat(F.lit("i"), F.col("parent").cast("string")).alias("parent"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (F.coalesce(F.col("score").cast("double"), F.lit(0.0)) if "score" in names else F.lit(0.0)).alias("score"),
    )
    once = rows.select(tree.alias("tree"), own.alias("id"), body.alias("m")).groupBy("tree", "id").agg(F.min("m").alias("m"))
    once = materialize(once.select("tree", "id", "m.*"), "messages")
    known = once.select(F.col("tree").alias("kt"), F.col("id").alias("kid"))
    checked = once.join(known, (F.col("tree") == F.col("kt")) & (F.col("parent") == F.col("kid")), "left")
    return materialize(checked.select("tree", "id", F.col("kid").alias("parent"), "role", "text", "score"), "replies")


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tables of ancestors ``2^k`` steps up, for k = 0, 1, ..., and the
    ``tree, id, total, steps`` of every message that has a root."""
    ups, settled = [], []
    now = nodes.select("tree", "id", F.col("parent").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("steps"))
    now = materialize(now, "climb")
    most = nodes.count()
    while True:
        settled.append(now.filter("up IS NULL").select("tree", "id", "total", "steps"))
        open_ones = now.filter("up IS NOT NULL")
        if 1 << len(ups) > 2 * most or open_ones.isEmpty():
            break
        ups.append(open_ones.select("tree", "id", "up"))
        above = now.select(F.col("tree").alias("at"), F.col("id").alias("aid"), F.col("up").alias("aup"), F.col("total").alias("atotal"), F.col("steps").alias("asteps"))
        joined = open_ones.join(above, (F.col("tree") == F.col("at")) & (F.col("up") == F.col("aid")))
        now = joined.select("tree", "id", F.col("aup").alias("up"), (F.col("total") + F.col("atotal")).alias("total"), (F.col("steps") + F.col("asteps")).alias("steps"))
        # Those that have arrived still serve as a step for others.
        now = materialize(now.union(settled[-1].select("tree", "id", F.lit(None).cast("string").alias("up"), "total", "steps")), "climb")
    return ups, settled[-1]


def chosen_paths(nodes: DataFrame, best: int | None) -> DataFrame:
    """``tree, leaf, score, id, above``: the messages of the chosen paths,
    ``above`` counting the steps from the leaf up."""
    ups, scored = _climb(nodes)
    answered = nodes.filter("parent IS NOT NULL").select("tree", F.col("parent").alias("id")).distinct()
    leaves = scored.join(answered, ["tree", "id"], "left_anti").withColumn("score", F.col("total") / F.col("steps"))
    if best is not None:
        leaves = top_k(leaves, ["tree"], [F.desc("score"), F.desc("steps"), F.asc("id")], best)
    paths = leaves.select("tree", F.col("id").alias("leaf"), "score", "id", F.lit(0).cast("long").alias("above"))
    for k, up in enumerate(ups):
        step = up.select(F.col("tree").alias("ut"), F.col("id").alias("uid"), "up")
        further = paths.join(step, (F.col("tree") == F.col("ut")) & (F.col("id") == F.col("uid")))
        paths = materialize(paths.union(further.select("tree", "leaf", "score", F.col("up").alias("id"), F.col("above") + (1 << k))), "paths")
    return paths


def format_trees(rows: DataFrame, best: int | None = 1) -> DataFrame:
    """``tree, leaf, score, formatted, loss``: one conversation per chosen
    path; ``loss`` holds ``start`` and ``size`` in bytes of UTF-8."""
    nodes = messages(rows)
    turns = chosen_paths(nodes, best).join(nodes.select("tree", "id", "role", "text"), ["tree", "id"])
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turns = turns.select("tree", "leaf", "score", "above", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == LEARNED).alias("learned"))
    size = F.octet_length("head") + F.octet_length("body") + len(END)
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("above")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.octet_length("head"))
    turn = F.struct((-F.col("above")).alias("turn"), F.concat("head", "body", F.lit(END)).alias("piece"), F.col("at").cast("int").alias("start"), F.octet_length("body").alias("size"), "learned")
    grouped = turns.groupBy("tree", "leaf", "score").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    learned = F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: F.struct(t["start"].alias("start"), t["size"].alias("size")))
    text = F.array_join(F.transform("turns", lambda t: t["piece"]), "")
    tree = F.when(F.col("tree") != "n", F.expr("substring(tree, 2)"))
    return grouped.select(tree.alias("tree"), F.expr("substring(leaf, 2)").alias("leaf"), "score", text.alias("formatted"), learned.alias("loss"))


def parse(formatted: DataFrame) -> DataFrame:
    """What formatted conversations say: ``turns`` (role and text) from the
    template, ``learned`` from the loss mask, both unescaped."""
    pieces = F.split("formatted", r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(START) + 1)), "\n", 1)
        text = F.substr(piece, F.length(role) + len(START) + 2)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    turns = F.transform(pieces, turn)
    learned = F.transform("loss", lambda s: unescape(F.decode(F.substr(F.encode("formatted", "UTF-8"), s["start"] + 1, s["size"]), "UTF-8")))
    return formatted.withColumn("turns", turns).withColumn("learned", learned)


def digests(formatted: DataFrame) -> DataFrame:
    """Per formatted conversation the digests of what it says."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return parse(formatted).select(
        "tree",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def as_replies(turns: DataFrame, conversation: str) -> DataFrame:
    """Turn-by-turn conversations as chains of replies: each row answers the
    one before it by turn, role and text."""
    order = Window.partitionBy(conversation).orderBy("turn", "role", "text")
    numbered = turns.select(conversation, "role", "text", F.row_number().over(order).alias("id"))
    return numbered.select(F.col(conversation).alias("tree"), "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text")

"""Mixing sources to target weights by pivotal rounding. Built-in expressions
only.

A source's target is its weight's share of all words, but at most ``MOST``
times what it has; what that leaves over is dealt among the others by weight
until none is above. Every document of a source is wanted ``target / size of
the source`` times. The whole part is taken; the fractions are rounded by the
pivotal method, in words: two partners exchange wanted words at random, the
expectation of both kept, until one of them is whole. The partners are the
largest open document of a block and all smaller ones of the block together
(which gain or lose in proportion; each of their own expectations is kept
only where their fractions are equal): paired one against one, the larger document would
nearly always stay open, and a source could miss its target by half of its
longest text. A block has about ``FAN`` documents and leaves one open, mostly
its smallest. These residuals meet in blocks of the next level, down to one a
source, which goes the nearer way.

All random numbers are hashes of the documents' ids, sources and sizes, so
reruns agree. Blocks are drawn by hash; rows that repeat (same id, source and
size) are told apart by their place in the written table, so a row that
repeats often is spread too.

Defined results: null text has size 0; documents of size 0 and sources without
words take nothing; a null source is a source, the last one; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.quality import let
from sparkmine.llm.tables import placed
from sparkmine.operators.ratings import index_ids
from sparkmine.plans.workspace import materialize

WEIGHTS = (5, 2, 1)
MOST = 3
FAN = 64
SEED = 20
EDGE = 1e-9  # a fraction this near to a whole number is whole
WORD = r"[^ \t\n\x0B\f\r]+"


def sizes(docs: DataFrame, place: Column | None = None) -> DataFrame:
    """``doc_id, source, size, row`` and ``place``, written down; ``row`` tells
    rows apart."""
    counted = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"),
        (F.lit(None).cast("long") if place is None else place).alias("place"),
    )
    return materialize(counted, "sizes")


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, n, source_size, target``, one row per source."""
    sources = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    places = index_ids(sources, "source")
    last = places.count()  # null comes after all others
    place = F.coalesce("idx", F.lit(last))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    placed = sources.join(places, sources["source"] == places["id"], "left").select("source", "n", "source_size", weight.alias("weight"))
    placed = materialize(placed.withColumn("cap", (most * F.col("source_size")).cast("double")), "weights")
    level, full = 0.0, -1
    while True:  # words per unit of weight; grows until no further source is full
        is_full = F.col("weight") * level > F.col("cap")
        found = placed.agg(
            F.sum("source_size").alias("words"),
            F.coalesce(F.sum(F.when(is_full, F.col("cap"))), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count(F.when(is_full, True)).alias("full"),
        ).first()
        if not found["words"] or not found["open"] or found["full"] == full:
            break
        full, level = found["full"], (found["words"] - found["capped"]) / found["open"]
    return placed.select("source", "n", "source_size", F.least(F.col("weight") * level, F.col("cap")).alias("target"))


def _chance(*of: Column | str) -> Column:
    """A number from 0 to 1 that depends on its arguments alone."""
    return F.pmod(F.xxhash64(*of), F.lit(1 << 52)) / float(1 << 52)


ITEM = "struct<size:bigint,who:bigint,salt:bigint,row:bigint,x:double>"
DONE = "array<struct<row:bigint,up:boolean>>"
STATE = f"struct<words:bigint,mass:double,base:double,slope:double,held:{ITEM},done:{DONE}>"


def _step(state: Column, item: Column) -> Column:
    """The largest document left exchanges wanted words with all smaller ones.

    ``words`` and ``mass`` are the sizes left and the words first wanted of
    them; a fraction that was ``x`` at first is ``base + slope * x`` by now.
    """
    size = item["size"]

    def turn(v: Column) -> Column:
        x, room, mass = v["x"], v["room"], v["mass"]
        rest = F.struct(room.alias("words"), (state["mass"] - size * item["x"]).alias("mass"))
        whole = (x <= EDGE) | (x >= 1 - EDGE)
        settled = _state(rest, state["base"], state["slope"], state["held"], _with(state, item, x >= 0.5))
        alone = _state(rest, state["base"], state["slope"], item.withField("x", x), state["done"])
        rise, fall = F.least(size * (1 - x), mass), F.least(size * x, room - mass)
        up = _chance(F.lit(SEED), item["who"], item["salt"], room) * (rise + fall) < fall
        moved = F.when(up, rise).otherwise(-fall)
        exchanged = let(F.struct(moved.alias("moved"), (x + moved / size).alias("now")), lambda e: after(v, e, rest))
        return F.when(whole, settled).when(room <= 0, alone).otherwise(exchanged)

    def after(v: Column, e: Column, rest: Column) -> Column:
        left, room = v["mass"] - e["moved"], v["room"]
        t = F.when(e["moved"] > 0, left / v["mass"]).otherwise((room - left) / (room - v["mass"]))
        t = F.greatest(F.lit(0.0), F.coalesce(t, F.lit(1.0)))
        gain = F.when(e["moved"] > 0, F.lit(0.0)).otherwise(1 - t)
        whole = (e["now"] <= EDGE) | (e["now"] >= 1 - EDGE)
        held = F.when(whole, state["held"]).otherwise(item.withField("x", e["now"]))
        done = F.when(whole, _with(state, item, e["now"] >= 0.5)).otherwise(state["done"])
        return _state(rest, gain + t * state["base"], t * state["slope"], held, done)

    x = F.least(F.lit(1.0), F.greatest(F.lit(0.0), state["base"] + state["slope"] * item["x"]))
    room = state["words"] - size
    mass = state["base"] * room + state["slope"] * (state["mass"] - size * item["x"])
    mass = F.least(room.cast("double"), F.greatest(F.lit(0.0), mass))
    return let(F.struct(x.alias("x"), room.alias("room"), mass.alias("mass")), turn)


def _with(state: Column, item: Column, up: Column) -> Column:
    return F.concat(state["done"], F.array(F.struct(item["row"].alias("row"), up.alias("up"))))


def _state(rest: Column, base: Column, slope: Column, held: Column, done: Column) -> Column:
    parts = {"words": rest["words"], "mass": rest["mass"], "base": base, "slope": slope, "held": held, "done": done}
    return F.struct(*[c.alias(name) for name, c in parts.items()]).cast(STATE)


def _reduce(items: DataFrame) -> DataFrame:
    """``source, n, s``: per block the decided documents and the one left."""
    blocks = items.groupBy("source", "n", "block").agg(F.sort_array(F.collect_list("item"), asc=False).alias("its"))
    words = F.aggregate("its", F.lit(0).cast("long"), lambda a, i: a + i["size"])
    mass = F.aggregate("its", F.lit(0.0), lambda a, i: a + i["size"] * i["x"])
    rest = F.struct(words.alias("words"), mass.alias("mass"))
    start = _state(rest, F.lit(0.0), F.lit(1.0), F.lit(None), F.array())
    return blocks.select("source", "n", F.aggregate("its", start, _step).alias("s"))


def rounded(rows: DataFrame) -> DataFrame:
    """``row, up`` for the rows ``(source, n, who, salt, row, size, x)`` whose
    ``x`` is a fraction: whether the document gets one copy more."""
    items = rows.select("source", "n", F.struct("size", "who", "salt", "row", "x").cast(ITEM).alias("item"))
    most = rows.agg(F.max("n")).first()[0] or 0
    done, level = [], 0
    while True:
        level += 1
        parts = F.greatest(F.lit(1), F.ceil(F.col("n") / FAN**level)).cast("long")
        block = F.pmod(F.xxhash64(F.lit(SEED + level), "item.who", "item.salt"), parts)
        state = materialize(_reduce(items.withColumn("block", block)), f"residuals-{level}")
        done.append(state.select(F.explode("s.done").alias("d")).select("d.*"))
        items = state.select("source", "n", F.col("s.held").alias("item")).filter("item IS NOT NULL")
        if most <= FAN**level:
            break
    done.append(items.select("item.row", (F.col("item.x") >= 0.5).alias("up")))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, place: Column | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, place``: how often
    each document is taken and the words that makes; ``place`` is what that
    expression says of the row."""
    rows = sizes(docs, place)
    goals = targets(rows, weights, most)
    goals = goals.select(F.col("source").alias("goal_source"), "n", "source_size", "target")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.join(goals, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    joined = joined.withColumn("whole", F.floor(wanted)).withColumn("x", wanted - F.floor(wanted))
    joined = materialize(joined.withColumn("who", F.xxhash64("doc_id", "source", "size")), "wanted")
    repeats = joined.groupBy(F.col("who").alias("again")).agg(F.count("*").alias("times")).filter("times > 1")
    open_rows = joined.filter("x > 0 AND size > 0").join(repeats, F.col("who") == F.col("again"), "left")
    open_rows = open_rows.withColumn("salt", F.when(F.col("again").isNotNull(), F.col("row")).otherwise(F.lit(0)).cast("long"))
    bits = rounded(open_rows).select(F.col("row").alias("bit_row"), "up")
    copies = F.col("whole") + F.coalesce(F.col("up").cast("long"), F.lit(0))
    decided = joined.join(bits, F.col("row") == F.col("bit_row"), "left").withColumn("copies", copies)
    return decided.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "place")


def mixed(docs: DataFrame, place: Column | None = None) -> DataFrame:
    """The documents, each as often as the mix takes it, with all columns.
    ``place`` as for ``tables.placed``."""
    docs, place, names = placed(docs, place)
    taken = mix(docs, place=place).filter("copies > 0").select(F.col("place").alias("taken"), F.col("copies").cast("int").alias("times"))
    packed = docs.select(F.struct(*names).alias("doc"), place.alias("place"))
    joined = packed.join(taken, F.col("place") == F.col("taken"))
    return joined.select("doc", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc.*")

"""Rating prediction from the most similar items a user rated.

Similarity is Pearson correlation over the users who rated both items. It is
built from sums (count, x, y, xx, yy, xy), so any part of the work can be
added to any other part. Ratings are first reduced by their item's mean,
rounded down: whole and half stars stay exact, and a large offset does not
drown the differences.

How the work is kept in bounds without leaving a pair out:

* A pair has a non-zero correlation only when at least two users rated both
  items. Users with a history of up to ``light`` items send each of their items
  once, with the rest of the history packed beside it; the pairs are written
  out and summed where all raters of the item have met. Items of more than
  ``HOT_RATERS`` raters do not meet: what they share is sent pair by pair,
  summed on the map side. A longer history is never paired with itself as a whole: it is looked up for the pairs the
  light users found, and paired only over items that a second long history
  holds too, in chunks of ``light`` items per task.
* A test pair starts from the shorter of two lists: the correlated items of its
  target, sent packed to the user, or the user's history.
* Neighbours with zero correlation have no weight. They are counted, not
  listed: a user's history size minus the neighbours with weight tells how
  many places of the ranking they take.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.operators.ratings import mean_by
from sparkmine.plans.skew import chunk_of, top_k
from sparkmine.plans.workspace import materialize

# Neighbours used, and the guess when neither side is known.
NEIGHBOURS = 10
DEFAULT_RATING = 3.0

LIGHT_HISTORY = 1000
HOT_RATERS = 20_000
PAIRS_PER_TASK = 1 << 20
# Zero is judged against the size of what was summed, so ratings of any scale
# and offset behave alike.
ROUNDING = 1e-11  # share of a sum of squares that rounding may leave of nothing
LEAST_CORR = 1e-9  # correlations nearer to zero are zero
CORR_DIGITS = 12  # ties are ties at this precision

SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def _sums(x: Column, y: Column) -> list[Column]:
    terms = [F.lit(1).cast("bigint"), x, y, x * x, y * y, x * y]
    return [F.sum(t).alias(name) for name, t in zip(SUMS, terms)]


def _merge(sums: DataFrame) -> DataFrame:
    return sums.groupBy("item_a", "item_b").agg(*[F.sum(c).alias(c) for c in SUMS])


def histories(train: DataFrame) -> DataFrame:
    """History size and mean rating of every user."""
    return train.groupBy("user_id").agg(F.count("*").alias("history"), F.avg("rating").alias("user_mean"))


def _long_users(train: DataFrame, light: int) -> DataFrame:
    return histories(train).filter(F.col("history") > light).select("user_id", "history")


def _marked(train: DataFrame, targets: DataFrame | None, hot: int) -> DataFrame:
    """Ratings that can matter, with a mark on those of target items and on those
    of items with more than ``hot`` raters. An item with a single rater cannot
    have two co-raters with any other item."""
    raters = train.groupBy("item_id").agg(F.count("*").alias("raters"), F.floor(F.avg("rating")).alias("centre"))
    raters = raters.filter("raters > 1").select("item_id", "centre", (F.col("raters") > hot).alias("hot"))
    if targets is None:
        items = raters.withColumn("wanted", F.lit(True))
    else:
        wanted = targets.select("item_id").distinct().withColumn("wanted", F.lit(True))
        items = raters.join(wanted, "item_id", "left").select(
            "item_id", "centre", "hot", F.coalesce("wanted", F.lit(False)).alias("wanted")
        )
    rating = (F.col("rating") - F.col("centre")).alias("rating")
    return train.select("user_id", "item_id", "rating").join(items, "item_id").select("user_id", "item_id", rating, "wanted", "hot")


def _pair_sums(rows: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Sums over pairs of a target item and another item, each pair once."""
    a = rows.filter("wanted").select(*on, F.col("item_id").alias("i"), F.col("rating").alias("ri"))
    b = other.select(*on, F.col("item_id").alias("j"), F.col("rating").alias("rj"), "wanted")
    pairs = a.join(b, on).filter((F.col("i") < F.col("j")) | (~F.col("wanted") & (F.col("i") > F.col("j"))))
    ordered = F.col("i") < F.col("j")
    return (
        pairs.select(
            F.least("i", "j").alias("item_a"),
            F.greatest("i", "j").alias("item_b"),
            F.when(ordered, F.col("ri")).otherwise(F.col("rj")).alias("x"),
            F.when(ordered, F.col("rj")).otherwise(F.col("ri")).alias("y"),
        )
        .groupBy("item_a", "item_b")
        .agg(*_sums(F.col("x"), F.col("y")))
    )


def _met_sums(rows: DataFrame) -> DataFrame:
    """Sums over pairs that hold a target item which is not hot. A history sends
    each such item with what comes after it: further ones, then all the others.
    Parts grow in number with the pairs, so a task sums about as many at any size."""
    leads = F.col("wanted") & ~F.col("hot")
    packed = (
        rows.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.sort_array(F.collect_list(F.struct((~leads).alias("behind"), "item_id", "rating"))).alias("all"),
            F.count(F.when(leads, True)).cast("int").alias("leading"),
        )
        .filter("leading > 0")
    )
    length = F.size("all").cast("bigint")
    n_pairs = packed.agg(F.sum(F.col("leading") * length)).first()[0] or 0
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n_pairs // PAIRS_PER_TASK))
    sent = packed.select(
        F.explode(F.sequence(F.lit(1), "leading")).alias("at"),
        F.col("all.item_id").alias("items"),
        F.col("all.rating").alias("ratings"),
    ).select(
        F.get("items", F.col("at") - 1).alias("i"),
        F.get("ratings", F.col("at") - 1).alias("x"),
        *[F.slice(c, F.col("at") + 1, F.size(c)).alias(c) for c in ("items", "ratings")],
    )
    met = sent.repartition(parts, "i").select("i", "x", F.posexplode("items").alias("at", "j"), "ratings")
    met = met.select("i", "x", "j", F.get("ratings", F.col("at")).alias("y"))
    sums = met.filter("i <> j").groupBy("i", "j").agg(*_sums(F.col("x"), F.col("y")))
    turned = {"sx": "sy", "sy": "sx", "sxx": "syy", "syy": "sxx"}
    ordered = F.col("i") < F.col("j")
    return sums.select(
        F.least("i", "j").alias("item_a"),
        F.greatest("i", "j").alias("item_b"),
        *[F.when(ordered, F.col(c)).otherwise(F.col(turned.get(c, c))).alias(c) for c in SUMS],
    )


def _light_sums(rows: DataFrame) -> DataFrame:
    met = _met_sums(rows)
    if rows.filter("wanted AND hot").isEmpty():
        return met
    rest = rows.filter("hot OR NOT wanted")
    return met.unionByName(_pair_sums(rest, rest, ["user_id"]))


def _looked_up(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """What the long histories add to pairs that are already known. Each pair
    starts from the item fewer long histories hold."""
    holders = rows.groupBy("item_id").agg(F.count("*").alias("holders"))
    for side in ("a", "b"):
        named = holders.select(F.col("item_id").alias(f"item_{side}"), F.col("holders").alias(f"n_{side}"))
        wanted = wanted.join(named, f"item_{side}")
    from_a = F.col("n_a") <= F.col("n_b")
    turned = wanted.select(
        "item_a",
        "item_b",
        from_a.alias("from_a"),
        F.when(from_a, F.col("item_a")).otherwise(F.col("item_b")).alias("near"),
        F.when(from_a, F.col("item_b")).otherwise(F.col("item_a")).alias("far"),
    )
    near = rows.select("user_id", F.col("item_id").alias("near"), F.col("rating").alias("r_near"))
    far = rows.select("user_id", F.col("item_id").alias("far"), F.col("rating").alias("r_far"))
    hits = turned.join(near, "near").join(far, ["user_id", "far"])
    x = F.when(F.col("from_a"), F.col("r_near")).otherwise(F.col("r_far"))
    y = F.when(F.col("from_a"), F.col("r_far")).otherwise(F.col("r_near"))
    return hits.groupBy("item_a", "item_b").agg(*_sums(x, y))


def _long_pairs(rows: DataFrame, light: int) -> DataFrame:
    """Pairs that two or more long histories share.

    Items held by a single long history cannot reach two co-raters here and
    are left out first. The rest of a history is cut into chunks; each task
    sees one chunk against one chunk.
    """
    shared = rows.groupBy("item_id").agg(F.count("*").alias("raters")).filter("raters > 1").select("item_id")
    held = rows.join(shared, "item_id", "left_semi")
    chunks = held.groupBy("user_id").agg(F.ceil(F.count("*") / F.lit(light)).alias("chunks"))
    held = held.join(chunks, "user_id").withColumn("chunk", chunk_of(F.col("item_id"), F.col("chunks")))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
    left = held.select("user_id", "item_id", "rating", "wanted", F.col("chunk").alias("ca"), every.alias("cb"))
    right = held.select("user_id", "item_id", "rating", "wanted", every.alias("ca"), F.col("chunk").alias("cb"))
    return _pair_sums(left, right, ["user_id", "ca", "cb"]).filter("n > 1")


def co_rating_sums(
    train: DataFrame, light: int = LIGHT_HISTORY, targets: DataFrame | None = None, hot: int = HOT_RATERS
) -> DataFrame:
    """Sums over the co-raters of every item pair with two or more of them;
    with ``targets`` only pairs that hold one of its items."""
    rows = materialize(_marked(train, targets, hot), "ratings")
    long_users = _long_users(train, light)
    if long_users.isEmpty():
        return _light_sums(rows).filter("n > 1")
    long_users = materialize(long_users.select("user_id"), "long-users")
    long_rows = rows.join(long_users, "user_id", "left_semi")
    light_rows = rows.join(long_users, "user_id", "left_anti")
    light_sums = materialize(_light_sums(light_rows), "pairs")
    completed = _merge(light_sums.unionByName(_looked_up(light_sums, long_rows))).filter("n > 1")
    only_long = _long_pairs(long_rows, light).join(light_sums, ["item_a", "item_b"], "left_anti")
    return completed.unionByName(only_long)


def co_raters(train: DataFrame, light: int = LIGHT_HISTORY) -> DataFrame:
    """Number of users who rated both items, for pairs with at least two."""
    return co_rating_sums(train, light).select("item_a", "item_b", F.col("n").alias("n_co"))


def _pearson() -> Column:
    n, sx, sy, sxx, syy, sxy = (F.col(c) for c in SUMS)
    cov = n * sxy - sx * sy
    vx = n * sxx - sx * sx
    vy = n * syy - sy * sy
    flat = (vx <= ROUNDING * n * sxx) | (vy <= ROUNDING * n * syy)
    # nullif keeps the division from failing on rows the guard sends to zero;
    # two roots, since a product of small variances would underflow.
    spread = F.sqrt(F.greatest(vx, F.lit(0.0))) * F.sqrt(F.greatest(vy, F.lit(0.0)))
    ratio = cov / F.nullif(spread, F.lit(0.0))
    zero = flat | (spread == 0) | (F.abs(ratio) < LEAST_CORR)
    return F.when(zero, F.lit(0.0)).otherwise(F.round(ratio, CORR_DIGITS))


def item_pearson(
    train: DataFrame, light: int = LIGHT_HISTORY, targets: DataFrame | None = None
) -> DataFrame:
    """Correlation of every item pair with two or more co-raters; with
    ``targets`` only pairs that hold one of its items. A pair that is not
    listed has correlation zero."""
    sums = co_rating_sums(train, light, targets)
    return sums.select("item_a", "item_b", F.col("n").alias("n_co"), _pearson().alias("corr"))


def _self_pairs(train: DataFrame) -> DataFrame:
    """An item correlates fully with itself unless all its ratings agree."""
    spread = F.max("rating") - F.min("rating")
    return (
        train.groupBy("item_id")
        .agg(spread.alias("spread"))
        .filter(F.col("spread") > 0)
        .select(F.col("item_id").alias("item_a"), F.col("item_id").alias("item_b"), F.lit(1.0).alias("corr"))
    )


def _weights(train: DataFrame, corr: DataFrame) -> DataFrame:
    listed = corr.filter(F.col("corr") != 0).select("item_a", "item_b", "corr")
    return listed.unionByName(_self_pairs(train))


def _best_first() -> list[Column]:
    return [F.desc("corr"), F.asc("neighbour")]


def _both_ways(weights: DataFrame) -> DataFrame:
    turned = weights.filter("item_a <> item_b").select(
        F.col("item_b").alias("item_a"), F.col("item_a").alias("item_b"), "corr"
    )
    return weights.unionByName(turned).select(
        F.col("item_a").alias("item_id"), F.col("item_b").alias("neighbour"), "corr"
    )


def _light_neighbours(test: DataFrame, train: DataFrame, weights: DataFrame, k: int, light: int) -> DataFrame:
    """Test pairs of users with histories of up to ``light`` items, each from the
    shorter of its two lists."""
    both = _both_ways(weights)
    counts = materialize(both.groupBy("item_id").agg(F.count("*").alias("correlated")), "correlated")
    asked = materialize(test.join(counts, "item_id"), "asked")
    shorter = F.col("correlated") <= F.col("history")
    few = counts.filter(F.col("correlated") <= light).select("item_id")
    lists = both.join(few, "item_id", "left_semi").groupBy("item_id").agg(F.collect_list(F.struct("neighbour", "corr")).alias("listed"))
    lists = lists.select("item_id", F.col("listed.neighbour").alias("near"), F.col("listed.corr").alias("corrs"))
    from_item = _in_history(asked.filter(shorter).join(lists, "item_id"), train, k)
    from_user = asked.filter(~shorter)
    if from_user.isEmpty():
        return from_item
    return from_item.unionByName(_in_weights(from_user, train, weights, k).select(from_item.columns))


def _in_history(test: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """The correlated items of each test pair that its user rated, matched and
    ranked inside the row."""
    users = test.select("user_id").distinct()
    held = train.join(users, "user_id", "left_semi").groupBy("user_id").agg(F.collect_list(F.struct("item_id", "rating")).alias("held"))
    held = held.select("user_id", F.col("held.item_id").alias("items"), F.col("held.rating").alias("ratings"))
    shared = F.transform(
        F.array_intersect("near", "items"),
        lambda n: F.struct(
            (-F.get("corrs", F.array_position("near", n).cast("int") - 1)).alias("minus"),
            n.alias("neighbour"),
            F.get("ratings", F.array_position("items", n).cast("int") - 1).alias("rating"),
        ),
    )
    found = test.join(held, "user_id").select("user_id", "item_id", "history", F.sort_array(shared).alias("shared"))
    return found.select(
        "user_id", "item_id", "history", F.size("shared").cast("bigint").alias("weighted"), F.posexplode(F.slice("shared", 1, k)).alias("at", "row")
    ).select(
        "user_id",
        "item_id",
        F.col("row.neighbour").alias("neighbour"),
        F.col("row.rating").alias("rating"),
        (-F.col("row.minus")).alias("corr"),
        (F.col("at") + 1).alias("place"),
        "weighted",
        "history",
    )


def _in_weights(test: DataFrame, train: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """Each test pair against the (bounded) history of its user."""
    history = train.select("user_id", F.col("item_id").alias("neighbour"), "rating")
    found = (
        test.join(history, "user_id")
        .withColumn("item_a", F.least("item_id", "neighbour"))
        .withColumn("item_b", F.greatest("item_id", "neighbour"))
        .join(weights, ["item_a", "item_b"])
    )
    group = Window.partitionBy("user_id", "item_id")
    return (
        found.withColumn("place", F.row_number().over(group.orderBy(*_best_first())))
        .withColumn("weighted", F.count("*").over(group))
        .filter(F.col("place") <= k)
    )


def _long_neighbours(test: DataFrame, train: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """Test pairs of users with long histories: start from the correlated
    items of the target and look the user's rating up."""
    history = train.select("user_id", F.col("item_id").alias("neighbour"), "rating")
    found = test.join(_both_ways(weights), "item_id").join(history, ["user_id", "neighbour"])
    found = materialize(found, "neighbours")
    counts = found.groupBy("user_id", "item_id").agg(F.count("*").alias("weighted"))
    best = top_k(found, ["user_id", "item_id"], _best_first(), k, "place")
    return best.join(counts, ["user_id", "item_id"])


def neighbours(
    test: DataFrame, train: DataFrame, corr: DataFrame, k: int = NEIGHBOURS, light: int = LIGHT_HISTORY
) -> DataFrame:
    """The neighbours with weight among the ``k`` best of each test pair, as
    ``(user_id, item_id, neighbour, rating, corr, rank)``.

    ``rank`` is the place among the user's whole history, highest correlation
    first and then lowest item id; places missing from the listing belong to
    neighbours of correlation zero.
    """
    users = histories(train).select("user_id", "history")
    items = train.select("item_id").distinct()
    pairs = test.select("user_id", "item_id").distinct()
    known = pairs.join(users, "user_id").join(items, "item_id", "left_semi")
    weights = materialize(_weights(train, corr), "weights")
    cols = ["user_id", "item_id", "neighbour", "rating", "corr", "place", "weighted", "history"]
    found = _light_neighbours(known.filter(F.col("history") <= light), train, weights, k, light).select(cols)
    if not _long_users(train, light).isEmpty():
        long = _long_neighbours(known.filter(F.col("history") > light), train, weights, k)
        found = found.unionByName(long.select(cols))
    behind_zeros = F.col("place") + F.col("history") - F.col("weighted")
    rank = F.when(F.col("corr") > 0, F.col("place")).otherwise(behind_zeros).cast("bigint")
    return (
        found.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("user_id", "item_id", "neighbour", "rating", "corr", "rank")
    )


def item_knn_predict(
    train: DataFrame,
    test: DataFrame,
    k: int = NEIGHBOURS,
    default: float = DEFAULT_RATING,
    light: int = LIGHT_HISTORY,
) -> DataFrame:
    """Predicted rating of every test pair, as ``(user_id, item_id, rating,
    prediction)``. Training pairs must be unique; see ``dedup_last``.

    Both sides known: mean of the neighbours' ratings weighted by correlation,
    or the user's mean when the weights cancel out. Only one side known: its
    mean. Neither: ``default``.
    """
    corr = item_pearson(train, light, test)
    near = neighbours(test, train, corr, k, light)
    score = near.groupBy("user_id", "item_id").agg(
        F.sum(F.col("rating") * F.col("corr")).alias("num"),
        F.sum(F.abs("corr")).alias("den"),
        F.sum(F.abs(F.col("rating") * F.col("corr"))).alias("size"),
    )
    usable = (F.abs("num") > ROUNDING * F.col("size")) & (F.col("den") > 0)
    score = score.select(
        "user_id", "item_id", F.when(usable, F.col("num") / F.nullif(F.col("den"), F.lit(0.0))).alias("score")
    )
    users = mean_by(train, "user_id", out="user_mean")
    items = mean_by(train, "item_id", out="item_mean")
    return (
        test.join(score, ["user_id", "item_id"], "left")
        .join(users, "user_id", "left")
        .join(items, "item_id", "left")
        .select(
            "user_id",
            "item_id",
            "rating",
            F.coalesce("score", "user_mean", "item_mean", F.lit(float(default))).alias("prediction"),
        )
    )

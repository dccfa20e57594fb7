"""Rating prediction from latent factors (alternating least squares)."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame

from sparkmine.operators.ratings import index_ids
from sparkmine.plans.workspace import work_root

# Model settings of the rating program.
ALS_SETTINGS = {"rank": 2, "iters": 30, "reg": 0.28, "blocks": 4, "seed": 1}
RATINGS_PER_BLOCK = 1_000_000  # beyond this many a block, there are more blocks
CHECKPOINT_EVERY = 10


def als_predict(
    train: DataFrame,
    test: DataFrame,
    rank: int = ALS_SETTINGS["rank"],
    iters: int = ALS_SETTINGS["iters"],
    reg: float = ALS_SETTINGS["reg"],
    blocks: int | None = None,
    seed: int = ALS_SETTINGS["seed"],
) -> DataFrame:
    """Predicted rating of every test pair whose user and item are known from
    training, as ``(user_id, item_id, rating, prediction)``; other pairs are
    dropped. Without ``blocks`` their number follows that of the ratings. Ids may be of any type; the solver sees row numbers, which Spark
    limits to 32 bits."""
    users = index_ids(train, "user_id").withColumnsRenamed({"id": "user_id", "idx": "user"})
    items = index_ids(train, "item_id").withColumnsRenamed({"id": "item_id", "idx": "item"})
    users = users.withColumn("user", users["user"].cast("int"))
    items = items.withColumn("item", items["item"].cast("int"))

    work_root(train.sparkSession)  # the solver cuts its lineage there
    if blocks is None:
        blocks = max(ALS_SETTINGS["blocks"], -(-train.count() // RATINGS_PER_BLOCK))

    def numbered(df: DataFrame) -> DataFrame:
        return df.join(users, "user_id").join(items, "item_id")

    solver = ALS(
        rank=rank,
        maxIter=iters,
        regParam=reg,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        seed=seed,
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        coldStartStrategy="drop",
        checkpointInterval=CHECKPOINT_EVERY,
    )
    model = solver.fit(numbered(train).select("user", "item", "rating"))
    scored = model.transform(numbered(test))
    return scored.select("user_id", "item_id", "rating", scored["prediction"].cast("double").alias("prediction"))

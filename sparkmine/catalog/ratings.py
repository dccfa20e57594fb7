"""Rating queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.operators import als, item_knn, ratings
from sparkmine.plans.workspace import materialize, new_path
from sparkmine.sources import fixtures as fx
from sparkmine.sources import readers
from sparkmine.sources.sinks import format_predictions

_LAST = """SELECT user_id, item_id, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id
            ORDER BY ord1 DESC, ord2 DESC, ord3 DESC, rating DESC) AS rn
  FROM fx_reviews WHERE {where}) t WHERE rn = 1"""
FX = (
    "fx_reviews AS (" + fx.REVIEWS_SQL.format(lineitem="lineitem", orders="orders") + "),\n"
    "fx_train AS (" + _LAST.format(where=fx.TRAIN_WHERE) + "),\n"
    "fx_test AS (" + _LAST.format(where=fx.TEST_WHERE) + ")"
)
# Pair sums straight from the definition: every co-rated pair, both users' rows.
PEARSON = FX + """,
sums AS (
  SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS n, sum(a.rating) AS sx, sum(b.rating) AS sy,
    sum(a.rating * a.rating) AS sxx, sum(b.rating * b.rating) AS syy, sum(a.rating * b.rating) AS sxy
  FROM fx_train a JOIN fx_train b ON a.user_id = b.user_id AND a.item_id <= b.item_id GROUP BY 1, 2),
pearson AS (
  SELECT item_a, item_b, n AS n_co,
    CASE WHEN n * sxy - sx * sy = 0 OR n * sxx - sx * sx = 0 OR n * syy - sy * sy = 0 THEN CAST(0 AS DOUBLE)
      ELSE round((n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)), 12) END AS corr
  FROM sums)
"""
# The whole ranking of every known test pair, neighbours of weight zero included.
NEAR = PEARSON + """,
ranked AS (
  SELECT t.user_id, t.item_id, h.item_id AS neighbour, h.rating, coalesce(p.corr, CAST(0 AS DOUBLE)) AS corr,
    row_number() OVER (PARTITION BY t.user_id, t.item_id
      ORDER BY coalesce(p.corr, CAST(0 AS DOUBLE)) DESC, h.item_id) AS rank
  FROM fx_test t JOIN fx_train h ON t.user_id = h.user_id
  LEFT JOIN pearson p ON p.item_a = least(t.item_id, h.item_id) AND p.item_b = greatest(t.item_id, h.item_id)
  WHERE t.item_id IN (SELECT item_id FROM fx_train)),
near AS (SELECT * FROM ranked WHERE rank <= 10)
"""
FRACTIONAL_SQL = """SELECT user_id, item_id,
  CASE WHEN item_id % 7 = 0 THEN 4.3::DOUBLE ELSE rating * 0.1::DOUBLE + 0.33::DOUBLE END AS rating FROM fx_train"""
_PREDICT = """,
score AS (
  SELECT user_id, item_id, sum(rating * corr) AS num, sum(abs(corr)) AS den FROM near GROUP BY 1, 2),
predicted AS (
  SELECT t.user_id, t.item_id, t.rating,
    coalesce(CASE WHEN abs(num) > 1e-9 AND den > 1e-9 THEN num / den END, um.m, im.m, CAST(3 AS DOUBLE)) AS prediction
  FROM fx_test t
  LEFT JOIN score s ON t.user_id = s.user_id AND t.item_id = s.item_id
  LEFT JOIN (SELECT user_id, avg(rating) AS m FROM fx_train GROUP BY 1) um ON um.user_id = t.user_id
  LEFT JOIN (SELECT item_id, avg(rating) AS m FROM fx_train GROUP BY 1) im ON im.item_id = t.item_id)
"""
PREDICT = NEAR + _PREDICT
# The same over fractional ratings, whose sums are not exact.
_ODD_PEARSON = FX.replace("fx_train AS", "whole_train AS").replace("fx_test AS", "whole_test AS") + """,
fx_train AS (""" + FRACTIONAL_SQL.replace("fx_train", "whole_train") + """),
fx_test AS (""" + FRACTIONAL_SQL.replace("fx_train", "whole_test") + """),
pearson AS (
  SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS n_co,
    CASE WHEN min(a.rating) = max(a.rating) OR min(b.rating) = max(b.rating) OR abs(corr(a.rating, b.rating)) < 1e-9
      THEN CAST(0 AS DOUBLE) ELSE round(corr(a.rating, b.rating), 12) END AS corr
  FROM fx_train a JOIN fx_train b ON a.user_id = b.user_id AND a.item_id <= b.item_id GROUP BY 1, 2)
"""
PREDICT_ODD = NEAR.replace(PEARSON, _ODD_PEARSON) + _PREDICT


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training ratings as a table of their own, as a user would hold them."""
    return materialize(fx.train(spark, sf_dir), "train")


def _test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(fx.test(spark, sf_dir), "test")


def src_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "ratings-csv")
    fx.train(spark, sf_dir).select("user_id", "item_id", "rating").write.option("header", True).csv(path)
    return readers.read_ratings(spark, path)


def cf_dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.train(spark, sf_dir)


def cf_user_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.mean_by(fx.train(spark, sf_dir), "user_id").withColumn("avg_rating", F.round("avg_rating", 6))


def cf_item_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.mean_by(fx.train(spark, sf_dir), "item_id").withColumn("avg_rating", F.round("avg_rating", 6))


def cf_cold_start_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.cold_start_class(fx.test(spark, sf_dir), fx.train(spark, sf_dir))


def semi_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test pairs whose user occurs in training."""
    return fx.test(spark, sf_dir).join(fx.train(spark, sf_dir).select("user_id"), "user_id", "left_semi")


def anti_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test pairs whose user does not occur in training."""
    return fx.test(spark, sf_dir).join(fx.train(spark, sf_dir).select("user_id"), "user_id", "left_anti")


def idx_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.index_ids(fx.train(spark, sf_dir), "user_id")


def cf_co_raters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_knn.co_raters(_train(spark, sf_dir))


def cf_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_knn.item_pearson(_train(spark, sf_dir))


def cf_pearson_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations of small fractional ratings; one item is rated 4.3 by all."""
    train = fx.train(spark, sf_dir)
    odd = F.when(F.col("item_id") % 7 == 0, F.lit(4.3)).otherwise(F.col("rating") * 0.1 + 0.33)
    corr = item_knn.item_pearson(materialize(train.withColumn("rating", odd), "fractional"))
    return corr.withColumn("corr", F.round("corr", 6) + 0.0)


def cf_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _train(spark, sf_dir)
    test = _test(spark, sf_dir)
    return item_knn.neighbours(test, train, item_knn.item_pearson(train, targets=test))


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_knn.item_knn_predict(_train(spark, sf_dir), _test(spark, sf_dir))


def cf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predicted(spark, sf_dir).withColumn("prediction", F.round("prediction", 6))


def rpt_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for all test pairs, as report rows in order."""
    return format_predictions(_predicted(spark, sf_dir)).withColumn("prediction", F.round("prediction", 6))


def join_actual_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test ratings beside their predictions."""
    test = _test(spark, sf_dir)
    pred = item_knn.item_knn_predict(_train(spark, sf_dir), test).select("user_id", "item_id", "prediction")
    return ratings.join_predictions(test, materialize(pred, "predictions")).withColumn("prediction", F.round("prediction", 6))


def eval_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.error_histogram(_predicted(spark, sf_dir))


def eval_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.rmse(_predicted(spark, sf_dir)).withColumn("rmse", F.round("rmse", 6))


def als_scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which test pairs the factor model scores."""
    pred = als.als_predict(_train(spark, sf_dir), _test(spark, sf_dir))
    return pred.filter(F.col("prediction").isNotNull()).select("user_id", "item_id", "rating")


def als_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the evaluation holds whatever the solver draws: the pairs scored, the
    sum over the error classes, and an error within the scale of the ratings."""
    pred = materialize(als.als_predict(_train(spark, sf_dir), _test(spark, sf_dir)), "als")
    figures = materialize(ratings.evaluate(pred), "evaluation")
    classed = F.sum(F.when(F.col("measure") != "rmse", F.col("value"))).cast("bigint")
    error = F.max(F.when(F.col("measure") == "rmse", F.col("value")))
    scored = pred.agg(F.count("*").alias("n_scored"), F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).alias("own"))
    both = scored.crossJoin(figures.agg(classed.alias("n_classed"), error.alias("rmse")))  # single rows
    return both.select("n_scored", "n_classed", ((F.abs(F.col("rmse") - F.col("own")) < 1e-9) & (F.col("rmse") < 4)).alias("rmse_holds"))


def als_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error classes of the factor model on ratings that are a product of a
    user's and an item's value."""
    truth = (1 + F.col("user_id") % 4 * 0.25) * (1 + F.col("item_id") % 5 * 0.5)
    known, asked = (materialize(f(spark, sf_dir).withColumn("rating", truth), "products") for f in (fx.train, fx.test))
    return ratings.error_histogram(materialize(als.als_predict(known, asked, rank=1, reg=1e-4), "als"))


def _odd(rows: DataFrame) -> DataFrame:
    odd = F.when(F.col("item_id") % 7 == 0, F.lit(4.3)).otherwise(F.col("rating") * 0.1 + 0.33)
    return materialize(rows.withColumn("rating", odd), "fractional")


def cf_predict_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions from small fractional ratings."""
    pred = item_knn.item_knn_predict(_odd(fx.train(spark, sf_dir)), _odd(fx.test(spark, sf_dir)))
    return pred.withColumn("rating", F.round("rating", 10)).withColumn("prediction", F.round("prediction", 10))


def src_ratings_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings from a file with further fields."""
    path = new_path(spark, "ratings-wide")
    wide = fx.train(spark, sf_dir).select("user_id", "item_id", "rating", F.lit("x").alias("note"), F.lit(7).alias("stamp"))
    wide.write.option("header", True).csv(path)
    return readers.read_ratings(spark, path)


def cf_last_over_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of two files of which the second rates some pairs again."""
    path = new_path(spark, "ratings-files")
    rows = fx.train(spark, sf_dir).select("user_id", "item_id", "rating")
    again = rows.filter("item_id % 3 = 0").withColumn("rating", 6 - F.col("rating"))
    for name, part in (("a", rows), ("b", again)):
        part.write.option("header", True).csv(f"{path}/{name}")
    return ratings.dedup_last(readers.read_placed_ratings(spark, f"{path}/*"), ["user_id", "item_id"], "rating", ["place"])


QUERIES = {
    f.__name__: f
    for f in (
        src_ratings,
        cf_dedup_last,
        cf_user_mean,
        cf_item_mean,
        cf_cold_start_class,
        semi_known,
        anti_unknown,
        idx_users,
        cf_co_raters,
        cf_pearson,
        cf_pearson_fractional,
        cf_neighbours,
        cf_predict,
        rpt_predictions,
        join_actual_pred,
        eval_histogram,
        eval_rmse,
        als_scored_pairs,
        als_evaluation,
        als_planted,
        cf_predict_fractional,
        src_ratings_wide,
        cf_last_over_files,
    )
}

SQL = {
    "als_evaluation": f"""WITH {FX} SELECT count(*) AS n_scored, count(*) AS n_classed, true AS rmse_holds FROM fx_test
WHERE user_id IN (SELECT user_id FROM fx_train) AND item_id IN (SELECT item_id FROM fx_train)""",
    "src_ratings": f"""WITH {FX} SELECT CAST(user_id AS VARCHAR) AS user_id,
CAST(item_id AS VARCHAR) AS item_id, rating FROM fx_train""",
    "src_ratings_wide": f"""WITH {FX} SELECT CAST(user_id AS VARCHAR) AS user_id,
CAST(item_id AS VARCHAR) AS item_id, rating FROM fx_train""",
    "cf_last_over_files": f"""WITH {FX} SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id,
CASE WHEN item_id % 3 = 0 THEN 6 - rating ELSE rating END AS rating FROM fx_train""",
    "als_planted": f"""WITH {FX}, scored AS (
  SELECT count(*) AS n FROM fx_test
  WHERE user_id IN (SELECT user_id FROM fx_train) AND item_id IN (SELECT item_id FROM fx_train))
SELECT bucket, CASE WHEN bucket = 0 THEN n ELSE 0 END AS n
FROM (SELECT CAST(unnest([0, 1, 2, 3, 4]) AS BIGINT) AS bucket) b, scored""",
    "cf_predict_fractional": f"""WITH {PREDICT_ODD} SELECT user_id, item_id, round(rating, 10) AS rating,
round(prediction, 10) AS prediction FROM predicted""",
    "cf_dedup_last": f"WITH {FX} SELECT user_id, item_id, rating FROM fx_train",
    "cf_user_mean": f"WITH {FX} SELECT user_id, round(avg(rating), 6) AS avg_rating FROM fx_train GROUP BY 1",
    "cf_item_mean": f"WITH {FX} SELECT item_id, round(avg(rating), 6) AS avg_rating FROM fx_train GROUP BY 1",
    "cf_cold_start_class": f"""WITH {FX} SELECT user_id, item_id,
user_id IN (SELECT user_id FROM fx_train) AS known_user,
item_id IN (SELECT item_id FROM fx_train) AS known_item FROM fx_test""",
    "semi_known": f"""WITH {FX} SELECT user_id, item_id, rating FROM fx_test
WHERE user_id IN (SELECT user_id FROM fx_train)""",
    "anti_unknown": f"""WITH {FX} SELECT user_id, item_id, rating FROM fx_test
WHERE user_id NOT IN (SELECT user_id FROM fx_train)""",
    "idx_users": f"""WITH {FX} SELECT user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS idx
FROM (SELECT DISTINCT user_id FROM fx_train) t""",
    "cf_co_raters": f"WITH {PEARSON} SELECT item_a, item_b, n_co FROM pearson WHERE n_co > 1 AND item_a < item_b",
    "cf_pearson": f"WITH {PEARSON} SELECT item_a, item_b, n_co, corr FROM pearson WHERE n_co > 1 AND item_a < item_b",
    "cf_neighbours": f"""WITH {NEAR} SELECT user_id, item_id, neighbour, rating, corr, rank
FROM near WHERE corr <> 0""",
    "cf_predict": f"""WITH {PREDICT} SELECT user_id, item_id, rating, round(prediction, 6) AS prediction
FROM predicted""",
    "rpt_predictions": f"WITH {PREDICT} SELECT user_id, item_id, round(prediction, 6) AS prediction FROM predicted",
    "join_actual_pred": f"WITH {PREDICT} SELECT user_id, item_id, rating, round(prediction, 6) AS prediction FROM predicted",
    "cf_pearson_fractional": f"""WITH {FX}, odd AS ({FRACTIONAL_SQL})
SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS n_co,
  CASE WHEN min(a.rating) = max(a.rating) OR min(b.rating) = max(b.rating) THEN CAST(0 AS DOUBLE)
    ELSE round(corr(a.rating, b.rating), 6) + 0.0 END AS corr
FROM odd a JOIN odd b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2 HAVING count(*) > 1""",
    "eval_histogram": f"""WITH {PREDICT}
SELECT b.bucket, count(p.rating) AS n
FROM (SELECT CAST(unnest([0, 1, 2, 3, 4]) AS BIGINT) AS bucket) b
LEFT JOIN predicted p ON least(CAST(floor(abs(p.rating - p.prediction)) AS BIGINT), 4) = b.bucket
GROUP BY b.bucket""",
    "eval_rmse": f"""WITH {PREDICT}
SELECT round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse FROM predicted""",
    "als_scored_pairs": f"""WITH {FX} SELECT user_id, item_id, rating FROM fx_test
WHERE user_id IN (SELECT user_id FROM fx_train) AND item_id IN (SELECT item_id FROM fx_train)""",
}

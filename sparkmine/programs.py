"""The analyses end to end: read files, compute, write the report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmine.operators import als, cluster, item_knn, itemsets, layout, ratings, survey, text
from sparkmine.plans.workspace import configure, materialize
from sparkmine.sources import readers, sinks
from sparkmine.streaming import bloom as bloom_stream
from sparkmine.streaming import reservoir as reservoir_stream
from sparkmine.streaming.state import to_console

# Seeds of the clustering programs, partitions of the report.
LLOYD_SEED = 20181031
ML_SEED = 42
REPORT_PARTITIONS = 2


def salary_counts(spark: SparkSession, source: str, target: str) -> None:
    """Answers with a salary: the total, then each country."""
    sinks.write_counts(survey.salary_counts(readers.read_survey(configure(spark), source)), target)


def partition_report(spark: SparkSession, source: str, target: str, n: int = REPORT_PARTITIONS) -> None:
    """Rows per partition when dealt evenly and when hashed by country."""
    rows = readers.read_survey(configure(spark), source)
    even, keyed = layout.partition_profile(rows, n), layout.partition_profile(rows, n, "country")
    sinks.write_partition_report(even.unionByName(keyed), target)


def salary_statistics(spark: SparkSession, source: str, target: str) -> None:
    """Count, smallest, largest and mean annual salary per country."""
    sinks.write_salary_stats(survey.salary_stats(readers.read_survey(configure(spark), source)), target)


def _last_per_pair(rows: DataFrame) -> DataFrame:
    """The last rating of each pair, by file name and line."""
    return ratings.dedup_last(rows, ["user_id", "item_id"], "rating", ["place"])


def predict_by_factors(spark: SparkSession, train: str, test: str, target: str, **settings) -> DataFrame:
    """Factor-model predictions to ``target``; returns the error figures."""
    known, asked = (readers.read_ratings(configure(spark), p) for p in (train, test))
    pred = materialize(als.als_predict(known, asked, **settings), "predictions")
    sinks.write_predictions(pred, target)
    # Every actual rating meets every prediction of its pair.
    return ratings.evaluate(ratings.join_predictions(asked, pred.select("user_id", "item_id", "prediction")))


def predict_by_items(spark: SparkSession, train: str, test: str, target: str, **settings) -> DataFrame:
    """Item-neighbour predictions to ``target``; returns the error figures."""
    known, asked = (
        materialize(_last_per_pair(readers.read_placed_ratings(configure(spark), p)), "ratings") for p in (train, test)
    )
    pred = materialize(item_knn.item_knn_predict(known, asked, **settings), "predictions")
    sinks.write_predictions(pred, target)
    return ratings.evaluate(pred)


def mine_itemsets(spark: SparkSession, source: str, support: int, target: str) -> None:
    """All itemsets in at least ``support`` baskets, any size."""
    found = itemsets.frequent_itemsets(readers.read_baskets(configure(spark), source), support)
    sinks.write_itemsets(found, target)


def _write_clusters(docs: DataFrame, assigned: DataFrame, algorithm: str, target: str) -> None:
    report = cluster.cluster_report(assigned, text.document_tf(docs), algorithm)
    sinks.write_cluster_json(report, target, {"wssse": "WSEEE"})


def _documents(spark: SparkSession, source: str) -> DataFrame:
    return materialize(readers.read_documents(configure(spark), source), "documents")


def cluster_by_words(
    spark: SparkSession, source: str, features: str, k: int, iters: int, target: str, seed: int = LLOYD_SEED
) -> None:
    """Lloyd iterations on word counts (``W``) or TF-IDF (``T``)."""
    kind = {"w": "tf", "t": "tfidf"}[features.lower()]
    docs = _documents(spark, source)
    assigned, _ = cluster.lloyd(text.vectorize(docs, kind), k, iters, seed)
    _write_clusters(docs, assigned, "K-means", target)


def cluster_by_model(
    spark: SparkSession, source: str, algorithm: str, k: int, iters: int, target: str, seed: int = ML_SEED
) -> None:
    """Spark ML k-means (``K``) or bisecting k-means (``B``) on TF-IDF."""
    solver, name = {
        "k": (cluster.ml_kmeans, "K-Means"),
        "b": (cluster.ml_bisecting, "Bisecting K-Means"),
    }[algorithm.lower()]
    docs = _documents(spark, source)
    assigned, _ = solver(text.ml_tfidf(docs), k, iters, seed)
    _write_clusters(docs, materialize(assigned.select("id", "cluster", "dist"), "assigned"), name, target)


def sample_posts(
    spark: SparkSession,
    source: str,
    state_path: str,
    available_now: bool = False,
    emit: Callable[[DataFrame, int], None] = to_console,
) -> StreamingQuery:
    """Follow posts on the track word: sample, hot tags, mean length."""
    posts = readers.read_posts_stream(configure(spark), source, track=readers.TRACK_WORD)
    return reservoir_stream.run_reservoir_stream(posts, state_path, available_now=available_now, emit=emit)


def score_posts(
    spark: SparkSession,
    source: str,
    state_path: str,
    available_now: bool = False,
    emit: Callable[[DataFrame, int], None] = to_console,
) -> StreamingQuery:
    """Follow posts on the track word: score of the small Bloom filter."""
    posts = readers.read_posts_stream(configure(spark), source, track=readers.TRACK_WORD)
    tags = bloom_stream.tag_positions(posts)
    return bloom_stream.run_bloom_stream(tags, state_path, available_now=available_now, emit=emit)

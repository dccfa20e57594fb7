"""Writers. Each takes the report rows made by a ``format_*`` function and
writes them from the tasks; ordered rows go to part files in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.itemsets import format_itemsets
from sparkmine.operators.survey import format_salary_counts, format_salary_stats


def write_counts(counts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``Total,n`` first, then ``country,n``."""
    format_salary_counts(counts).write.mode(mode).csv(path)


def write_partition_report(profile: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``layout,partition,rows`` lines."""
    profile.orderBy(F.desc("layout"), "partition_id").write.mode(mode).csv(path)


def write_salary_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``country,n,min,max,mean`` lines in country order."""
    format_salary_stats(stats).write.mode(mode).csv(path)


def format_predictions(pred: DataFrame) -> DataFrame:
    return pred.select("user_id", "item_id", "prediction").orderBy("user_id", "item_id")


def write_predictions(pred: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``user,item,prediction`` lines in user and item order."""
    format_predictions(pred).write.mode(mode).csv(path)


def write_itemsets(sets: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per set size, one ``(a,b)`` line per set, in order."""
    format_itemsets(sets).write.mode(mode).partitionBy("size").text(path)


def format_cluster_json(report: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """The report as one JSON text; ``renames`` maps top-level field names."""
    renames = {"clusters": "Clusters"} | (renames or {})
    fields = [F.col(c).alias(renames.get(c, c)) for c in report.columns]
    return report.select(F.to_json(F.struct(*fields)).alias("value"))


def write_cluster_json(
    report: DataFrame, path: str, renames: dict[str, str] | None = None, mode: str = "overwrite"
) -> None:
    format_cluster_json(report, renames).write.mode(mode).text(path)

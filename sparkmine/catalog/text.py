"""Text and clustering queries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions.text import tokens
from sparkmine.operators import cluster, text
from sparkmine.plans.workspace import new_path
from sparkmine.sources import fixtures as fx
from sparkmine.sources import readers

# Seeds of the clustering programs.
LLOYD_SEED = 20181031
ML_SEED = 42
K, ITERS = 5, 20
ML_K, ML_ITERS = 8, 20
SMALL, NEAR_SPOT = 1e-4, 0.1  # factors on vectors: short ones, and those around a planted spot

DOCS = """docs AS (SELECT doc_id, rtrim(lower(text), ' ') AS line, lower(text) AS text FROM documents),
words AS (SELECT doc_id, unnest(string_split(line, ' ')) AS term FROM docs WHERE NOT (line = '' AND text <> ''))"""
TF = DOCS + """,
tf AS (SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS weight FROM words GROUP BY 1, 2)"""
IDF = TF + """,
idf AS (SELECT term, count(*) AS df, ln((SELECT count(*) FROM docs) + 1.0::DOUBLE) - ln(count(*) + 1.0::DOUBLE) AS idf
        FROM tf GROUP BY term)"""

_SLOT = "CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % 1048576"
EMBED = """v AS (SELECT vec_id AS id, unnest(range(len(embedding))) AS idx,
                 CAST(unnest(embedding) AS DOUBLE) AS val FROM embeddings),
ids AS (SELECT vec_id AS id FROM embeddings)"""
TF_VECTORS = DOCS + f""",
v AS (SELECT doc_id AS id, {_SLOT} AS idx, CAST(count(*) AS DOUBLE) AS val FROM words GROUP BY 1, 2),
ids AS (SELECT doc_id AS id FROM docs)"""
TFIDF_VECTORS = DOCS + f""",
v0 AS (SELECT doc_id AS id, {_SLOT} AS idx, CAST(count(*) AS DOUBLE) AS val FROM words GROUP BY 1, 2),
w AS (SELECT idx, ln(((SELECT count(*) FROM docs) + 1) / (count(*) + 1)::DOUBLE) AS idf FROM v0 GROUP BY idx),
v AS (SELECT id, idx, val * idf AS val FROM v0 JOIN w USING (idx)),
ids AS (SELECT doc_id AS id FROM docs)"""


def _lloyd_sql(vectors: str, k: int, iters: int) -> str:
    """Assignments ``a0`` .. and centres ``c0`` .. of every round, one after
    the other."""
    ctes = [
        vectors,
        "norms AS (SELECT i.id, coalesce(sum(v.val * v.val), 0) AS sq FROM ids i LEFT JOIN v ON v.id = i.id GROUP BY 1)",
        f"""picks AS (SELECT id, row_number() OVER (ORDER BY prio, id) - 1 AS cluster FROM (
  SELECT id, md5('{LLOYD_SEED}:' || id) AS prio FROM ids ORDER BY 2, 1 LIMIT {k}) p)""",
        "c0 AS (SELECT p.cluster, v.idx, v.val FROM picks p JOIN v ON v.id = p.id)",
        "l0 AS (SELECT cluster FROM picks)",
    ]
    for i in range(iters + 1):
        ctes.append(f"""a{i} AS (
  SELECT id, min(cluster) AS cluster, arg_min(dist, cluster) AS dist
  FROM (SELECT *, min(dist) OVER (PARTITION BY id) AS least FROM (
    SELECT n.id, l.cluster, greatest(n.sq - 2 * coalesce(d.dot, 0) + coalesce(s.sq, 0), 0) AS dist,
      n.sq + coalesce(s.sq, 0) AS scale
    FROM norms n CROSS JOIN l{i} l
    LEFT JOIN (SELECT v.id, c.cluster, sum(v.val * c.val) AS dot FROM v JOIN c{i} c ON c.idx = v.idx GROUP BY 1, 2) d
      ON d.id = n.id AND d.cluster = l.cluster
    LEFT JOIN (SELECT cluster, sum(val * val) AS sq FROM c{i} GROUP BY 1) s ON s.cluster = l.cluster) x) y
  WHERE dist <= least + 1e-9 * scale GROUP BY id)""")
        if i < iters:
            ctes.append(f"l{i + 1} AS (SELECT cluster, count(*) AS size FROM a{i} GROUP BY 1)")
            ctes.append(f"""c{i + 1} AS (SELECT a.cluster, v.idx, sum(v.val) / any_value(l.size) AS val
  FROM a{i} a JOIN v ON v.id = a.id JOIN l{i + 1} l ON l.cluster = a.cluster GROUP BY 1, 2)""")
    return ",\n".join(ctes)


_PROFILE = """SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS size, round(sum(dist), 4) AS error
FROM a{n} GROUP BY 1"""
_TERMS = """,
counts AS (SELECT a.cluster, w.term, count(*) AS n FROM a{n} a JOIN words w ON w.doc_id = a.id GROUP BY 1, 2),
top AS (SELECT cluster, term, n, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, term) AS rank FROM counts
        QUALIFY rank <= 10)"""


def src_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as lines, read back, and counted by content."""
    path = new_path(spark, "documents-text")
    line = F.regexp_replace("text", "[\\r\\n]", " ")
    fx.docs(spark, sf_dir).select(line.alias("value")).write.text(path)
    lines = readers.read_documents(spark, path)
    return lines.groupBy(F.md5("text").alias("line_id"), F.size(tokens("text")).alias("n_tokens")).agg(
        F.count("*").alias("n_lines")
    )


def fn_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.docs(spark, sf_dir).select("doc_id", tokens("text").alias("words"))
    return docs.select(
        "doc_id", F.size("words").cast("bigint").alias("n_tokens"), F.md5(F.array_join("words", "|")).alias("words_id")
    )


def txt_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.document_tf(fx.docs(spark, sf_dir))


def _tf_and_size(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    docs = fx.docs(spark, sf_dir)
    return text.document_tf(docs), docs.count()


def txt_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.idf(*_tf_and_size(spark, sf_dir)).withColumn("idf", F.round("idf", 6))


def txt_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.tfidf(*_tf_and_size(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


def _embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.dense_vectors(fx.vectors(spark, sf_dir), "id", "vec")


def _first_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _embedded(spark, sf_dir)
    return cluster.assign_nearest(vectors, cluster.pick_centres(vectors, K, LLOYD_SEED))


def assign_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_round(spark, sf_dir).select("id", "cluster", F.round("dist", 4).alias("dist"))


def centroid_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    centres = cluster.update_centres(_first_round(spark, sf_dir))
    return centres.select("cluster", F.col("idx").cast("bigint").alias("idx"), F.round("val", 6).alias("val"))


def _profile(assigned: DataFrame) -> DataFrame:
    return cluster.cluster_profile(assigned).withColumn("error", F.round("error", 4))


def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(_first_round(spark, sf_dir))


def cluster_wssse(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = cluster.cluster_profile(_first_round(spark, sf_dir))
    return cluster.wssse(profile).withColumn("wssse", F.round("wssse", 4))


def _clustered_docs(spark: SparkSession, sf_dir: str, features: str) -> DataFrame:
    vectors = text.vectorize(fx.docs(spark, sf_dir), features)
    return cluster.lloyd(vectors, K, ITERS, LLOYD_SEED)[0]


def kmeans_lloyd_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(cluster.lloyd(_embedded(spark, sf_dir), K, ITERS, LLOYD_SEED)[0])


def kmeans_lloyd_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(_clustered_docs(spark, sf_dir, "tf"))


def kmeans_lloyd_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(_clustered_docs(spark, sf_dir, "tfidf"))


def cluster_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = cluster.top_terms(_clustered_docs(spark, sf_dir, "tf"), fx.docs(spark, sf_dir))
    return top.withColumn("rank", F.col("rank").cast("bigint"))


def rpt_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with its clusters listed one per row."""
    report = cluster.cluster_report(_clustered_docs(spark, sf_dir, "tfidf"), fx.docs(spark, sf_dir), "K-means")
    rows = report.select("algorithm", "wssse", F.explode("clusters").alias("c"))
    return rows.select(
        "algorithm",
        F.round("wssse", 4).alias("wssse"),
        "c.id",
        "c.size",
        F.round("c.error", 4).alias("error"),
        F.array_join("c.terms", " ").alias("terms"),
    )


def kmeans_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of Spark ML's k-means: their number, the documents in them, and those
    that lie in the cluster of the nearest centre."""
    assigned, centres = cluster.ml_kmeans(text.ml_tfidf(fx.docs(spark, sf_dir)), ML_K, ML_ITERS, ML_SEED)
    own = assigned.withColumnsRenamed({"cluster": "own", "dist": "own_dist"})
    again = cluster.assign_nearest(own, centres, list(range(ML_K)))
    near = F.abs(F.col("own_dist") - F.col("dist")) <= 1e-6 * (1 + F.col("dist"))
    counts = again.agg(F.count("*").alias("n_docs"), F.count(F.when(near, True)).alias("n_nearest"))
    profile = cluster.cluster_profile(assigned).agg(F.count("*").alias("clusters"), F.sum("size").alias("sizes"))
    return profile.crossJoin(counts)  # single rows


def bisecting_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves of Spark ML's bisecting k-means, and the documents in them; every split
    lowers the error, so it is below that of the first split."""
    features = text.ml_tfidf(fx.docs(spark, sf_dir))
    split, one = (cluster.cluster_profile(cluster.ml_bisecting(features, k, ML_ITERS, ML_SEED)[0]) for k in (ML_K, 2))
    leaves = split.agg(F.count("*").alias("clusters"), F.sum("size").alias("n_docs"), F.sum("error").alias("after"))
    return leaves.crossJoin(one.agg(F.sum("error").alias("before"))).select("clusters", "n_docs", (F.col("after") < F.col("before")).alias("lower"))  # single rows


def assign_nearest_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest centres of vectors a ten-thousandth as long."""
    small = F.transform("vec", lambda x: x * SMALL).alias("vec")
    vectors = text.dense_vectors(fx.vectors(spark, sf_dir).select("id", small), "id", "vec")
    found = cluster.assign_nearest(vectors, cluster.pick_centres(vectors, K, LLOYD_SEED))
    return found.select("id", "cluster", F.round("dist", 12).alias("dist"))


def _planted_groups(spark: SparkSession, sf_dir: str, spot: list, solver) -> DataFrame:
    """Sizes and errors of clusters over vectors in ``ML_K`` planted groups, by
    group; a cluster that mixes groups or a group that is split shows as
    further rows. ``spot`` says where a vector's group lies."""
    around = F.transform("vec", lambda x: x * NEAR_SPOT)
    vectors = fx.vectors(spark, sf_dir).select("id", array_to_vector(F.concat(F.array(*spot), around)).alias("features"))
    assigned = solver(vectors, ML_K, ML_ITERS, ML_SEED)[0]
    found = assigned.groupBy("cluster", (F.col("id") % ML_K).alias("planted")).agg(F.count("*").alias("size"), F.sum("dist").alias("error"))
    return found.select("planted", "size", F.round("error", 4).alias("error"))


def kmeans_ml_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups at equal distances from each other."""
    spot = [F.when(F.col("id") % ML_K == g, F.lit(20.0)).otherwise(0.0) for g in range(ML_K)]
    return _planted_groups(spark, sf_dir, spot, cluster.ml_kmeans)


def bisecting_ml_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups that fall apart into halves, quarters and eighths."""
    spot = [F.when(F.expr(f"id % {ML_K} div {of} % 2 = 1"), F.lit(apart)).otherwise(0.0) for of, apart in ((4, 500.0), (2, 50.0), (1, 5.0))]
    return _planted_groups(spark, sf_dir, spot, cluster.ml_bisecting)


QUERIES = {
    f.__name__: f
    for f in (
        src_documents,
        fn_tokenize,
        txt_tf,
        txt_idf,
        txt_tfidf,
        assign_nearest,
        centroid_update,
        cluster_profile,
        cluster_wssse,
        kmeans_lloyd_embed,
        kmeans_lloyd_tf,
        kmeans_lloyd_tfidf,
        cluster_top_terms,
        rpt_clusters,
        kmeans_ml,
        bisecting_ml,
        assign_nearest_scaled,
        kmeans_ml_groups,
        bisecting_ml_groups,
    )
}

_FIRST = _lloyd_sql(EMBED, K, 0)
_FIRST_SMALL = _lloyd_sql(EMBED.replace("AS DOUBLE) AS val", f"AS DOUBLE) * {SMALL}::DOUBLE AS val"), K, 0)
# Spots are the same for all of a group, so they add nothing to its error.
_GROUPS = f"""WITH {EMBED},
mid AS (SELECT id % {ML_K} AS planted, idx, avg(val * {NEAR_SPOT}::DOUBLE) AS val FROM v GROUP BY 1, 2)
SELECT m.planted, count(DISTINCT v.id) AS size, round(sum((v.val * {NEAR_SPOT}::DOUBLE - m.val) ** 2), 4) AS error
FROM v JOIN mid m ON m.planted = v.id % {ML_K} AND m.idx = v.idx GROUP BY 1"""
_TF_LLOYD = _lloyd_sql(TF_VECTORS, K, ITERS)
_TFIDF_LLOYD = _lloyd_sql(TFIDF_VECTORS, K, ITERS)

SQL = {
    "kmeans_ml": f"""SELECT CAST({ML_K} AS BIGINT) AS clusters, count(*) AS sizes, count(*) AS n_docs, count(*) AS n_nearest FROM documents""",
    "bisecting_ml": f"""SELECT CAST({ML_K} AS BIGINT) AS clusters, count(*) AS n_docs, true AS lower FROM documents""",
    "src_documents": r"""WITH lines AS (
  SELECT regexp_replace(lower(text), '[\r\n]', ' ', 'g') AS line FROM documents)
SELECT md5(line) AS line_id, CAST(CASE WHEN rtrim(line, ' ') = '' AND line <> '' THEN 0
  ELSE len(string_split(rtrim(line, ' '), ' ')) END AS INTEGER) AS n_tokens, count(*) AS n_lines
FROM lines GROUP BY 1, 2""",
    "fn_tokenize": f"""WITH {DOCS}
SELECT doc_id, CASE WHEN line = '' AND text <> '' THEN 0 ELSE len(string_split(line, ' ')) END AS n_tokens,
  md5(CASE WHEN line = '' THEN '' ELSE array_to_string(string_split(line, ' '), '|') END) AS words_id
FROM docs""",
    "txt_tf": f"WITH {TF} SELECT doc_id, term, weight FROM tf",
    "txt_idf": f"WITH {IDF} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "txt_tfidf": f"WITH {IDF} SELECT doc_id, term, round(weight * idf, 6) AS weight FROM tf JOIN idf USING (term)",
    "assign_nearest": f"WITH {_FIRST} SELECT id, CAST(cluster AS INTEGER) AS cluster, round(dist, 4) AS dist FROM a0",
    "assign_nearest_scaled": f"WITH {_FIRST_SMALL} SELECT id, CAST(cluster AS INTEGER) AS cluster, round(dist, 12) AS dist FROM a0",
    "kmeans_ml_groups": _GROUPS,
    "bisecting_ml_groups": _GROUPS,
    "centroid_update": f"""WITH {_FIRST}
SELECT CAST(a.cluster AS INTEGER) AS cluster, v.idx, round(avg(v.val), 6) AS val
FROM a0 a JOIN v ON v.id = a.id GROUP BY 1, 2""",
    "cluster_profile": f"WITH {_FIRST} {_PROFILE.format(n=0)}",
    "cluster_wssse": f"WITH {_FIRST} SELECT round(sum(dist), 4) AS wssse FROM a0",
    "kmeans_lloyd_embed": f"WITH {_lloyd_sql(EMBED, K, ITERS)} {_PROFILE.format(n=ITERS)}",
    "kmeans_lloyd_tf": f"WITH {_TF_LLOYD} {_PROFILE.format(n=ITERS)}",
    "kmeans_lloyd_tfidf": f"WITH {_TFIDF_LLOYD} {_PROFILE.format(n=ITERS)}",
    "cluster_top_terms": f"""WITH {_TF_LLOYD}{_TERMS.format(n=ITERS)}
SELECT CAST(cluster AS INTEGER) AS cluster, rank, term, n FROM top""",
    "rpt_clusters": f"""WITH {_TFIDF_LLOYD}{_TERMS.format(n=ITERS)},
profile AS ({_PROFILE.format(n=ITERS)}),
listed AS (SELECT CAST(cluster AS INTEGER) AS cluster, string_agg(term, ' ' ORDER BY rank) AS terms FROM top GROUP BY 1)
SELECT 'K-means' AS algorithm, (SELECT round(sum(dist), 4) FROM a{ITERS}) AS wssse, p.cluster AS id, p.size, p.error,
  coalesce(l.terms, '') AS terms
FROM profile p LEFT JOIN listed l ON l.cluster = p.cluster""",
}

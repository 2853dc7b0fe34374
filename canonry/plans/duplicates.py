"""Duplicate bodies and the record kept of each group (AGG-02, WIN-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.functions.text import compact
from canonry.session import table

#: Bodies of fewer characters, white space left out, have no hash.
LEAST_BODY = 80


def dup_body_keeper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per removed duplicate: the record itself and the one kept for its body.

    Kept is the longest text of the group, then the smallest id. The text itself never
    moves: the groups are made of hashes and lengths.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n"), compact(F.col("text")).alias("body"))
    docs = docs.where(F.length("body") >= LEAST_BODY).select("doc_id", "n", F.sha2("body", 256).alias("hash"))
    kept = docs.groupBy("hash").agg(F.max(F.struct("n", (-F.col("doc_id")).alias("neg"))).alias("best"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return docs.join(kept, "hash").select(
        F.col("doc_id").alias("removed_id"), (-F.col("best.neg")).alias("kept_id"), "size"
    ).where("removed_id <> kept_id")


QUERIES = {"dup_body_keeper": dup_body_keeper}
SQL = {
    "dup_body_keeper": r"""
WITH d AS (SELECT doc_id, length(text) AS n, regexp_replace(text, '[ \t\n\r\f\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', '', 'g') AS body FROM documents),
h AS (SELECT doc_id, n, sha256(body) AS hash FROM d WHERE length(body) >= 80),
k AS (SELECT hash, arg_min(doc_id, (-n, doc_id)) AS kept_id, count(*) AS size FROM h GROUP BY hash HAVING count(*) > 1)
SELECT h.doc_id AS removed_id, k.kept_id, k.size FROM h JOIN k USING (hash) WHERE h.doc_id <> k.kept_id
"""
}

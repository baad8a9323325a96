"""Queries on periods and gaps of cues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.coverage import sweep
from ..session import table, to_ms


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    cues = table(spark, folder, "cues").select("episode_id", "track", to_ms("start_s").alias("s"), to_ms("end_s").alias("e"))
    return sweep(cues, ["episode_id", "track"], "s", "e")


_P5 = """
WITH c AS (
  SELECT episode_id, track, CAST(round(start_s * 1000) AS BIGINT) AS s, CAST(round(end_s * 1000) AS BIGINT) AS e
  FROM cues WHERE start_s IS NOT NULL AND end_s IS NOT NULL
), v AS (SELECT DISTINCT episode_id, track, s, e FROM c WHERE s < e),
m AS (
  SELECT *, max(e) OVER (PARTITION BY episode_id, track ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v
), g AS (
  SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id, track ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m
), p AS (
  SELECT episode_id, track, island, min(s) AS start_ms, max(e) AS end_ms FROM g GROUP BY 1, 2, 3
), n AS (
  SELECT *, lead(start_ms) OVER (PARTITION BY episode_id, track ORDER BY start_ms) AS nxt FROM p
)
SELECT episode_id, track, 'period' AS kind, start_ms, end_ms FROM n
UNION ALL
SELECT episode_id, track, 'gap' AS kind, end_ms AS start_ms, nxt AS end_ms FROM n WHERE nxt IS NOT NULL
"""

QUERIES = {"p5_found": p5_found}
ORACLE = {"p5_found": _P5}

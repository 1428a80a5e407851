"""Messy views derived from the driver tables.

The driver tables hold no nulls and no duplicate rows, so missing values,
duplicates and outliers are derived deterministically from row keys.  Every
view reads its whole source table; the key arithmetic only decides *which*
cells are blanked or which rows are repeated, never which rows are read.

The same SQL text runs in Spark SQL and in DuckDB, so the oracle and the
Spark query start from identical input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import read_table

# Fixed view definitions (shared with the DuckDB oracle).
M_ITEMS_SQL = """
WITH base AS (
  SELECT l_orderkey AS order_id, l_partkey AS part_id,
         CASE WHEN (l_orderkey + l_partkey) % 17 = 0 THEN NULL ELSE l_quantity END AS qty,
         CASE WHEN l_orderkey % 97 = 0 THEN l_extendedprice * 50 ELSE l_extendedprice END AS price,
         CASE WHEN l_partkey % 20 < 9  THEN NULL ELSE l_discount END AS discount,
         CASE WHEN l_partkey % 20 < 17 THEN NULL ELSE l_tax END AS mystery,
         CASE WHEN l_suppkey % 20 = 0  THEN NULL ELSE l_returnflag END AS flag,
         l_linestatus AS status_code,
         CAST(CAST(l_shipdate AS DATE) AS STRING) AS ship_date,
         CONCAT('ID', CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING)) AS item_id,
         CAST(1.0 AS DOUBLE) AS constant_col,
         CAST(CASE WHEN l_partkey % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS target
  FROM lineitem)
SELECT * FROM base
UNION ALL
SELECT * FROM base WHERE order_id % 251 = 0
"""

M_CALLS_SQL = """
SELECT CONCAT('run_', CAST(user_id % 3 AS STRING)) AS run_id, ts AS logged_at,
       CASE WHEN event_id % 2 = 0 THEN 'baseline' ELSE 'cdp' END AS prompt_strategy,
       event_type AS agent_name, props AS prompt_text,
       CASE event_id % 12
         WHEN 0 THEN CONCAT('{"justification": "seen ', event_type, '", "readiness_score": ', CAST(user_id % 90 AS STRING), '}')
         WHEN 1 THEN CONCAT('{"backtrack": true, "risk_level": "', event_type, '", "risk_summary": ["', event_type, '"]}')
         WHEN 2 THEN CONCAT('[{"of": "', event_type, '"}, "risk_note", ', CAST(user_id AS STRING), ']')
         WHEN 3 THEN CONCAT('The mean of ', event_type, ' may hide fraud in ', CAST(user_id AS STRING))
         WHEN 4 THEN CONCAT(event_type, ': Backtrack, the spread is ', CAST(event_id % 3 AS STRING))
         WHEN 5 THEN CONCAT('  ```json
{"readiness_score": ', CAST(user_id % 7 AS STRING), ', "of": "', event_type, '"}
```
')
         WHEN 6 THEN CONCAT('{"outer": {"risk_note": "', event_type, '"}, "backtrack": "false"}')
         WHEN 7 THEN CONCAT('One-hot for the high cardinality of ', event_type)
         WHEN 8 THEN CONCAT('{"justification": 1, "of": ', CAST(user_id AS STRING), ', "justification": "', event_type, '"}')
         WHEN 9 THEN CONCAT('Fit ', event_type, ' on the full dataset', CASE WHEN user_id % 2 = 0 THEN '' ELSE ', error of none' END)
         WHEN 10 THEN CONCAT('```
drop ', event_type, ' for its low correlation', '
```')
         ELSE CONCAT('"', event_type, CASE WHEN user_id % 2 = 0 THEN ' justification"' ELSE ' without"' END) END AS output_text,
       value AS latency_ms
FROM events
"""

M_TEXT_SQL = "SELECT conv_id, turn, role, text FROM conversations"

VIEWS = {"m_items": (M_ITEMS_SQL, ("lineitem",)),
         "m_calls": (M_CALLS_SQL, ("events",)),
         "m_text": (M_TEXT_SQL, ("conversations",))}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived view over the whole source tables, always lazy."""
    sql, sources = VIEWS[name]
    for t in sources:
        read_table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(sql)


def m_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "m_items")


def m_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "m_calls")


def m_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "m_text")


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the view CTEs it uses (DuckDB side)."""
    ctes = []
    for n in names:
        body = VIEWS[n][0].strip()
        ctes.append(f"{n} AS (\n{body}\n)")
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + sql

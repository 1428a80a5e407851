"""Registered queries of the intake: files with broken records, rejects kept apart.

The files are stand-ins in the formats the intake expects, written from every
row of a driver table; which lines are broken is decided by their keys.  The
oracles work out from the keys what must be read and what must be rejected.
"""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, read_table
from ..sources.ingest import read_any
from .registry import query

# Fixed view definitions (shared with the DuckDB oracles).
BROKEN_CSV_SQL = '''
SELECT o_orderkey AS k, o_totalprice AS price,
       CASE o_orderkey % 41 WHEN 1 THEN 'surplus fields' WHEN 2 THEN 'missing fields' WHEN 3 THEN 'open quotation'
            WHEN 4 THEN 'open quotation' END AS reason,
       CASE o_orderkey % 41
         WHEN 1 THEN CONCAT(CAST(o_orderkey AS STRING), ',', CAST(o_totalprice AS STRING), ',', o_orderstatus, ',more')
         WHEN 2 THEN CONCAT(CAST(o_orderkey AS STRING), ',', o_orderstatus)
         WHEN 3 THEN CONCAT(CAST(o_orderkey AS STRING), ',', CAST(o_totalprice AS STRING), ',"', o_orderpriority)
         WHEN 4 THEN CONCAT(CAST(o_orderkey AS STRING), ',"', o_orderstatus, '"x,', o_orderpriority)
         WHEN 5 THEN CONCAT(CAST(o_orderkey AS STRING), ',', CAST(o_totalprice AS STRING), ',"a, ""', o_orderpriority, '"""')
         WHEN 6 THEN CONCAT('"', CAST(o_orderkey AS STRING), '",', CAST(o_totalprice AS STRING), ',')
         ELSE CONCAT(CAST(o_orderkey AS STRING), ',', CAST(o_totalprice AS STRING), ',', o_orderpriority) END AS line,
       CASE o_orderkey % 41 WHEN 5 THEN CONCAT('a, "', o_orderpriority, '"') WHEN 6 THEN NULL ELSE o_orderpriority END AS note
FROM orders'''

BROKEN_JSON_SQL = """
SELECT event_id AS k, value, event_type,
       CASE event_id % 37
         WHEN 1 THEN CONCAT('{"k": ', CAST(event_id AS STRING), ', "of": "', event_type)
         WHEN 2 THEN event_type
         WHEN 3 THEN CONCAT('{"k": ', CAST(event_id AS STRING), ', "of": }')
         ELSE CONCAT('{"k": ', CAST(event_id AS STRING), CASE WHEN event_id % 2 = 0 THEN CONCAT(', "of": "', event_type, '"')
                     ELSE '' END, '}') END AS line,
       event_id % 37 IN (1, 2, 3) AS broken
FROM events"""


def write_lines(lines: DataFrame, header: str | None = None) -> str:
    """A folder of text files with one line per row of the one column, each file starting with ``header``."""
    path = os.path.join(ensure_checkpoint_dir(lines.sparkSession), f"lines-{uuid.uuid4().hex}")

    def headed(batches):
        if header is not None:
            yield pa.RecordBatch.from_arrays([pa.array([header])], names=["line"])
        yield from batches
    lines.mapInArrow(headed, "line string").write.text(path)
    return path


def _stand_in(spark, sf: str, table: str, sql: str) -> DataFrame:
    read_table(spark, sf, table).createOrReplaceTempView(table)
    return spark.sql(sql).select("line")


@query("a1_rejects", f"""
WITH lines AS ({BROKEN_CSV_SQL})
SELECT reason, count(*) AS n, CAST(sum(length(line)) AS BIGINT) AS chars, CAST(0 AS BIGINT) AS keys, CAST(0 AS BIGINT) AS notes
FROM lines WHERE reason IS NOT NULL GROUP BY reason
UNION ALL
SELECT 'read', count(*), CAST(0 AS BIGINT), CAST(sum(k) AS BIGINT), CAST(sum(length(note)) AS BIGINT) FROM lines WHERE reason IS NULL""")
def a1_rejects(spark, sf):
    """CSV with broken lines: rows read (``reason`` "read") and rejects by reason."""
    path = write_lines(_stand_in(spark, sf, "orders", BROKEN_CSV_SQL), "k,price,note")
    rows = read_any(spark, path, "csv", on_bad="keep_apart", rejects_path=f"{path}-rejects")
    zero = F.lit(0).cast("bigint")
    bad = spark.read.parquet(f"{path}-rejects").groupBy("reason").agg(
        F.count("*").alias("n"), F.sum(F.length("record")).alias("chars"), zero.alias("keys"), zero.alias("notes"))
    return bad.unionByName(rows.agg(F.lit("read").alias("reason"), F.count("*").alias("n"), zero.alias("chars"),
                                    F.sum("k").alias("keys"), F.sum(F.length("note")).alias("notes")))


@query("a2_rejects", f"""
WITH lines AS ({BROKEN_JSON_SQL})
SELECT 'not a JSON object' AS reason, count(*) AS n, CAST(sum(length(line)) AS BIGINT) AS chars, CAST(0 AS BIGINT) AS keys,
       CAST(0 AS BIGINT) AS named FROM lines WHERE broken
UNION ALL
SELECT 'read', count(*), CAST(0 AS BIGINT), CAST(sum(k) AS BIGINT), count(*) FILTER (WHERE k % 2 = 0) FROM lines WHERE NOT broken""")
def a2_rejects(spark, sf):
    """JSON lines with broken ones: rows read (``reason`` "read") and rejects."""
    path = write_lines(_stand_in(spark, sf, "events", BROKEN_JSON_SQL))
    rows = read_any(spark, path, "json", on_bad="keep_apart", rejects_path=f"{path}-rejects")
    zero = F.lit(0).cast("bigint")
    bad = spark.read.parquet(f"{path}-rejects").groupBy("reason").agg(
        F.count("*").alias("n"), F.sum(F.length("record")).alias("chars"), zero.alias("keys"), zero.alias("named"))
    return bad.unionByName(rows.agg(F.lit("read").alias("reason"), F.count("*").alias("n"), zero.alias("chars"),
                                    F.sum("k").alias("keys"), F.count("of").alias("named")))

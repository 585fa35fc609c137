"""Project the driver's ``events`` table into the 15-column raw sensor shape.

The rules inject what the real source file holds (sentinels, nulls, missing
timestamps, exact duplicates); every event row flows through, and each
event with ``event_id % 10 = 0`` appears twice. The same projection is
written as DuckDB SQL in ``__spark_entry__.oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


# The projection in Spark SQL (one expression per column, parsed on the JVM).
_RAW_EXPRS = (
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE date_format(ts, 'dd/MM/yyyy') END AS Date",
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE date_format(ts, 'HH.mm.ss') END AS Time",
    "CASE WHEN event_id % 7 = 0 THEN -200D ELSE value END AS COGT",
    "value * 2 AS PT08S1CO",
    "CASE WHEN event_id % 3 <> 0 THEN -200D ELSE value + event_id % 50 END AS NMHCGT",
    "CASE WHEN event_id % 11 = 0 THEN -200D ELSE value / 4 END AS C6H6GT",
    "value + 1 AS PT08S2NMHC",
    "CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS DOUBLE) WHEN event_id % 5 = 0 THEN -200D "
    "ELSE value + user_id END AS NOxGT",
    "value + 2 AS PT08S3NOx",
    "CASE WHEN event_id % 5 = 1 THEN -200D ELSE value + 10 END AS NO2GT",
    "value + 3 AS PT08S4NO2",
    "value + 4 AS PT08S5O3",
    "value / 10 AS T",
    "value / 20 AS RH",
    "value / 30 AS AH",
)


def raw_sensor(events: DataFrame, keep_event_id: bool = False) -> DataFrame:
    e = events.select("event_id", "ts", "user_id", "value")
    e = e.unionByName(e.filter("event_id % 10 = 0"))
    return e.selectExpr(*(("event_id",) if keep_event_id else ()), *_RAW_EXPRS)

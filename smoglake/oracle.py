"""DuckDB SQL equivalents of the registered queries (independent oracle).

Each string runs on the driver's parquet tables registered as views
(``events``, ``lineitem``, ...). Column names and integer widths match the
Spark results. Means used for filling are exact decimal sums; averages of filled
readings are rounded half-up to 6 places in decimal.
"""

from __future__ import annotations

def _r6(x: str) -> str:
    """Half-up to 6 places on the decimal value."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,12)), 6) AS DOUBLE)"


def _mean(x: str, scale: int) -> str:
    """The mean from an exact decimal sum, 0 if there is no value."""
    return f"COALESCE(CAST(SUM(CAST({x} AS DECIMAL(28,{scale}))) AS DOUBLE) / COUNT({x}), 0)"


# the raw sensor projection of events, with the event id kept for corruption rules
_RAW = """
raw_id AS (
  SELECT event_id,
         CASE WHEN event_id%97=0 THEN NULL ELSE strftime(ts,'%d/%m/%Y') END AS "Date",
         CASE WHEN event_id%97=0 THEN NULL ELSE strftime(ts,'%H.%M.%S') END AS "Time",
         CASE WHEN event_id%7=0  THEN CAST(-200 AS DOUBLE) ELSE value END AS "COGT",
         value*2 AS "PT08S1CO",
         CASE WHEN event_id%3<>0 THEN CAST(-200 AS DOUBLE) ELSE value+event_id%50 END AS "NMHCGT",
         CASE WHEN event_id%11=0 THEN CAST(-200 AS DOUBLE) ELSE value/4 END AS "C6H6GT",
         value+1 AS "PT08S2NMHC",
         CASE WHEN event_id%13=0 THEN NULL
              WHEN event_id%5=0  THEN CAST(-200 AS DOUBLE) ELSE value+user_id END AS "NOxGT",
         value+2 AS "PT08S3NOx",
         CASE WHEN event_id%5=1  THEN CAST(-200 AS DOUBLE) ELSE value+10 END AS "NO2GT",
         value+3 AS "PT08S4NO2", value+4 AS "PT08S5O3",
         value/10 AS "T", value/20 AS "RH", value/30 AS "AH"
  FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id%10=0) e),
raw AS (SELECT * EXCLUDE (event_id) FROM raw_id)"""

_RENAMED = """
d AS (SELECT DISTINCT * FROM raw),
r AS (SELECT "Date" AS date, "Time" AS time, "COGT" AS carbon_monoxide,
             "NMHCGT" AS non_methane_hydrocarbon, "C6H6GT" AS benzene,
             "NOxGT" AS nitrogen_oxides, "NO2GT" AS nitrogen_dioxide FROM d),
n AS (SELECT date, time,
             NULLIF(carbon_monoxide,-200) AS carbon_monoxide,
             NULLIF(non_methane_hydrocarbon,-200) AS non_methane_hydrocarbon,
             NULLIF(benzene,-200) AS benzene,
             NULLIF(nitrogen_oxides,-200) AS nitrogen_oxides,
             NULLIF(nitrogen_dioxide,-200) AS nitrogen_dioxide FROM r)"""

_IMPUTED = f"""
m AS (SELECT {_mean("carbon_monoxide", 4)} a, {_mean("non_methane_hydrocarbon", 4)} b,
             {_mean("benzene", 4)} c, {_mean("nitrogen_oxides", 4)} e,
             {_mean("nitrogen_dioxide", 4)} f FROM n),
i AS (SELECT date, time,
             COALESCE(carbon_monoxide,a) carbon_monoxide,
             COALESCE(non_methane_hydrocarbon,b) non_methane_hydrocarbon,
             COALESCE(benzene,c) benzene, COALESCE(nitrogen_oxides,e) nitrogen_oxides,
             COALESCE(nitrogen_dioxide,f) nitrogen_dioxide FROM n, m)"""

_FEATURES = """CAST(year(event_timestamp) AS INTEGER) AS "year",
              CAST(month(event_timestamp) AS INTEGER) AS "month",
              CAST(day(event_timestamp) AS INTEGER) AS "day",
              CAST(dayofweek(event_timestamp)+1 AS INTEGER) AS day_of_week,
              CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day"""

_PROCESSED = f"""
p0 AS (SELECT carbon_monoxide, non_methane_hydrocarbon, benzene, nitrogen_oxides, nitrogen_dioxide,
              TRY_STRPTIME(concat_ws(' ', date, time), '%d/%m/%Y %H.%M.%S') AS event_timestamp FROM i),
processed AS (SELECT *, {_FEATURES} FROM p0)"""

# long form of the timed processed rows with graph labels
_LONG = """
l AS (SELECT "year", "month", "day", hour_of_day, day_of_week, p, v FROM (
        SELECT *, 'CO' AS p, carbon_monoxide AS v FROM processed UNION ALL
        SELECT *, 'NMHC', non_methane_hydrocarbon FROM processed UNION ALL
        SELECT *, 'Benzene', benzene FROM processed UNION ALL
        SELECT *, 'NOx', nitrogen_oxides FROM processed UNION ALL
        SELECT *, 'NO2', nitrogen_dioxide FROM processed) x
      WHERE event_timestamp IS NOT NULL)"""

_CAL = """
cal AS (SELECT DISTINCT "year", "month", "day", hour_of_day AS hr, day_of_week FROM processed
        WHERE event_timestamp IS NOT NULL)"""

_WEEKDAYS = "['Sunday','Monday','Tuesday','Wednesday','Thursday','Friday','Saturday']"
_LEGACY_WEEKDAYS = "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']"
_MONTHS = ("['January','February','March','April','May','June','July','August','September',"
           "'October','November','December']")
_DISPLAY = "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']"

_CLEANED = """
c AS (SELECT "Date", "Time", "COGT" AS "CO", "NMHCGT" AS "NMHC", "C6H6GT" AS "C6H6",
             "NOxGT" AS "NOx", "NO2GT" AS "NO2",
             TRY_STRPTIME(concat_ws(' ', "Date", "Time"), '%d/%m/%Y %H.%M.%S') AS event_timestamp
      FROM raw WHERE "COGT" <> -200 AND "NMHCGT" <> -200 AND "C6H6GT" <> -200
                 AND "NOxGT" <> -200 AND "NO2GT" <> -200),
cl AS (SELECT event_timestamp, 'CO' AS pollutant, "CO" AS reading FROM c UNION ALL
       SELECT event_timestamp, 'NMHC', "NMHC" FROM c UNION ALL
       SELECT event_timestamp, 'Benzene', "C6H6" FROM c UNION ALL
       SELECT event_timestamp, 'NOx', "NOx" FROM c UNION ALL
       SELECT event_timestamp, 'NO2', "NO2" FROM c)"""

_R6 = "carbon_monoxide, non_methane_hydrocarbon, benzene, nitrogen_oxides, nitrogen_dioxide"


_PROCESSED_OUT = (f'SELECT {_R6}, event_timestamp, "year", "month", "day", day_of_week, hour_of_day '
                  "FROM processed")


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_PIPE = (_RAW, _RENAMED, _IMPUTED, _PROCESSED)


def _norm(member_expr: str, member: str, order: str) -> str:
    return f"""
    , a AS (SELECT p AS "Pollutant", {member_expr} AS "{member}", AVG(v) AS av FROM l GROUP BY 1, 2)
    SELECT "Pollutant", "{member}", {_r6("av")} AS "AvgValue",
           {_r6("(av - MIN(av) OVER w) / NULLIF(MAX(av) OVER w - MIN(av) OVER w, 0)")} AS "NormalizedValue"
    FROM a WINDOW w AS (PARTITION BY "Pollutant") ORDER BY "Pollutant", {order}"""


_HOURLY_NORM = _with(*_PIPE, _LONG) + _norm("printf('%02d:00', hour_of_day)", "HourOfDay", '"HourOfDay"')
_WEEKDAY_NORM = _with(*_PIPE, _LONG) + _norm(f"{_WEEKDAYS}[day_of_week]", "DayOfWeek",
                                              f'list_position({_DISPLAY}, "DayOfWeek")')
_WEEKDAY_NORM_LEGACY = _with(*_PIPE, _LONG) + _norm(f"{_LEGACY_WEEKDAYS}[day_of_week]", "DayOfWeek",
                                                     f'list_position({_DISPLAY}, "DayOfWeek")')

_TOP5 = """
, h AS (SELECT hour_of_day AS hr, AVG(carbon_monoxide) a, MAX(carbon_monoxide) pk FROM processed GROUP BY 1),
t AS (SELECT hr, a, pk FROM h ORDER BY a DESC NULLS LAST, hr ASC NULLS LAST LIMIT 5)"""

_PIVOT_COLS = ", ".join(
    _r6(f"""MAX("NormalizedValue") FILTER (WHERE "HourOfDay" = '{h:02d}:00')""") + f' AS "{h:02d}:00"'
    for h in range(24))

_LINEITEM = f"""
li AS (SELECT DISTINCT * FROM lineitem),
lm AS (SELECT {_mean("l_quantity", 2)} q, {_mean("l_extendedprice", 2)} pr,
              {_mean("l_discount", 2)} di, {_mean("l_tax", 2)} tx FROM li),
lp AS (SELECT COALESCE(l_quantity,q) l_quantity, COALESCE(l_extendedprice,pr) l_extendedprice,
              COALESCE(l_discount,di) l_discount, COALESCE(l_tax,tx) l_tax,
              l_shipdate AS event_timestamp FROM li, lm),
lproc AS (SELECT *, CAST(year(event_timestamp) AS INTEGER) AS "year",
              CAST(month(event_timestamp) AS INTEGER) AS "month",
              CAST(day(event_timestamp) AS INTEGER) AS "day",
              CAST(dayofweek(event_timestamp)+1 AS INTEGER) AS day_of_week,
              CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day FROM lp)"""

_LINEITEM_LONG = """
, l AS (SELECT day_of_week, hour_of_day, p, v FROM (
        SELECT *, 'quantity' AS p, l_quantity AS v FROM lproc UNION ALL
        SELECT *, 'extendedprice', l_extendedprice FROM lproc UNION ALL
        SELECT *, 'discount', l_discount FROM lproc UNION ALL
        SELECT *, 'tax', l_tax FROM lproc) x WHERE event_timestamp IS NOT NULL)"""

_RAW_OUT = "SELECT * FROM raw"
_EXPLICIT_RAW_COLS = ('"Date", "Time", "COGT", "PT08S1CO", "NMHCGT", "C6H6GT", "PT08S2NMHC", "NOxGT", '
                      '"PT08S3NOx", "NO2GT", "PT08S4NO2", "PT08S5O3", "T", "RH", "AH"')

SQL: dict[str, str] = {
    "csv_normalize": _with(_RAW) + " " + _RAW_OUT,
    "csv_mixed_headers": _with(_RAW) + """ SELECT * EXCLUDE (event_id)
        REPLACE (CASE WHEN event_id % 4 = 2 THEN NULL ELSE "NO2GT" END AS "NO2GT") FROM raw_id""",
    "json_roundtrip": _with(_RAW) + " " + _RAW_OUT,
    "json_malformed": _with(_RAW) + " SELECT " + ", ".join(
        f'CASE WHEN event_id%17=0 OR event_id%19=0 THEN NULL ELSE {c} END AS {c}'
        for c in _EXPLICIT_RAW_COLS.split(", ")) + " FROM raw_id",
    "dedup_full_row": _with(_RAW) + " SELECT DISTINCT * FROM raw",
    "project_rename": _with(_RAW, _RENAMED) + " SELECT * FROM r",
    "sentinel_to_null": _with(_RAW, _RENAMED) + " SELECT * FROM n",
    "impute_mean": _with(_RAW, _RENAMED, _IMPUTED) + f" SELECT date, time, {_R6} FROM i",
    "mean_any_doubles": """WITH e AS (SELECT event_id, CAST(ROUND(value * 100) AS BIGINT) AS c,
               CASE WHEN event_id % 4 < 2 THEN 1 ELSE -1 END AS sign FROM events),
        s AS (SELECT CAST(SUM(c) FILTER (event_id % 2 = 0) AS DOUBLE) AS l, CAST(SUM(c) FILTER (event_id % 2 = 1) AS DOUBLE) AS t,
                     CAST(SUM(sign * c) FILTER (event_id % 2 = 0) AS DOUBLE) AS sl,
                     CAST(SUM(sign * c) FILTER (event_id % 2 = 1) AS DOUBLE) AS st,
                     COUNT(*) AS n, COUNT(*) FILTER (event_id % 2 = 1) AS odd FROM e)
        SELECT (l * POW(2, 40) + t * POW(2, -27)) / n AS mean_mixed, (sl * POW(2, 40) + st * POW(2, -27)) / n AS mean_signed,
               t * POW(2, -27) / odd AS mean_tiny, CAST(0 AS DOUBLE) AS mean_missing FROM s""",
    "parse_timestamp": _with(_RAW, _RENAMED) + """ SELECT carbon_monoxide, non_methane_hydrocarbon,
        benzene, nitrogen_oxides, nitrogen_dioxide,
        TRY_STRPTIME(concat_ws(' ', date, time), '%d/%m/%Y %H.%M.%S') AS event_timestamp FROM n""",
    "time_features": _with(_RAW, _RENAMED) + f""", t AS (SELECT carbon_monoxide, non_methane_hydrocarbon,
        benzene, nitrogen_oxides, nitrogen_dioxide,
        TRY_STRPTIME(concat_ws(' ', date, time), '%d/%m/%Y %H.%M.%S') AS event_timestamp FROM n)
        SELECT *, {_FEATURES} FROM t""",
    "processed": _with(*_PIPE) + " " + _PROCESSED_OUT,
    "null_audit": _with(_RAW, _RENAMED, _IMPUTED) + " " + " UNION ALL ".join(
        f"""SELECT '{stage}' AS stage, '{col}' AS column_name,
                   COUNT(*) FILTER (WHERE {col} IS NULL) AS null_count, COUNT(*) AS row_count FROM {src}"""
        for stage, src in (("before", "n"), ("after", "i"))
        for col in ("carbon_monoxide", "benzene", "nitrogen_oxides", "nitrogen_dioxide",
                    "non_methane_hydrocarbon")),
    "overwrite_idempotent": _with(*_PIPE) + " " + _PROCESSED_OUT,
    "nested_documents": _with(*_PIPE) + " " + _PROCESSED_OUT,
    "documents_typed_roundtrip": """SELECT event_id,
        CASE WHEN event_id % 9 <> 0 THEN event_id * 1000003 + 1 END AS instant_micros,
        CASE WHEN event_id % 7 <> 0 THEN TIMESTAMP '2024-01-01' + to_microseconds(event_id * 1000001) END AS wall,
        CAST(DATE '2000-02-28' + CAST(event_id % 400 AS INTEGER) AS DATE) AS day, event_id / 1000 AS exact,
        event_id % 11 = 0 OR event_id % 13 = 0 AS not_a_number,
        CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN value / 3 END AS measure,
        CASE WHEN event_id % 5 <> 0 THEN 2 END AS n_users, CASE WHEN event_id % 5 <> 0 THEN user_id END AS first_user,
        upper(hex('a"' || chr(92) || chr(10) || event_id)) AS payload FROM events""",
    "daily_profile": _with(*_PIPE) + f"""
        , a AS (SELECT day_of_week AS "Day", AVG(carbon_monoxide) co, AVG(benzene) bz,
                       AVG(nitrogen_dioxide) no2 FROM processed GROUP BY 1)
        SELECT "Day", {_r6("co")} AS avg_carbon_monoxide, {_r6("bz")} AS avg_benzene,
               {_r6("no2")} AS avg_nitrogen_dioxide,
               CASE WHEN "Day" BETWEEN 1 AND 7 THEN {_WEEKDAYS}["Day"] END AS day_name
        FROM a ORDER BY "Day" NULLS FIRST""",
    "hourly_top5": _with(*_PIPE) + _TOP5 + f"""
        SELECT CASE WHEN hr IS NOT NULL THEN printf('%02d:00', hr) END AS hour_of_day,
               {_r6("a")} AS avg_carbon_monoxide, pk AS peak_carbon_monoxide FROM t""",
    "hourly_top5_long": _with(*_PIPE) + _TOP5 + f"""
        , w AS (SELECT CASE WHEN hr IS NOT NULL THEN printf('%02d:00', hr) END AS hh, a, pk FROM t)
        SELECT hh AS "Hour of Day", 'Avg CO' AS "Metric", {_r6("a")} AS "Level" FROM w UNION ALL
        SELECT hh, 'Peak CO', pk FROM w""",
    "hour_label": _with(*_PIPE) + """ SELECT DISTINCT hour_of_day,
        CASE WHEN hour_of_day IS NOT NULL THEN printf('%02d:00', hour_of_day) END AS hour_label FROM processed""",
    "listwise_filter": _with(_RAW) + """ SELECT * FROM raw WHERE "COGT" <> -200 AND "NMHCGT" <> -200
        AND "C6H6GT" <> -200 AND "NOxGT" <> -200 AND "NO2GT" <> -200""",
    "pollutant_list": _with(_RAW, _CLEANED) + " SELECT DISTINCT pollutant FROM cl",
    "stack_unpivot": _with(_RAW, _CLEANED) + " SELECT * FROM cl",
    "collect_unwind": _HOURLY_NORM,
    "graph_time_nodes": _with(*_PIPE, _CAL) + f"""
        SELECT DISTINCT 'Year' AS label, CAST("year" AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS name FROM cal
        UNION ALL SELECT DISTINCT 'Month', concat_ws('|', "year", "month"), {_MONTHS}["month"] FROM cal
        UNION ALL SELECT DISTINCT 'Day', concat_ws('|', "year", "month", "day"), NULL FROM cal
        UNION ALL SELECT DISTINCT 'HourOfDay', concat_ws('|', "year", "month", "day", hr),
                                  printf('%02d:00', hr) FROM cal
        UNION ALL SELECT DISTINCT 'DayOfWeek', CAST(day_of_week AS VARCHAR), {_WEEKDAYS}[day_of_week] FROM cal""",
    "graph_time_edges": _with(*_PIPE, _CAL) + """
        SELECT DISTINCT 'HAS_MONTH' AS type, CAST("year" AS VARCHAR) AS src,
                        concat_ws('|', "year", "month") AS dst FROM cal
        UNION ALL SELECT DISTINCT 'HAS_DAY', concat_ws('|', "year", "month"),
                                  concat_ws('|', "year", "month", "day") FROM cal
        UNION ALL SELECT DISTINCT 'HAS_HOUR', concat_ws('|', "year", "month", "day"),
                                  concat_ws('|', "year", "month", "day", hr) FROM cal
        UNION ALL SELECT DISTINCT 'DAY_OF_WEEK', concat_ws('|', "year", "month", "day"),
                                  CAST(day_of_week AS VARCHAR) FROM cal""",
    "graph_readings": _with(*_PIPE, _LONG) + """ SELECT "year", "month", "day", hour_of_day AS "hour",
        p AS pollutant, v AS value FROM l""",
    "graph_pollution_types": _with(*_PIPE, _LONG) + """
        , u AS (SELECT * FROM (VALUES ('CO','µg/m³'), ('NMHC','µg/m³'), ('Benzene','µg/m³'),
                                      ('NOx','ppm'), ('NO2','µg/m³')) t(name, unit))
        SELECT DISTINCT l.p AS name, u.unit FROM l LEFT JOIN u ON l.p = u.name""",
    "graph_key_check": _with(*_PIPE, _CAL, _LONG) + """
        , k AS (
          SELECT 'Year' AS label, COUNT(*) AS n FROM (SELECT DISTINCT "year" FROM cal) GROUP BY "year"
          UNION ALL SELECT 'Month', COUNT(*) FROM (SELECT DISTINCT "year", "month" FROM cal) GROUP BY "year", "month"
          UNION ALL SELECT 'Day', COUNT(*) FROM (SELECT DISTINCT "year", "month", "day" FROM cal)
                    GROUP BY "year", "month", "day"
          UNION ALL SELECT 'HourOfDay', COUNT(*) FROM (SELECT DISTINCT "year", "month", "day", hr FROM cal)
                    GROUP BY "year", "month", "day", hr
          UNION ALL SELECT 'DayOfWeek', COUNT(*) FROM (SELECT DISTINCT day_of_week FROM cal) GROUP BY day_of_week
          UNION ALL SELECT 'PollutionType', COUNT(*) FROM (SELECT DISTINCT p FROM l) GROUP BY p)
        SELECT label, CAST(SUM(n) AS BIGINT) AS nodes, COUNT(*) FILTER (WHERE n > 1) AS violations
        FROM k GROUP BY label""",
    "merge_on_create": _with(*_PIPE, _CAL) + """
        , ex AS (SELECT DISTINCT "year", "month", "day", hr AS "hour", printf('%02d:00', hr) AS name
                 FROM cal WHERE "day" <= 15),
        inc AS (SELECT "year", "month", "day", hour_of_day AS "hour", MIN(printf('%02dh', hour_of_day)) AS name
                FROM processed WHERE event_timestamp IS NOT NULL GROUP BY 1, 2, 3, 4)
        SELECT * FROM ex UNION ALL
        SELECT * FROM inc WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex."year" = inc."year"
              AND ex."month" = inc."month" AND ex."day" = inc."day" AND ex."hour" = inc."hour")""",
    "graph_hourly_norm": _HOURLY_NORM,
    "graph_hourly_norm_fact": _HOURLY_NORM,
    "graph_weekday_norm": _WEEKDAY_NORM,
    "graph_weekday_norm_fact": _WEEKDAY_NORM,
    "graph_weekday_norm_legacy": _WEEKDAY_NORM_LEGACY,
    "hourly_norm_pivot": _with(*_PIPE, _LONG) + """
        , a AS (SELECT p AS "Pollutant", printf('%02d:00', hour_of_day) AS "HourOfDay", AVG(v) AS av
                FROM l GROUP BY 1, 2),
        hn AS (SELECT "Pollutant", "HourOfDay",
               (av - MIN(av) OVER w) / NULLIF(MAX(av) OVER w - MIN(av) OVER w, 0) AS "NormalizedValue"
               FROM a WINDOW w AS (PARTITION BY "Pollutant"))
        SELECT "Pollutant", """ + _PIVOT_COLS + ' FROM hn GROUP BY "Pollutant"',
    "stream_ingest": _with(_RAW) + " " + _RAW_OUT,
    "stream_cleaned": _with(_RAW, _CLEANED) + " SELECT * FROM c",
    "stream_pollutant_avg": _with(_RAW, _CLEANED) + f""" SELECT pollutant, {_mean("reading", 4)} AS avg_reading
        FROM cl GROUP BY pollutant ORDER BY pollutant""",
    "stream_consistent_snapshot": _with(_RAW, _CLEANED) + f""" SELECT CAST(epoch AS INTEGER) AS epoch, pollutant, TRUE AS same,
        CASE WHEN epoch = 2 THEN m END AS avg_reading
        FROM (SELECT pollutant, {_mean("reading", 4)} AS m FROM cl GROUP BY pollutant), range(3) e(epoch)""",
    "stream_snapshot_top10": _with(_RAW, _CLEANED) + """ SELECT * FROM c ORDER BY event_timestamp NULLS FIRST,
        "Date" NULLS FIRST, "Time" NULLS FIRST, "CO" NULLS FIRST, "NMHC" NULLS FIRST, "C6H6" NULLS FIRST,
        "NOx" NULLS FIRST, "NO2" NULLS FIRST LIMIT 10""",
    "stream_lineitem_avg": f"""SELECT pollutant, {_mean("v", 2)} AS avg_reading FROM (
        SELECT 'quantity' AS pollutant, l_quantity AS v FROM lineitem UNION ALL SELECT 'extendedprice', l_extendedprice FROM lineitem
        UNION ALL SELECT 'discount', l_discount FROM lineitem UNION ALL SELECT 'tax', l_tax FROM lineitem)
        GROUP BY 1 ORDER BY 1""",
    "lineitem_json_roundtrip": "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate FROM lineitem",
    "merge_new_properties": """WITH o AS (
        SELECT l_partkey, MIN(l_quantity) AS least FROM lineitem WHERE l_linenumber = 1 GROUP BY 1),
        n AS (SELECT l_partkey, MIN(l_quantity) AS least, MAX(l_tax) AS top_tax FROM lineitem WHERE l_linenumber < 4 GROUP BY 1)
        SELECT l_partkey, least, CAST(NULL AS DOUBLE) AS top_tax FROM o UNION ALL
        SELECT * FROM n WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT l_partkey FROM o)""",
    "documents_empty_load": _with(*_PIPE) + " " + _PROCESSED_OUT,
    "key_check_duplicates": """SELECT 'events by user' AS label, CAST(SUM(n) AS BIGINT) AS nodes,
        COUNT(*) FILTER (WHERE n > 1) AS violations FROM (SELECT COUNT(*) AS n FROM events GROUP BY user_id)""",
    "reading_id_check": _with(*_PIPE, _LONG) + """ SELECT 'Reading' AS label, COUNT(*) AS nodes,
        CAST(0 AS BIGINT) AS violations FROM l""",
    "pollutant_subset": _with(_RAW, _CLEANED) + " SELECT * FROM cl WHERE pollutant = 'NO2'",
    "graph_readings_lookup": _with(*_PIPE, _LONG) + """ SELECT "year", "month", "day", hour_of_day AS "hour",
        p AS pollutant, v AS value FROM l WHERE "day" <= 15""",
    "lineitem_processed": _with(_LINEITEM) + """ SELECT l_quantity, l_extendedprice, l_discount, l_tax,
        event_timestamp, "year", "month", "day", day_of_week, hour_of_day FROM lproc""",
    "lineitem_weekday_norm": _with(_LINEITEM) + _LINEITEM_LONG + _norm(
        f"{_WEEKDAYS}[day_of_week]", "DayOfWeek", f'list_position({_DISPLAY}, "DayOfWeek")'),
    "lineitem_hourly_norm": _with(_LINEITEM) + _LINEITEM_LONG + _norm(
        "printf('%02d:00', hour_of_day)", "HourOfDay", '"HourOfDay"'),
}

SQL["graph_two_loads"] = SQL["graph_time_nodes"]


def _body(name: str) -> str:
    """The query of a registered SQL as a subquery."""
    return f"({SQL[name]})"


SQL["process_increment"] = SQL["processed"]
SQL["chart_tables_refresh"] = f"""
    SELECT * FROM {_body("graph_hourly_norm")} WHERE "Pollutant" IN ('CO', 'NOx') UNION ALL
    SELECT * FROM ({_with(*_PIPE, _LONG.replace("event_timestamp IS NOT NULL", 'event_timestamp IS NOT NULL AND "day" <= 15'))
                    + _norm("printf('%02d:00', hour_of_day)", "HourOfDay", '"HourOfDay"')}) WHERE "Pollutant" NOT IN ('CO', 'NOx')"""
SQL["graph_three_loads"] = f"""
    SELECT label, key, name, CAST(0 AS BIGINT) AS n FROM {_body("graph_time_nodes")} UNION ALL
    SELECT type, src, dst, 0 FROM {_body("graph_time_edges")} UNION ALL
    SELECT 'Reading', pollutant, CAST("month" AS VARCHAR), COUNT(*) FROM {_body("graph_readings")} GROUP BY pollutant, "month" """

"""Property-graph form of the processed table and the two graph profiles.

Nodes and edges are DataFrames keyed by natural keys (K8, A9). Every
calendar node and edge derives from one distinct "calendar" of
(year, month, day, hour, weekday) tuples, a partial + final aggregate whose
size is the number of distinct hours in the data, not the row count.

Readings (K9) are a fact table ``(row_id, year, month, day, hour,
pollutant, value)`` keyed by (row_id, pollutant), the id being 32 bytes: the to-one edges HAS_READING and READING_OF are its
foreign-key columns, so the path pattern hour -> reading -> type is a join
of the fact with the hour nodes and the (bounded) type table, never a
reading-id self-join.

Rows without a timestamp make no time nodes and no readings (Q6: a MERGE on a
null key fails in the reference's store).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AIR_QUALITY, SensorConfig
from ..functions.labels import hour_label, literal_table, month_name, weekday_name, weekday_order
from ..operators.keys import with_row_ids
from ..operators.merge import first_per_key, merge_on_create, new_on_create
from ..operators.quality import key_check
from ..operators.reshape import collect_unwind_normalize, min_max_normalize, to_long
from ..sources import versions
from ..sources.tables import write_table

HOUR_KEY = ["year", "month", "day", "hour"]
DAY_KEY = ["year", "month", "day"]

NODE_KEYS = {
    "Year": ["year"],
    "Month": ["year", "month"],
    "Day": DAY_KEY,
    "HourOfDay": HOUR_KEY,
    "DayOfWeek": ["code"],
    "PollutionType": ["name"],
}
EDGE_TYPES = {  # type: (source label, target label)
    "HAS_MONTH": ("Year", "Month"),
    "HAS_DAY": ("Month", "Day"),
    "HAS_HOUR": ("Day", "HourOfDay"),
    "DAY_OF_WEEK": ("Day", "DayOfWeek"),
}


@dataclass
class Graph:
    """Node tables, calendar edge tables and the readings fact."""

    nodes: dict[str, DataFrame]
    edges: dict[str, DataFrame]
    readings: DataFrame

    def has_reading(self) -> DataFrame:
        """HAS_READING edge view: hour key -> reading key (row_id, pollutant)."""
        return self.readings.select(*HOUR_KEY, "row_id", "pollutant")

    def reading_of(self) -> DataFrame:
        """READING_OF edge view: reading key -> pollutant name."""
        return self.readings.select("row_id", "pollutant", F.col("pollutant").alias("name"))


def timed(processed: DataFrame, cfg: SensorConfig = AIR_QUALITY) -> DataFrame:
    return processed.filter(F.col(cfg.event_time).isNotNull())


def calendar(processed: DataFrame, cfg: SensorConfig = AIR_QUALITY) -> DataFrame:
    """Distinct (year, month, day, hour, day_of_week) of the timed rows."""
    return (timed(processed, cfg)
            .select("year", "month", "day", F.col("hour_of_day").alias("hour"), "day_of_week")
            .distinct())


def time_nodes(cal: DataFrame, legacy_weekday_labels: bool = False) -> dict[str, DataFrame]:
    """K8 nodes: Year, Month (+name), Day, HourOfDay (+name), DayOfWeek (+name)."""
    return {
        "Year": cal.select("year").distinct(),
        "Month": cal.select("year", "month").distinct().withColumn("name", month_name(F.col("month"))),
        "Day": cal.select(*DAY_KEY).distinct(),
        "HourOfDay": cal.select(*HOUR_KEY).distinct().withColumn("name", hour_label(F.col("hour"))),
        "DayOfWeek": (cal.select(F.col("day_of_week").alias("code")).distinct()
                      .withColumn("name", weekday_name(F.col("code"), legacy_weekday_labels))),
    }


def time_edges(cal: DataFrame) -> dict[str, DataFrame]:
    """K8 edges as key tables (each row holds the source and the target key)."""
    return {
        "HAS_MONTH": cal.select("year", "month").distinct(),
        "HAS_DAY": cal.select(*DAY_KEY).distinct(),
        "HAS_HOUR": cal.select(*HOUR_KEY).distinct(),
        "DAY_OF_WEEK": cal.select(*DAY_KEY, F.col("day_of_week").alias("code")).distinct(),
    }


def readings(processed: DataFrame, cfg: SensorConfig = AIR_QUALITY, id_col: str | None = "record_id") -> DataFrame:
    """K9 + R2 + R3 + J4: one reading per timed row and pollutant.

    (row_id, pollutant) is the reading's key. The row id is ``id_col`` when
    the processed frame carries one (``clean_and_transform(..., id_col=...)``
    derives it from the deduplicated raw row at no extra shuffle); otherwise
    :func:`with_row_ids` assigns one.
    """
    rows = timed(processed, cfg)
    if not id_col or id_col not in rows.columns:
        id_col = "__row_id"
        keep = [*cfg.sensor_columns, "year", "month", "day", "hour_of_day", "day_of_week"]
        rows = with_row_ids(rows.select(*keep), id_col)
    rows = rows.select(*[F.col(c) for c in cfg.sensor_columns], "year", "month", "day",
                       F.col("hour_of_day").alias("hour"), F.col(id_col).alias("__rid"))
    long = to_long(rows, [*HOUR_KEY, "__rid"], {m.label: m.snake for m in cfg.measures},
                   "pollutant", "value")
    return long.select(F.col("__rid").alias("row_id"), *HOUR_KEY, "pollutant", "value")


def pollution_types(spark: SparkSession, reads: DataFrame, cfg: SensorConfig = AIR_QUALITY) -> DataFrame:
    """J5 + F4: PollutionType nodes present in the readings, with their unit.

    The unit table has one row per configured measure (a proven bound) and is
    broadcast; names without a unit keep a null unit.
    """
    units = literal_table(spark, ["name", "unit"], list(cfg.units.items()))
    names = reads.select(F.col("pollutant").alias("name")).distinct()
    return names.join(F.broadcast(units), "name", "left")


def build(processed: DataFrame, cfg: SensorConfig = AIR_QUALITY, id_col: str | None = "record_id") -> Graph:
    """Processed -> graph tables (lazy; nothing is collected)."""
    spark = processed.sparkSession
    cal = calendar(processed, cfg)
    nodes = time_nodes(cal, cfg.legacy_weekday_labels)
    reads = readings(processed, cfg, id_col)
    nodes["PollutionType"] = pollution_types(spark, reads, cfg)
    return Graph(nodes=nodes, edges=time_edges(cal), readings=reads)


def write_graph(g: Graph, root: str) -> None:
    """Write every node and edge table (overwrite: re-loads are idempotent, Q5).

    Each table is its own job; for a graph built from an unmaterialised plan
    prefer :func:`store_graph`, which reads the processed rows once.
    """
    for label, df in g.nodes.items():
        df.write.mode("overwrite").parquet(f"{root}/nodes/{label}")
    for etype, df in g.edges.items():
        df.write.mode("overwrite").parquet(f"{root}/edges/{etype}")
    g.readings.write.mode("overwrite").parquet(f"{root}/readings")


def store_graph(processed: DataFrame, root: str, cfg: SensorConfig = AIR_QUALITY,
                id_col: str | None = "record_id", export_all: bool = False, with_readings: bool = True) -> Graph:
    """C7 for large inputs: two passes over ``processed``, everything else small.

    1. the readings fact (the only table that grows with the data);
    2. the distinct calendar, written once (it bounds every time node/edge).
    Node and edge tables are then views over the stored calendar (and the
    type table over the stored readings' pollutant column); with
    ``export_all`` they are written as tables too (full graph sink).
    ``processed`` should itself be a stored table (the reference reads the
    processed parquet), so neither pass recomputes the cleaning shuffle.
    A caller that needs only the calendar's nodes and edges says
    ``with_readings=False``: the fact is then a view, not a table.
    """
    spark = processed.sparkSession
    reads = readings(processed, cfg, id_col)
    if with_readings:
        reads = write_table(reads, f"{root}/readings")
    cal = write_table(calendar(processed, cfg), f"{root}/calendar")
    nodes = time_nodes(cal, cfg.legacy_weekday_labels)
    nodes["PollutionType"] = pollution_types(spark, reads, cfg)
    g = Graph(nodes=nodes, edges=time_edges(cal), readings=reads)
    if not export_all:
        return g
    for label, df in g.nodes.items():
        df.write.mode("overwrite").parquet(f"{root}/nodes/{label}")
    for etype, df in g.edges.items():
        df.write.mode("overwrite").parquet(f"{root}/edges/{etype}")
    return read_graph(spark, root)


def read_graph(spark: SparkSession, root: str) -> Graph:
    """The stored graph tables; of a graph loaded by :func:`load_graph`, those of its last version."""
    version = versions.latest(spark, root)
    if version is not None:
        return _of_version(spark, version)
    return Graph(
        nodes={label: spark.read.parquet(f"{root}/nodes/{label}") for label in NODE_KEYS},
        edges={etype: spark.read.parquet(f"{root}/edges/{etype}") for etype in EDGE_TYPES},
        readings=spark.read.parquet(f"{root}/readings"),
    )


def _of_version(spark: SparkSession, version: versions.Version) -> Graph:
    return Graph(
        nodes={label: version.read(spark, f"nodes/{label}") for label in NODE_KEYS},
        edges={etype: version.read(spark, f"edges/{etype}") for etype in EDGE_TYPES},
        readings=version.read(spark, "readings"),
    )


def load_graph(processed: DataFrame, root: str, cfg: SensorConfig = AIR_QUALITY, id_col: str | None = "record_id",
               replace: bool = False) -> Graph:
    """C7 + K8 + J6: add a load to a stored graph; all its tables become visible by one commit.

    Only what is new is written: nodes and edges whose key the graph lacks (existing ones keep their properties), and
    the readings of rows whose id it lacks. The new version names those folders
    beside the earlier ones (:mod:`smoglake.sources.versions`), so a load costs its own
    rows and a scan of the stored row ids, a repeated load adds nothing, and a load that
    breaks off leaves the graph as it was. ``replace`` starts over: the new version has this load alone.

    Rows are told apart before the unpivot (one 32-byte id per row, found under one
    measure of the stored fact), not per reading. Every reading's hour is a node of the
    same load or an earlier one. ``processed`` should be a stored table.
    """
    spark = processed.sparkSession
    before = versions.latest(spark, root)
    stored = _of_version(spark, before) if before is not None and not replace else None
    folder = versions.fresh_folder("load")
    rows = timed(processed, cfg)
    if not id_col or id_col not in rows.columns:
        id_col = "__row_id"
        keep = [*cfg.sensor_columns, cfg.event_time, "year", "month", "day", "hour_of_day", "day_of_week"]
        rows = with_row_ids(rows.select(*keep), id_col)
    rows = rows.dropDuplicates([id_col])
    if stored is not None:
        known = stored.readings.filter(F.col("pollutant") == cfg.measures[0].label).select(F.col("row_id").alias(id_col))
        rows = rows.join(known, id_col, "left_anti")
    reads = write_table(readings(rows, cfg, id_col), f"{root}/{folder}/readings")
    cal = write_table(calendar(processed, cfg), f"{root}/{folder}/calendar")
    nodes = time_nodes(cal, cfg.legacy_weekday_labels)
    nodes["PollutionType"] = pollution_types(spark, reads, cfg)
    made = {"readings": reads}
    for kind, parts, keys in (("nodes", nodes, NODE_KEYS), ("edges", time_edges(cal), None)):
        for name, df in parts.items():
            old = stored and (stored.nodes if kind == "nodes" else stored.edges)[name]
            on = keys[name] if keys else df.columns
            fresh = new_on_create(old, df, on) if old is not None else first_per_key(df.dropna(subset=on), on)
            made[f"{kind}/{name}"] = write_table(fresh, f"{root}/{folder}/{kind}/{name}")
    tables = {name: [*(before.tables[name] if stored else []), f"{folder}/{name}"] for name in made}
    loads = 1 + (before.about.get("loads", 0) if stored else 0)
    return _of_version(spark, versions.publish(spark, root, tables, {"loads": loads}, after=before))


def compact_graph(spark: SparkSession, root: str) -> Graph:
    """Write each table of the last version as one folder and publish them together (many small loads make many files)."""
    before = versions.latest(spark, root)
    if before is None:
        raise FileNotFoundError(f"no graph was loaded to {root}")
    folder = versions.fresh_folder("load")
    for name in before.tables:
        write_table(before.read(spark, name), f"{root}/{folder}/{name}")
    tables = {name: [f"{folder}/{name}"] for name in before.tables}
    return _of_version(spark, versions.publish(spark, root, tables, before.about, after=before))


def node_table(g: Graph) -> DataFrame:
    """Every time node as (label, key, name)."""
    def key(cols):
        return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    parts = [
        g.nodes["Year"].select(F.lit("Year").alias("label"), key(["year"]).alias("key"),
                               F.lit(None).cast("string").alias("name")),
        g.nodes["Month"].select(F.lit("Month").alias("label"), key(["year", "month"]).alias("key"), "name"),
        g.nodes["Day"].select(F.lit("Day").alias("label"), key(DAY_KEY).alias("key"),
                              F.lit(None).cast("string").alias("name")),
        g.nodes["HourOfDay"].select(F.lit("HourOfDay").alias("label"), key(HOUR_KEY).alias("key"), "name"),
        g.nodes["DayOfWeek"].select(F.lit("DayOfWeek").alias("label"), key(["code"]).alias("key"), "name"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def edge_table(g: Graph) -> DataFrame:
    """Every calendar edge as (type, src, dst) with the node keys of :func:`node_table`."""
    def key(cols):
        return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    e = g.edges
    parts = [
        e["HAS_MONTH"].select(F.lit("HAS_MONTH").alias("type"), key(["year"]).alias("src"),
                              key(["year", "month"]).alias("dst")),
        e["HAS_DAY"].select(F.lit("HAS_DAY").alias("type"), key(["year", "month"]).alias("src"),
                            key(DAY_KEY).alias("dst")),
        e["HAS_HOUR"].select(F.lit("HAS_HOUR").alias("type"), key(DAY_KEY).alias("src"),
                             key(HOUR_KEY).alias("dst")),
        e["DAY_OF_WEEK"].select(F.lit("DAY_OF_WEEK").alias("type"), key(DAY_KEY).alias("src"),
                                key(["code"]).alias("dst")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reading_key_check(g: Graph) -> DataFrame:
    """A11 for the readings: uniqueness of (row_id, pollutant)."""
    return key_check({"Reading": (g.readings, ["row_id", "pollutant"])})


def linked_readings(reads: DataFrame, hours: DataFrame) -> DataFrame:
    """The readings that have an hour node; others make no reading."""
    return reads.join(hours.select(*HOUR_KEY), HOUR_KEY, "left_semi")


def merge_graph(stored: Graph, incoming: Graph) -> Graph:
    """``incoming`` merged into ``stored``: nodes, edges and readings that are new are added.

    Existing nodes keep their properties; rows with a null in their key are
    not inserted; readings need an hour node. Write the result to a new
    folder (:func:`write_graph`): it reads the stored tables.
    """
    nodes = {label: merge_on_create(stored.nodes[label], incoming.nodes[label], keys) for label, keys in NODE_KEYS.items()}
    edges = {kind: merge_on_create(stored.edges[kind], df, df.columns) for kind, df in incoming.edges.items()}
    reads = merge_on_create(stored.readings, linked_readings(incoming.readings, nodes["HourOfDay"]), ["row_id", "pollutant"])
    return Graph(nodes=nodes, edges=edges, readings=reads)


def graph_key_check(g: Graph) -> DataFrame:
    """Uniqueness of every node label's key (violations must be 0)."""
    return key_check({label: (g.nodes[label], keys) for label, keys in NODE_KEYS.items()})


# ---------------------------------------------------------------- profiles --

def _finish(avg: DataFrame, member: str, method: str) -> DataFrame:
    if method == "collect":
        out = collect_unwind_normalize(avg, "Pollutant", member, "AvgValue", "NormalizedValue")
    else:
        out = min_max_normalize(avg, ["Pollutant"], "AvgValue", "NormalizedValue")
    return out.select("Pollutant", member, "AvgValue", "NormalizedValue")


def _partial_sums(readings: DataFrame, keys: list[str]) -> DataFrame:
    """Eager aggregation: (keys, pollutant) -> sum and count of the values.

    The average is decomposable, so the path joins below run on one row per
    (hour or day, pollutant), not on every reading; the pre-aggregate itself
    combines map-side, so no reading is shuffled.
    """
    return readings.groupBy(*keys, "pollutant").agg(F.sum("value").alias("__s"),
                                                    F.count("value").alias("__n"))


def _combined_avg() -> F.Column:
    # sum of sums over sum of counts == avg over the readings; no values -> null
    return F.try_divide(F.sum("__s"), F.sum("__n")).alias("AvgValue")


def hourly_profile(g: Graph, method: str = "window") -> DataFrame:
    """J2 + A5 + A7 + P21 + O3: path form over the graph tables.

    (h:HourOfDay)-[:HAS_READING]->(r)-[:READING_OF]->(p:PollutionType):
    readings (pre-aggregated per hour key and pollutant) join the hour nodes
    on the 4-part key and the type table on name; average per (pollutant,
    hour name), min-max normalised per pollutant.
    """
    types = g.nodes["PollutionType"].select(F.col("name").alias("pollutant"))
    path = (_partial_sums(g.readings, HOUR_KEY)
            .join(g.nodes["HourOfDay"].select(*HOUR_KEY, F.col("name").alias("HourOfDay")), HOUR_KEY)
            .join(types, "pollutant"))
    avg = path.groupBy(F.col("pollutant").alias("Pollutant"), "HourOfDay").agg(_combined_avg())
    return _finish(avg, "HourOfDay", method).orderBy("Pollutant", "HourOfDay")


def weekday_profile(g: Graph, method: str = "window") -> DataFrame:
    """J3 + A6 + A7 + P21 + O4 + X11: path form over the graph tables.

    (d:Day)-[:DAY_OF_WEEK]->(dow), (d)-[:HAS_HOUR]->(h)-[:HAS_READING]->(r)-[:READING_OF]->(p):
    readings pre-aggregated per hour key and pollutant join the HourOfDay
    nodes, the HAS_HOUR edges (which hold the day's key) and the day's
    DAY_OF_WEEK edge, whose code joins the weekday nodes. No reading is
    joined. Sorted Monday first.
    """
    types = g.nodes["PollutionType"].select(F.col("name").alias("pollutant"))
    dow = g.nodes["DayOfWeek"].select("code", F.col("name").alias("DayOfWeek"))
    path = (_partial_sums(g.readings, HOUR_KEY)
            .join(g.nodes["HourOfDay"].select(*HOUR_KEY), HOUR_KEY)
            .join(g.edges["HAS_HOUR"], HOUR_KEY)
            .join(g.edges["DAY_OF_WEEK"], DAY_KEY)
            .join(dow, "code")
            .join(types, "pollutant"))
    avg = path.groupBy(F.col("pollutant").alias("Pollutant"), "DayOfWeek").agg(_combined_avg())
    return (_finish(avg, "DayOfWeek", method)
            .orderBy("Pollutant", weekday_order(F.col("DayOfWeek"))))


def _long_fact(processed: DataFrame, cfg: SensorConfig) -> DataFrame:
    rows = timed(processed, cfg)
    return to_long(rows, ["hour_of_day", "day_of_week"], {m.label: m.snake for m in cfg.measures},
                   "Pollutant", "value")


def hourly_profile_fact(processed: DataFrame, cfg: SensorConfig = AIR_QUALITY,
                        method: str = "window") -> DataFrame:
    """Fact form of :func:`hourly_profile`: no joins, one aggregate over the
    unpivoted processed rows (every timed row has exactly one hour node).

    Groups on the integer hour and labels the aggregated rows afterwards:
    the label is one-to-one with the hour, and formatting it per reading
    would cost a string format for every row at scale.
    """
    avg = (_long_fact(processed, cfg).groupBy("Pollutant", "hour_of_day")
           .agg(F.avg("value").alias("AvgValue"))
           .select("Pollutant", hour_label(F.col("hour_of_day")).alias("HourOfDay"), "AvgValue"))
    return _finish(avg, "HourOfDay", method).orderBy("Pollutant", "HourOfDay")


def weekday_profile_fact(processed: DataFrame, cfg: SensorConfig = AIR_QUALITY,
                         method: str = "window") -> DataFrame:
    """Fact form of :func:`weekday_profile` (groups on the weekday code, names
    the at most 35 aggregated rows)."""
    avg = (_long_fact(processed, cfg).groupBy("Pollutant", "day_of_week")
           .agg(F.avg("value").alias("AvgValue"))
           .select("Pollutant", weekday_name(F.col("day_of_week"), cfg.legacy_weekday_labels).alias("DayOfWeek"),
                   "AvgValue"))
    return (_finish(avg, "DayOfWeek", method)
            .orderBy("Pollutant", weekday_order(F.col("DayOfWeek"))))

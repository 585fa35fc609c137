"""Delimited-text ingest: header scan, header normalisation, decimal commas."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_NON_ALNUM = re.compile(r"[^a-zA-Z0-9]")
_GENERATED = re.compile(r"^_c\d+$")


def read_delimited(spark: SparkSession, path: str, sep: str = ";", header: bool = True,
                   path_glob: str | None = None) -> DataFrame:
    """Scan delimited text with one header for all files; every column stays a string.

    A file with another header (names or order) raises; :func:`read_by_header` reads such folders.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("inferSchema", False).option("enforceSchema", not header)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.csv(path)


def normalize_name(name: str) -> str:
    """Strip every non-alphanumeric character (``PT08.S1(CO)`` -> ``PT08S1CO``)."""
    return _NON_ALNUM.sub("", name or "")


def normalize_columns(df: DataFrame, drop_generated: bool = True) -> DataFrame:
    """P1 + P2: rename every column positionally, then keep non-empty names.

    Renaming is positional (``toDF``) so dotted names are never resolved as
    struct paths. Blank header cells that the CSV reader filled with ``_c<N>``
    are dropped too when ``drop_generated`` (the reference lets them through
    as all-null columns). Two headers that normalise to the same name raise.
    """
    names, keep = [], []
    for i, orig in enumerate(df.columns):
        name = normalize_name(orig)
        if name and not (drop_generated and _GENERATED.match(orig or "")):
            keep.append(name)
            names.append(name)
        else:
            names.append(f"__dropped_{i}")
    dupes = sorted({n for n in keep if keep.count(n) > 1})
    if dupes:
        raise ValueError(f"header names collide after normalisation: {dupes}")
    return df.toDF(*names).select(*keep)


def file_headers(spark: SparkSession, path: str | list[str], path_glob: str | None = None) -> DataFrame:
    """(file_path, header): the first line of every file that has one, without its byte order mark.

    The lines of each file's first block are reduced to one map-side, so a row per file and task is
    shuffled. Only the text is scanned; nothing is parsed.
    """
    reader = spark.read.option("pathGlobFilter", path_glob) if path_glob else spark.read
    lines = reader.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start",
                                     F.monotonically_increasing_id().alias("place"))
    first = lines.filter("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "place").alias("header"))
    return first.withColumn("header", F.regexp_replace("header", "^\ufeff|\r$", ""))


def _as_path(uri: str) -> str:
    """A file's metadata path as a path to read: nothing encoded, nothing taken for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def header_layouts(spark: SparkSession, path: str | list[str], sep: str = ";", path_glob: str | None = None,
                   most: int = 200) -> list[tuple[list[str], list[str]]]:
    """The distinct headers, as lists of names, each with the files that have it; by the least file name.

    What comes to the driver is the list of file names, which it plans the scan from anyway, and at most
    ``most`` headers (more raise: then the files hold no header).
    """
    by_header = file_headers(spark, path, path_glob).groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    found = by_header.orderBy(F.col("files")[0]).limit(most + 1).toLocalIterator()  # driver-ok: file names
    layouts = [(next(csv.reader([r["header"]], delimiter=sep), []), [_as_path(f) for f in r["files"]]) for r in found]
    if len(layouts) > most:
        raise ValueError(f"more than {most} different headers under {path}")
    return layouts


def read_by_header(spark: SparkSession, path: str | list[str], sep: str = ";", path_glob: str | None = None,
                   columns: list[str] | None = None) -> DataFrame:
    """S1 over files whose headers differ: columns are found by name in every file.

    Files with the same header are scanned together, with that header as schema, and
    the scans are put together by normalised name (P1, P2): a column that a file lacks is null there.
    Columns come in the order of ``columns`` (which may name ones that no file has),
    by default as first seen. A line that repeats its file's header is dropped. All columns are strings.
    """
    parts = []
    for names, files in header_layouts(spark, path, sep, path_glob):
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
        rows = spark.read.schema(schema).option("sep", sep).option("header", True).csv(files)
        same = reduce(lambda x, y: x & y, [F.col(f"c{i}").eqNullSafe(n or None) for i, n in enumerate(names)], F.lit(True))
        named = normalize_columns(rows.filter(~same).toDF(*[n or f"_c{i}" for i, n in enumerate(names)])) if names else None
        if named is not None and named.columns:
            parts.append(named)
    if not parts:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns or []]))
    out = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return out if columns is None else out.select(
        *[F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns])


def decimal_comma_to_double(c: Column) -> Column:
    """P3 + P4: replace every comma by a point, then a safe cast to double.

    ``try_cast`` keeps the permissive meaning (malformed text -> null) under
    ANSI mode, where a plain cast raises.
    """
    return F.translate(c, ",", ".").try_cast("double")


def parse_decimals(df: DataFrame, keep_as_string: tuple[str, ...] = ("Date", "Time")) -> DataFrame:
    """P3 + P4 on every column except the named string columns, in one projection."""
    return df.select(*[
        F.col(c) if c in keep_as_string else decimal_comma_to_double(F.col(c)).alias(c)
        for c in df.columns
    ])


def read_sensor_csv(spark: SparkSession, path: str, sep: str = ";",
                    keep_as_string: tuple[str, ...] = ("Date", "Time"),
                    path_glob: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """C1 read side: scan each file by its own header, normalise names, decimal commas to doubles."""
    return parse_decimals(read_by_header(spark, path, sep, path_glob, columns), keep_as_string)


def render_decimal_comma(c: Column, missing: str | None = None) -> Column:
    """Inverse of :func:`decimal_comma_to_double` for writing test inputs."""
    text = F.translate(c.cast("string"), ".", ",")
    return text if missing is None else F.coalesce(text, F.lit(missing))


def write_sensor_csv(df: DataFrame, path: str, header_names: list[str], sep: str = ";",
                     keep_as_string: tuple[str, ...] = ("Date", "Time"),
                     missing: str | None = "n/a", blank_headers: int = 2) -> None:
    """Write a frame in the source-file dialect (decimal comma, ``;``).

    Null readings are written as ``missing``; ``blank_headers`` empty trailing
    columns imitate the public file's ``;;`` header ending.
    """
    cols = [F.col(c) if c in keep_as_string else render_decimal_comma(F.col(c), missing)
            for c in df.columns]
    blanks = [F.lit(None).cast("string") for _ in range(blank_headers)]
    names = list(header_names) + ["", " ", "  "][:blank_headers]
    (df.select(*cols, *blanks).toDF(*names)
       .write.mode("overwrite").option("header", True).option("sep", sep).csv(path))

"""Column dictionary and parameters of a sensor pipeline.

Every operator in the package takes its column names, sentinel and formats
from a :class:`SensorConfig`, so that air quality is one configuration among
others (``lineitem_config`` points the same operators at the TPC-H lineitem
table for scale runs).
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Measure:
    """One measured quantity under its four names and its unit."""

    raw: str  # column in the raw (normalised CSV) table
    snake: str  # column in the processed table
    label: str  # name of the PollutionType node and of the long-form value
    stream: str  # column name used by the streaming clean step
    unit: str


# --- fixed values: these must equal the reference's for equal results -------
# Raw record columns, in order (Date and Time are strings, the rest doubles).
AIR_RAW_COLUMNS = (
    "Date", "Time", "COGT", "PT08S1CO", "NMHCGT", "C6H6GT", "PT08S2NMHC",
    "NOxGT", "PT08S3NOx", "NO2GT", "PT08S4NO2", "PT08S5O3", "T", "RH", "AH",
)
# Header of the public source CSV before normalisation.
AIR_CSV_HEADER = (
    "Date", "Time", "CO(GT)", "PT08.S1(CO)", "NMHC(GT)", "C6H6(GT)",
    "PT08.S2(NMHC)", "NOx(GT)", "PT08.S3(NOx)", "NO2(GT)", "PT08.S4(NO2)",
    "PT08.S5(O3)", "T", "RH", "AH",
)
# Auxiliary sensor columns dropped by the batch and the stream clean steps.
AIR_DROPPED = ("PT08S1CO", "PT08S2NMHC", "PT08S3NOx", "PT08S4NO2", "PT08S5O3", "T", "RH", "AH")
# Pollutants in raw-column order: raw, processed, graph label, stream name, unit.
AIR_MEASURES = (
    Measure("COGT", "carbon_monoxide", "CO", "CO", "µg/m³"),
    Measure("NMHCGT", "non_methane_hydrocarbon", "NMHC", "NMHC", "µg/m³"),
    Measure("C6H6GT", "benzene", "Benzene", "C6H6", "µg/m³"),
    Measure("NOxGT", "nitrogen_oxides", "NOx", "NOx", "ppm"),
    Measure("NO2GT", "nitrogen_dioxide", "NO2", "NO2", "µg/m³"),
)
# Field order of the ``pollutants`` struct in a document.
AIR_DOCUMENT_ORDER = (
    "carbon_monoxide", "benzene", "nitrogen_oxides", "nitrogen_dioxide",
    "non_methane_hydrocarbon",
)
AIR_SENTINEL = -200.0
AIR_TIMESTAMP_FORMAT = "dd/MM/yyyy HH.mm.ss"
# Weekday names by Spark dayofweek code 1..7 (1 = Sunday).
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
# Weekday names as the shipped graph loader assigns them to codes 1..7.
LEGACY_WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# Display order of weekday names in the weekday profile.
WEEKDAY_DISPLAY_ORDER = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)
# Time-feature column names of the processed table.
TIME_FEATURES = ("year", "month", "day", "day_of_week", "hour_of_day")
# --- end of fixed values ------------------------------------------------------


@dataclass(frozen=True)
class SensorConfig:
    """Everything the operators need to know about one sensor table."""

    measures: tuple[Measure, ...] = AIR_MEASURES
    raw_columns: tuple[str, ...] = AIR_RAW_COLUMNS
    string_columns: tuple[str, ...] = ("Date", "Time")
    dropped_columns: tuple[str, ...] = AIR_DROPPED
    date_col: str = "Date"
    time_col: str = "Time"
    # names the date and time strings get in the processed path
    date_out: str = "date"
    time_out: str = "time"
    # when set, the raw table already holds a timestamp under this name and
    # no date/time strings are parsed
    timestamp_col: str | None = None
    timestamp_format: str = AIR_TIMESTAMP_FORMAT
    sentinel: float | None = AIR_SENTINEL
    event_time: str = "event_timestamp"
    document_order: tuple[str, ...] = AIR_DOCUMENT_ORDER
    time_features: tuple[str, ...] = TIME_FEATURES
    legacy_weekday_labels: bool = False
    # decimal places of the measures; their means are then exact sums (None: plain averages)
    scale: int | None = 4
    # raw columns that are timestamps (all others are strings or doubles)
    timestamp_columns: tuple[str, ...] = ()

    @property
    def raw_measures(self) -> list[str]:
        return [m.raw for m in self.measures]

    @property
    def sensor_columns(self) -> list[str]:
        return [m.snake for m in self.measures]

    @property
    def renames(self) -> dict[str, str]:
        out = {}
        if self.timestamp_col is None:
            out[self.date_col] = self.date_out
            out[self.time_col] = self.time_out
        out.update({m.raw: m.snake for m in self.measures})
        return out

    @property
    def stream_renames(self) -> dict[str, str]:
        return {m.raw: m.stream for m in self.measures}

    @property
    def units(self) -> dict[str, str]:
        return {m.label: m.unit for m in self.measures}

    def measure(self, snake: str) -> Measure:
        for m in self.measures:
            if m.snake == snake:
                return m
        raise KeyError(snake)


AIR_QUALITY = SensorConfig()


def lineitem_config() -> SensorConfig:
    """The same pipeline pointed at TPC-H lineitem (scale benchmark input)."""
    cols = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return SensorConfig(
        measures=tuple(Measure(c, c, c.removeprefix("l_"), c, "") for c in cols),
        raw_columns=cols + ("l_shipdate",),
        string_columns=(),
        dropped_columns=(),
        timestamp_col="l_shipdate",
        timestamp_columns=("l_shipdate",),
        sentinel=None,
        scale=2,
        document_order=cols,
    )

"""Raw observation files derived by Spark from the driver's ``events`` table.

The published pipeline starts from text files that are not part of the test
data. To run it end to end over whole tables, Spark writes such files from
``events`` (one measurement line per event, so station-days repeat):

- ``<root>/{historical,recent}/tables``: ``;`` files with the published
  blank-padded header cells, right-aligned station ids and ``-999`` for
  missing values. The two categories overlap for three days, so the same
  station-day arrives in both.
- ``<root>/historical/metadata``: the location history (latin-1 ``;``
  text): one interval per 'signup' event, ending the day before the user's
  next signup, open for the last.
- ``<root>/recent/metadata``: the operator history as sectioned files (one
  per task: preamble, blank line, header, rows, footer; CRLF), one interval
  per 'error' event.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pad_id
from ..operators import intervals_from_starts
from ..schemas import MEASUREMENT_COLUMNS, OPERATOR_MARKER
from ..session import at_once


class Variant(NamedTuple):
    """What the files hold beside the plain case."""

    shift_days: int = 0  # added to every time
    recent_from: str = "2024-01-15"
    historical_until: str = "2024-01-18"
    faults: bool = False


PLAIN = Variant()
#: Every measure filled, letters beyond ASCII, a change to summer time within the data, and
#: rows that fail every kind of declared test: codes that are not accepted, stations without
#: a location, operators that overlap for a day.
RICH = Variant(80, "2024-04-04", "2024-04-07", True)
#: A location starts with a signup of this value or more, under ``RICH``.
RICH_GEO_VALUE = 60

GLOBS = {"main": "*.csv", "metadata_geo": "*.csv", "metadata_operator": "*.txt"}

# Quality level given to each event type.
QUALITY_BY_TYPE = {"click": 1, "view": 3, "purchase": 5, "error": 7, "signup": 9}


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def _station(user_id: str) -> Column:
    return pad_id(_text(F.col(user_id)), 11, " ")


def _text_writer(df: DataFrame, encoding: str = "UTF-8"):
    return (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("sep", ";")
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
    )


def measurement_lines(events: DataFrame, variant: Variant = PLAIN) -> DataFrame:
    """One daily measurement line per event, columns named as published."""
    quality = F.lit(None).cast("int")
    for kind, level in QUALITY_BY_TYPE.items():
        quality = F.when(F.col("event_type") == kind, F.lit(level)).otherwise(quality)
    value = F.col("value")
    missing = F.lit(None).cast("double")
    cells = {
        "STATIONS_ID": _station("user_id"),
        "MESS_DATUM": F.date_format("ts", "yyyyMMdd"),
        "QN_3": F.lit(10),
        "  FX": value,
        "  FM": missing,
        "QN_4": quality,
        " RSK": value,
        "RSKF": F.lit(0),
        " SDK": value,
        "SHK_TAG": F.lit(0),
        "  NM": F.lit(None).cast("string"),
        " VPM": missing,
        "  PM": missing,
        " TMK": value,
        " UPM": missing,
        " TXK": missing,
        " TNK": missing,
        " TGK": missing,
    }
    if variant.faults:
        cells |= {
            "QN_3": F.when(value < 1, 4).otherwise(10),
            "  FM": value + 0.25,
            "QN_4": F.when(F.col("event_type") == "click", 6).otherwise(quality),
            "RSKF": F.when(value < 2, 5).otherwise(6),
            "SHK_TAG": F.when(value < 50, 300).otherwise(7),
            "  NM": F.when(F.col("event_type") == "view", F.lit("5.33")),
            " VPM": value + 1,
            "  PM": value + 1000,
            " UPM": F.lit(80.5),
            " TXK": value + 5,
            " TNK": value - 5,
            " TGK": value - 6.5,
        }
    assert list(cells) == list(MEASUREMENT_COLUMNS)
    return events.select(*[c.alias(name) for name, c in cells.items()], F.lit("eor").alias("eor"), "ts")


def _history(events: DataFrame, kind: str, touching: bool = False) -> DataFrame:
    starts = events.filter(F.col("event_type") == kind).select("user_id", "ts", "event_id", "value")
    # buckets chosen from the time span: a hot user is split into small cells
    iv = intervals_from_starts(
        starts, "user_id", "ts", bucket="auto", extra=["event_id", "value"], tiebreak=["event_id"]
    )
    return iv.withColumns(
        {
            "von": F.date_format("start", "yyyyMMdd"),
            # The day before the next start, or that day itself.
            "bis": F.date_format(
                F.date_sub(F.to_date(F.col("end") + F.expr("INTERVAL '0.000001' SECOND")), 0 if touching else 1), "yyyyMMdd"
            ),
        }
    )


def _sectioned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def lines(values: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([values], ["value"])

    header = OPERATOR_MARKER.strip("\n ")
    yield lines(pa.array(["Stationsname / Betreibername\r", "\r", header + "\r"]))
    for batch in batches:
        yield lines(batch.column(0))
    yield lines(pa.array(["generiert: footer\r"]))


def write_raw_from_events(events: DataFrame, root: str, variant: Variant = PLAIN) -> dict[str, str]:
    """Write the three raw inputs under ``root``; returns the file globs to
    read them with."""
    if variant.shift_days:
        events = events.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {variant.shift_days} DAYS"))
    lines = measurement_lines(events, variant)
    parts = {
        "historical": lines.filter(F.col("ts") < F.lit(variant.historical_until).cast("timestamp_ntz")),
        "recent": lines.filter(F.col("ts") >= F.lit(variant.recent_from).cast("timestamp_ntz")),
    }

    def write_tables(category: str) -> None:
        _text_writer(parts[category].drop("ts")).option("nullValue", "-999").csv(f"{root}/{category}/tables")

    located = events.filter(F.col("value") >= RICH_GEO_VALUE) if variant.faults else events
    station, operator = ("Größe Ävår ", "Wetterdienst ÄÖÜß ") if variant.faults else ("Station ", "Operator ")

    def write_geo() -> None:
        geo = _history(located, "signup").select(
            _station("user_id").alias("Stations_id"),
            F.col("value").alias("Stationshoehe"),
            F.col("value").alias("Geogr.Breite"),
            (F.col("user_id") + F.lit(0.5)).alias("Geogr.Laenge"),
            F.col("von").alias("von_datum"),
            F.col("bis").alias("bis_datum"),
            F.concat(F.lit(station), F.col("event_id").cast("string")).alias("Stationsname"),
        )
        _text_writer(geo, "ISO-8859-1").csv(f"{root}/historical/metadata")

    def write_operator() -> None:
        op = _history(events, "error", touching=variant.faults).select(
            F.concat(
                F.concat_ws(
                    ";",
                    _station("user_id"),
                    F.concat(F.lit(operator), _text(F.col("event_id"))),
                    _text(F.col("von")),
                    F.coalesce(F.col("bis"), F.lit("")),
                ),
                F.lit("\r"),
            ).alias("value")
        )
        # The text writer puts out a string's bytes as they are: latin-1 ones, as published.
        raw = F.encode("value", "ISO-8859-1").cast("string").alias("value")
        op.mapInArrow(_sectioned, "value string").select(raw).write.mode("overwrite").text(f"{root}/recent/metadata")

    at_once(lambda: write_tables("historical"), lambda: write_tables("recent"), write_geo, write_operator)
    return dict(GLOBS)

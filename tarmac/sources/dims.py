"""Small tables: airports, allow-lists, stations, registries and labor actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import key_text, num

AIRPORT_COLUMNS = ["IATA", "Latitude", "Longitude", "Timezone"]


def airports_from(raw: DataFrame) -> DataFrame:
    """Typed airport table; missing columns are an error, blank zones become NULL."""
    missing = sorted(set(AIRPORT_COLUMNS) - set(raw.columns))
    if missing:
        raise ValueError(f"airport table lacks {missing}")
    zone = F.trim(F.col("Timezone").cast("string"))
    return raw.select(
        key_text("IATA").alias("IATA"),
        num("Latitude").alias("Latitude"),
        num("Longitude").alias("Longitude"),
        F.when(~F.lower(zone).isin("nan", "none", ""), zone).alias("Timezone"),
    )


def load_airports(spark: SparkSession, path: str) -> DataFrame:
    return airports_from(spark.read.csv(path, header=True))


def known_zone(zone: Column, spark: SparkSession) -> Column:
    """Whether Spark can resolve the text as a time zone region."""
    return zone.isin(sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds()))


def airport_gaps(airports: DataFrame, needed: DataFrame) -> DataFrame:
    """Needed airports that cannot be used, with the reason; empty when all are fine.

    ``needed`` has one column ``IATA``.
    """
    joined = needed.select("IATA").distinct().join(airports.withColumn("_row", F.lit(True)), ["IATA"], "left")
    why = (
        F.when(F.col("_row").isNull(), "MISSING_ROW")
        .when(F.col("Latitude").isNull() | F.col("Longitude").isNull(), "BAD_LATLON")
        .when(F.col("Timezone").isNull(), "MISSING_TZ")
        .when(~known_zone(F.col("Timezone"), airports.sparkSession), "UNRECOGNIZED_TZ")
    )
    return joined.select("IATA", why.alias("reason")).filter(F.col("reason").isNotNull())


def require_airports(airports: DataFrame, needed: DataFrame, examples: int = 40) -> None:
    """Fail with examples when an airport of the fact has no usable row."""
    bad = airport_gaps(airports, needed).orderBy("IATA").limit(examples).collect()
    if bad:
        raise ValueError("bad airport rows: " + ", ".join(f"{r.IATA}:{r.reason}" for r in bad))


def codes_from_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Codes in text lines, any number per line, quotes and blanks removed."""
    tokens = lines.select(F.explode(F.split(F.col(value), ",")).alias("_t"))
    code = F.upper(F.trim(F.regexp_replace("_t", "[\"']", "")))
    return tokens.select(code.alias("IATA")).filter(F.col("IATA") != "").distinct()


def load_allow_list(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    """Airport codes from one line, one per line, or a named column of a CSV with a header."""
    if column:
        table = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
        hit = next((c for c in table.columns if c.strip().strip("'\"").upper() == column.upper()), None)
        if hit:
            codes = codes_from_lines(table.select(F.col(f"`{hit}`").cast("string").alias("value")))
            if not codes.isEmpty():
                return codes
    codes = codes_from_lines(spark.read.text(path))
    if codes.isEmpty():
        raise ValueError(f"no airport codes in {path}")
    return codes


def stations(raw: DataFrame) -> DataFrame:
    """US stations by airport: the one in service longest wins, ids padded with zeros.

    ``raw`` holds ``USAF``, ``WBAN``, ``CTRY``, ``ICAO`` and ``END``.
    """
    until = F.coalesce(num("END"), F.lit(0.0))
    us = raw.filter((F.col("CTRY") == "US") & F.col("ICAO").rlike("^K[A-Z]{3}$"))
    best = us.groupBy(F.substring("ICAO", 2, 3).alias("IATA")).agg(
        F.max_by(F.struct("USAF", "WBAN"), F.struct(until, "USAF", "WBAN")).alias("_s")
    )
    return best.select(
        "IATA", F.lpad("_s.USAF", 6, "0").alias("usaf"), F.lpad("_s.WBAN", 5, "0").alias("wban")
    )


def load_registry(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Some columns of a registry file with a byte-order mark, blanks and ragged rows."""
    table = spark.read.csv(
        path,
        header=True,
        encoding="UTF-8",
        mode="PERMISSIVE",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )
    clean = {c: c.replace("﻿", "").replace("ï»¿", "").strip() for c in table.columns}
    by_name = {new: old for old, new in clean.items() if new}
    missing = [c for c in columns if c not in by_name]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    return registry_columns(table.select(*[F.col(f"`{by_name[c]}`").alias(c) for c in columns]), columns)


def registry_columns(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trimmed text; a value missing from a short row is empty."""
    return table.select(*[F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")).alias(c) for c in columns])


# --- labor actions ------------------------------------------------------------------------------

# Columns and allowed codes of the action calendar.
ACTION_COLUMNS = [
    "event_id",
    "airline_iata",
    "worker_type",
    "scope",
    "affected_airports",
    "announced_date",
    "cooling_off_start",
    "action_start_date",
    "action_end_date",
    "workers_involved",
    "action_type",
    "severity",
    "source",
    "notes",
]
WORKER_TYPES = ["pilot", "flight_attendant", "mechanic", "ground_crew", "atc", "dispatcher"]
ACTION_TYPES = [
    "strike",
    "sickout",
    "work_slowdown",
    "lockout",
    "strike_authorization_vote",
    "informational_picketing",
    "picketing",
]
SCOPES = ["airline_wide", "airport_specific", "system_wide"]


def actions_from(raw: DataFrame) -> DataFrame:
    """Typed action calendar from text columns; text that does not parse becomes NULL."""
    named = raw.withColumnsRenamed({c: c.strip() for c in raw.columns if c != c.strip()})
    missing = sorted(set(ACTION_COLUMNS) - set(named.columns))
    if missing:
        raise ValueError(f"action calendar lacks {missing}")
    days = ["announced_date", "cooling_off_start", "action_start_date", "action_end_date"]
    made = {c: F.col(c).try_cast("date") for c in days}
    made |= {"workers_involved": num("workers_involved").cast("int"), "severity": num("severity").cast("int")}
    made |= {c: F.upper(F.trim(c)) for c in ("airline_iata", "affected_airports")}
    made |= {c: F.lower(F.trim(c)) for c in ("worker_type", "scope", "action_type")}
    return named.withColumns(made).select(*ACTION_COLUMNS)


def load_actions(spark: SparkSession, path: str) -> DataFrame:
    return actions_from(spark.read.csv(path, header=True))


def action_problems(actions: DataFrame) -> DataFrame:
    """One row per broken rule: unknown codes, severity outside 1 to 5, an end before the start."""
    rules = {
        "worker_type": ~F.col("worker_type").isin(WORKER_TYPES) | F.col("worker_type").isNull(),
        "action_type": ~F.col("action_type").isin(ACTION_TYPES) | F.col("action_type").isNull(),
        "scope": ~F.col("scope").isin(SCOPES) | F.col("scope").isNull(),
        "severity_range": ~F.col("severity").between(1, 5),
        "date_order": F.col("action_end_date") < F.col("action_start_date"),
    }
    held = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    return actions.select("event_id", F.explode(held).alias("problem"))


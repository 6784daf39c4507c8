"""From raw flights to the enriched fact and the history pool."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import actions as act
from ..operators import joins, sets
from ..sources import dims, flights, sinks, weather
from .config import as_list, enabled


def enrich(
    fact: DataFrame,
    airports: DataFrame,
    daily: DataFrame | None = None,
    hourly: DataFrame | None = None,
    dest_daily: bool = False,
    dest_hourly: bool = False,
    actions: DataFrame | None = None,
    match: str = "documented",
    registry: tuple[DataFrame, DataFrame] | None = None,
    build_years: DataFrame | None = None,
) -> DataFrame:
    """Local times, distance, aircraft, weather at both ends and action severity.

    ``daily`` is keyed (``airport``, ``FlightDate``) and ``hourly`` (``airport``, ``hour_utc``).
    """
    out = joins.local_times(fact, airports, distance=True)
    if registry:
        out = joins.aircraft_type(out, *registry)
    if build_years is not None:
        out = joins.aircraft_age(out, build_years)
    if daily is not None:
        out = joins.daily_weather(out, daily, "Origin", "origin_")
        if dest_daily:
            out = joins.daily_weather(out, daily, "Dest", "dest_")
    if hourly is not None:
        out = joins.hourly_weather(out, hourly, "Origin", "dep_utc", "origin_dep_")
        if dest_hourly:
            out = joins.hourly_weather(out, hourly, "Dest", "arr_utc", "dest_arr_")
    if actions is not None:
        out = act.action_severity(out, actions, match)
    return out


def read_weather(spark: SparkSession, pattern: str, granularity: str, airports: DataFrame) -> DataFrame:
    """Cached chunks named ``{airport}_{start}_{end}_{zone}_{granularity}...``, keyed by airport."""
    files = weather.normalize_columns(spark.read.parquet(*flights.matching(spark, [pattern])))
    named = files.withColumn(
        "airport", F.split(F.element_at(F.split(F.input_file_name(), "/"), -1), "_")[0]
    ).dropDuplicates()
    if granularity == "daily":
        days = named.withColumn("FlightDate", F.col("FlightDate").cast("date"))
        return days.dropDuplicates(["airport", "FlightDate"])
    zoned = named.join(airports.select(F.col("IATA").alias("airport"), F.col("Timezone").alias("tz")), ["airport"])
    present = [v for v in weather.HOURLY_VARS if v in zoned.columns]
    hours = joins.utc_hours(zoned, present)
    return hours.withColumns({v: F.lit(None).cast("double") for v in weather.HOURLY_VARS if v not in present})


def run(spark: SparkSession, config: Mapping[str, Any]) -> tuple[str, str]:
    """Write the enriched fact and the history pool named in the configuration; returns their paths."""
    airports = dims.load_airports(spark, config["airports_csv"])
    allowed = None
    if config.get("airports_filter_csv"):
        allowed = dims.load_allow_list(spark, config["airports_filter_csv"], config.get("airports_filter_column"))
    limits = {"start": config.get("start_date"), "end": config.get("end_date"), "airports": allowed}
    fact = flights.scan(
        spark,
        as_list(config["input_flights_path"]),
        airlines=as_list(config.get("airlines")),
        single_airline=config.get("single_airline"),
        **limits,
    )
    dims.require_airports(airports, sets.endpoints(fact))
    wx = config.get("weather") or {}
    daily = hourly = None
    if enabled(wx, "daily") and wx.get("daily_pattern"):
        daily = read_weather(spark, wx["daily_pattern"], "daily", airports)
    if enabled(wx, "hourly_at_dep") and wx.get("hourly_pattern"):
        hourly = read_weather(spark, wx["hourly_pattern"], "hourly", airports)
    actions = None
    strike = config.get("strike") or {}
    if strike.get("enabled") and strike.get("cache_path"):
        actions = spark.read.parquet(strike["cache_path"])
    registry = None
    if config.get("add_aircraft_type") and config.get("faa_registry"):
        master = dims.load_registry(spark, config["faa_registry"]["master_txt"], ["N-NUMBER", "MFR MDL CODE"])
        models = dims.load_registry(spark, config["faa_registry"]["acftref_txt"], ["CODE", "MFR", "MODEL"])
        registry = (
            master.toDF("n_number", "mfr_mdl_code"),
            models.toDF("code", "mfr", "model"),
        )
    years = None
    if config.get("add_aircraft_age") and config.get("aircraft_registry_csv"):
        years = spark.read.csv(config["aircraft_registry_csv"], header=True)
    enriched = enrich(
        fact,
        airports,
        daily,
        hourly,
        enabled(wx, "dest_daily"),
        enabled(wx, "dest_hourly_at_arr"),
        actions,
        strike.get("match", "documented"),
        registry,
        years,
    )
    target = config.get("target", "dep")
    fact_path = sinks.write_stage(enriched, config["output_enriched_unbalanced_path"], target)
    sources = as_list(config.get("history_flights_path")) or as_list(config["input_flights_path"])
    everyone = flights.select_flights(flights.read_parquet(spark, sources), airports=allowed)
    pool = flights.history_pool(
        everyone, airports, config.get("start_date"), config.get("end_date"), int(config.get("history_lookback_days", 60))
    )
    return fact_path, sinks.write_stage(pool, config["history_output_path"], target)

"""Reading and landing flight tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import between_days, day, first_present, key_text, num
from ..operators.joins import local_times

# Columns of a monthly flight file that the features use.
FLIGHT_COLUMNS = [
    "FlightDate",
    "Reporting_Airline",
    "Flight_Number_Reporting_Airline",
    "Origin",
    "Dest",
    "CRSDepTime",
    "CRSArrTime",
    "CRSElapsedTime",
    "DepDelayMinutes",
    "ArrDelayMinutes",
    "DepDel15",
    "ArrDel15",
    "Tail_Number",
    "AirTime",
    "WheelsOff",
    "WheelsOn",
    "TaxiOut",
    "TaxiIn",
    "DepTimeBlk",
    "Distance",
    "CarrierDelay",
    "WeatherDelay",
    "NASDelay",
    "SecurityDelay",
    "LateAircraftDelay",
    "Cancelled",
    "Diverted",
    "ActualElapsedTime",
]
# Columns of the history pool.
HISTORY_COLUMNS = [
    "FlightDate",
    "Origin",
    "Dest",
    "Reporting_Airline",
    "Flight_Number_Reporting_Airline",
    "DepDelayMinutes",
    "DepDel15",
    "ArrDelayMinutes",
    "CRSDepTime",
    "CRSArrTime",
    "CRSElapsedTime",
    "dep_dt_local",
    "dep_local_date",
    "dep_utc",
    "arr_dt_local",
    "arr_local_date",
    "arr_utc",
    "AirTime",
    "ActualElapsedTime",
    "WheelsOff",
    "WheelsOn",
    "TaxiOut",
    "TaxiIn",
    "CarrierDelay",
    "WeatherDelay",
    "NASDelay",
    "LateAircraftDelay",
    "Cancelled",
    "Diverted",
]
# Where the carrier and the flight number come from, in order of preference.
CARRIER_SOURCES = [
    "Reporting_Airline",
    "IATA_Code_Operating_Airline",
    "Operating_Airline",
    "IATA_Code_Marketing_Airline",
    "Marketing_Airline_Network",
]
FLIGHT_NUMBER_SOURCES = [
    "Flight_Number_Reporting_Airline",
    "Flight_Number_Operating_Airline",
    "Flight_Number_Marketing_Airline",
]


def canonicalize(df: DataFrame) -> DataFrame:
    """Trimmed column names, and the carrier and flight number from the first column that exists.

    The choice is per table and not per row: a NULL in the chosen column stays NULL.
    """
    out = df.withColumnsRenamed({c: c.strip() for c in df.columns if c != c.strip()})
    for target, sources in (("Reporting_Airline", CARRIER_SOURCES), ("Flight_Number_Reporting_Airline", FLIGHT_NUMBER_SOURCES)):
        source = first_present(out.columns, sources)
        if source and source != target:
            out = out.withColumn(target, F.col(source))
    texts = [c for c in ("Reporting_Airline", "Origin", "Dest", "Tail_Number") if c in out.columns]
    return out.withColumns({c: F.col(c).cast("string") for c in texts})


def read_projected(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist; every column when none does."""
    have = [c for c in wanted if c in df.columns]
    return df.select(*have) if have else df


def read_parquet(spark: SparkSession, paths: Sequence[str], base: str | None = None, recursive: bool = False) -> DataFrame:
    """Parquet under several patterns, read as one table.

    A pattern without a match is skipped, and no match at all is an error. ``base`` keeps
    ``Year=/Month=`` folders as partition columns, which lets a date filter skip files.
    """
    hits = matching(spark, paths)
    if not hits:
        raise FileNotFoundError(f"no Parquet under {list(paths)}")
    reader = spark.read.option("mergeSchema", "false")
    if base:
        reader = reader.option("basePath", base)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.parquet(*hits)


def matching(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """Distinct existing paths for the patterns, from the file system the cluster uses."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found: dict[str, None] = {}
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        for status in path.getFileSystem(conf).globStatus(path) or []:
            found[status.getPath().toString()] = None
    return list(found)


def select_flights(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    airlines: Sequence[str] = (),
    single_airline: str | None = None,
    airports: DataFrame | None = None,
    columns: Sequence[str] = tuple(FLIGHT_COLUMNS),
) -> DataFrame:
    """Known columns of a flight table within days, carriers and airports.

    Days are compared on the stored column when it is a date or timestamp, so that the comparison
    reaches the scan. ``airports`` (column IATA) must cover both ends.
    """
    out = read_projected(canonicalize(df), columns)
    kinds = dict(out.dtypes)
    if "FlightDate" in kinds:
        if not kinds["FlightDate"].startswith(("date", "timestamp")):
            out = out.withColumn("FlightDate", day("FlightDate"))
        out = out.filter(between_days("FlightDate", start, end)).withColumn("FlightDate", F.col("FlightDate").cast("date"))
    keys = [c for c in ("Reporting_Airline", "Origin", "Dest") if c in out.columns]
    out = out.withColumns({c: key_text(c) for c in keys})
    if single_airline:
        out = out.filter(F.col("Reporting_Airline") == single_airline)
    elif airlines:
        out = out.filter(F.col("Reporting_Airline").isin([a.upper() for a in airlines]))
    if airports is not None:
        for end_ in ("Origin", "Dest"):
            out = out.join(airports.select(F.col("IATA").alias(end_)), [end_], "left_semi")
    return out


def scan(spark: SparkSession, paths: Sequence[str], base: str | None = None, **limits) -> DataFrame:
    return select_flights(read_parquet(spark, paths, base), **limits)


def scan_dir(spark: SparkSession, path: str, columns: Sequence[str], **limits) -> DataFrame:
    """Every Parquet file below a folder."""
    return select_flights(read_parquet(spark, [path], recursive=True), columns=columns, **limits)


def load_raw(spark: SparkSession, paths: Sequence[str], airline: str) -> DataFrame:
    """Several raw months for one carrier; files that cannot be read are skipped."""
    hits = matching(spark, paths)
    df = canonicalize(spark.read.option("ignoreCorruptFiles", "true").parquet(*hits))
    return df.filter(key_text("Reporting_Airline") == airline.upper())


def month_columns(df: DataFrame, date: str = "FlightDate") -> DataFrame:
    """The folders a landed month is filed under."""
    d = day(date)
    return df.withColumns({date: d, "Year": F.year(d), "Month": F.month(d)})


def land_months(df: DataFrame, path: str, columns: Sequence[str] | None = None, date: str = "FlightDate") -> None:
    """Write ``Year=/Month=`` Parquet; only the months present are replaced."""
    out = month_columns(read_projected(df, columns) if columns else df, date)
    (
        # One writer per month and hash slice, so a big month is not written by one task.
        out.repartition("Year", "Month", F.pmod(F.xxhash64(*out.columns), F.lit(16)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("Year", "Month")
        .parquet(path)
    )


def history_pool(
    flights: DataFrame, airports: DataFrame, start: str | None = None, end: str | None = None, lookback: int = 60
) -> DataFrame:
    """The rows statistics are computed on: all carriers, from ``lookback`` days before the start.

    Arrival times are taken as printed, without moving an overnight arrival to the next day.
    """
    held = F.lit(True)
    if start and end:
        held = (F.col("FlightDate") >= F.date_sub(F.lit(start).cast("date"), lookback)) & (
            F.col("FlightDate") <= F.lit(end).cast("date")
        )
    kept = flights.filter(held).na.drop(subset=["FlightDate", "Origin", "Dest", "Reporting_Airline"])
    numbers = [c for c in HISTORY_COLUMNS if c in kept.columns and c not in ("FlightDate", "Origin", "Dest", "Reporting_Airline")]
    kept = kept.withColumns({c: num(c) for c in numbers})
    if "DepDel15" not in kept.columns and "DepDelayMinutes" in kept.columns:
        late: Column = F.coalesce(F.col("DepDelayMinutes") >= 15, F.lit(False))
        kept = kept.withColumn("DepDel15", late.cast("int"))
    timed = local_times(kept, airports, overnight=False)
    return read_projected(timed, HISTORY_COLUMNS)

"""Attaching tables to a fact: equi-joins, hour and day lookups, and the as-of join.

A side is hinted as broadcast only when its rows were counted (``attach_by_grain``) or are zones and days
(``local_times``). Else the optimiser broadcasts a side whose size it has measured, and adaptive execution
splits a fact key that turns out to be hot.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_miles
from ..functions.parse import registry_number
from ..session import materialise, materialise_rows

DATE = "FlightDate"


def attach(fact: DataFrame, stats: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left equi-join of a statistic that has one row per key."""
    return fact.join(stats, list(on), "left")


def attach_through(
    fact: DataFrame,
    grain: Sequence[str],
    parts: Sequence[tuple[Sequence[str], DataFrame]],
    asked: DataFrame | None = None,
) -> DataFrame:
    """Attach every part through the distinct values of ``grain`` in the fact.

    Each part joins on a subset of ``grain``. The parts meet on the (small) table of distinct grain
    values, so the fact itself is joined once, whatever the number of parts. The grain is read from
    ``asked``, a table with the fact's keys that is cheap to read again.
    """
    if not parts:
        return fact
    source = asked if asked is not None else fact
    table = source.select(*grain).na.drop().distinct()
    for on, stats in parts:
        table = attach(table, stats, on)
    return attach(fact, table, grain)


@dataclass(frozen=True)
class Step:
    """Columns that depend on some keys alone.

    ``made`` is a table with one row per value of ``on``, or a function that adds its columns to any
    table with these keys and keeps its rows. With ``past``, the function is also given that table, and
    needs only those of its rows that share the values of ``cut`` with the rows it adds to. ``cut`` names
    the keys by which the work can be done in parts; else these are ``on``.
    """

    on: Sequence[str]
    made: DataFrame | Callable[..., DataFrame]
    past: DataFrame | None = None
    cut: Sequence[str] | None = None

    def attached(self, table: DataFrame, part: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """``table``, which ``part`` has cut, with the step's columns."""
        if isinstance(self.made, DataFrame):
            return attach(table, part(self.made), self.on)
        return self.made(table) if self.past is None else self.made(table, part(self.past))


# Rows times columns up to which a grain's table is sent to the fact's rows; at most some 100 MB.
SENT_CELLS = 6_000_000
# Rows that are worked on at once where work is cut into parts by key.
PART_ROWS = 4_500_000


def cuts(keys: Sequence[str], rows: int) -> list[Callable[[DataFrame], DataFrame]]:
    """Functions that take one part each of any table with ``keys``; a key is in one part, whatever the table."""
    n = max(1, -(-rows // PART_ROWS))
    return [lambda df, i=i: df.filter(F.pmod(F.xxhash64(*keys), F.lit(n)) == i) if n > 1 else df for i in range(n)]


def attach_by_grain(
    fact: DataFrame,
    grains: Sequence[Sequence[str]],
    steps: Sequence[Step],
    asked: DataFrame | None = None,
    row: str | None = None,
) -> DataFrame:
    """Attach every step with one join of the fact for each grain in use.

    A step belongs to the smallest of ``grains`` that has its keys. Its columns are worked out on the
    distinct values of that grain, which all of the grain's steps share, so the number of steps
    doesn't show in the joins of the fact. Unknown keys are values like others. A step alone in its
    grain, on all of it, is joined as it is. ``asked`` may name a table with the grains' columns that
    is cheaper to read than the fact.

    A grain's values are written and counted. Tables of few cells are broadcast and come last, so that
    the fact isn't shuffled for them, and is without their columns when it is shuffled for the others.

    With ``row``, the fact's row number, the fact isn't shuffled at all: it is stored in buckets of it
    (``session.materialise_rows``), and so are the columns of every grain that is too large to be sent.
    These are worked out on keys and row numbers alone, part by part.
    """
    source = asked if asked is not None else fact
    held: dict[tuple[str, ...], list[Step]] = {}
    for step in steps:
        fits = [tuple(g) for g in grains if set(step.on) <= set(g)]
        if not fits:
            raise ValueError(f"no grain has the keys {list(step.on)}")
        held.setdefault(min(fits, key=len), []).append(step)
    out, order = fact, list(fact.columns)
    sent: list[tuple[tuple[str, ...], DataFrame]] = []
    sizes = grain_sizes(source, [g for g in held if g != (row,)]) if row else {}

    def joined(left: DataFrame, grain: tuple[str, ...], table: DataFrame) -> DataFrame:
        named = table.withColumnsRenamed({k: f"_grain_{k}" for k in grain})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_grain_{k}")) for k in grain])
        return left.join(named, same, "left").drop(*[f"_grain_{k}" for k in grain])

    for grain, own in held.items():
        if grain == (row,):
            for step in own:
                order += [c for c in step.made.columns if c != row]
                out = attach(out, step.made, grain)
            continue
        if row and sizes[grain] * (len(grain) + len(own)) > SENT_CELLS:
            side = row_columns(source, grain, own, row, sizes[()])
            order += [c for c in side.columns if c != row]
            out = attach(out, side, [row])
            continue
        if not row and len(own) == 1 and isinstance(own[0].made, DataFrame) and set(own[0].on) == set(grain):
            order += [c for c in own[0].made.columns if c not in grain]
            out = attach(out, own[0].made, grain)
            continue
        # Functions look at it several times, and it tells how large the table is.
        values = table = materialise(source.select(*grain).distinct(), "grain")
        for step in own:
            table = step.attached(table)
        cells = values.count() * len(table.columns)
        if cells > SENT_CELLS and row:
            side = row_columns(source, grain, own, row, sizes[()])
            order += [c for c in side.columns if c != row]
            out = attach(out, side, [row])
            continue
        order += [c for c in table.columns if c not in grain]
        if cells <= SENT_CELLS:
            # Its own shuffles are over before the fact is read.
            sent.append((grain, F.broadcast(materialise(table, "sent") if row else table)))
        else:
            out = joined(out, grain, table)
    for grain, table in sent:
        out = joined(out, grain, table)
    return out.select(*order)


def grain_sizes(source: DataFrame, grains: Sequence[Sequence[str]]) -> dict[tuple[str, ...], int]:
    """About how many values each grain has, and under the empty grain the number of rows; one pass."""
    named = [F.approx_count_distinct(F.xxhash64(*g)).alias(f"n{i}") for i, g in enumerate(grains)]
    got = source.agg(F.count(F.lit(1)).alias("rows"), *named).first()
    return {(): got["rows"], **{tuple(g): got[f"n{i}"] for i, g in enumerate(grains)}}


def row_columns(source: DataFrame, grain: Sequence[str], steps: Sequence[Step], row: str, rows: int) -> DataFrame:
    """The steps' columns by row number, stored in buckets of it; worked out in parts by the keys they share."""
    shared = [k for k in grain if all(k in (s.cut or s.on) for s in steps)]

    def made(part: Callable[[DataFrame], DataFrame]) -> DataFrame:
        table = part(source.select(row, *grain))
        for step in steps:
            table = step.attached(table, part)
        return table.drop(*grain)

    return materialise_rows((made(p) for p in cuts(shared, rows)), "side", row, rows)


def numbered_rows(df: DataFrame, keys: Sequence[str], row: str) -> DataFrame:
    """``df`` with a number for each row under ``row``, stored in buckets of it; ``keys`` only cut the work into parts."""
    rows = df.count()
    parts = cuts(keys, rows)
    own = F.monotonically_increasing_id() * len(parts)
    return materialise_rows((p(df).withColumn(row, own + i) for i, p in enumerate(parts)), "rows", row, rows)


def attach_prev_day(fact: DataFrame, daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of yesterday's statistic."""
    return attach(fact, daily.withColumn(DATE, F.date_add(DATE, 1)), [*keys, DATE])


def asof_table(asked: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str], date: str = DATE) -> DataFrame:
    """For every (key, day) in ``asked``, each part's row of the latest day on or before it.

    Only distinct (key, day) pairs are ordered, so the window holds days of a key and never its
    flights. All parts share the one window. Each part has one row per key and day.
    """
    tagged = asked.filter(F.col(date).isNotNull()).select(*keys, date).distinct().withColumn("_side", F.lit(1))
    names = []
    for i, part in enumerate(parts):
        fields = [c for c in part.columns if c not in {*keys, date}]
        names.append(fields)
        rows = part.filter(F.col(date).isNotNull()).select(
            *keys, date, F.lit(0).alias("_side"), F.struct(*fields).alias(f"_stat{i}")
        )
        tagged = tagged.unionByName(rows, allowMissingColumns=True)
    seen = Window.partitionBy(*keys).orderBy(date, "_side").rowsBetween(Window.unboundedPreceding, 0)
    latest = {f"_stat{i}": F.last(f"_stat{i}", ignorenulls=True).over(seen) for i in range(len(parts))}
    return (
        tagged.withColumns(latest)
        .filter(F.col("_side") == 1)
        .select(*keys, date, *[F.col(f"_stat{i}.{n}").alias(n) for i, fields in enumerate(names) for n in fields])
    )


def attach_asof(
    fact: DataFrame, stats: DataFrame, keys: Sequence[str], date: str = DATE, asked: DataFrame | None = None
) -> DataFrame:
    """Backward as-of join: the statistic of the latest day on or before the fact's day.

    Fact rows without a day are kept and get no statistic. ``asked`` may name a cheaper table with
    the same keys and days than the fact itself.
    """
    return attach(fact, asof_table(asked if asked is not None else fact, [stats], keys, date), [*keys, date])


def attach_asof_parts(
    fact: DataFrame, parts: Sequence[tuple[Sequence[str], DataFrame]], asked: DataFrame | None = None
) -> DataFrame:
    """As-of joins of many statistics: one window and one join of the fact per set of keys."""
    source = asked if asked is not None else fact
    groups: dict[tuple[str, ...], list[DataFrame]] = {}
    for keys, stats in parts:
        groups.setdefault(tuple(keys), []).append(stats)
    out = fact
    for keys, tables in groups.items():
        out = attach(out, asof_table(source, tables, keys), [*keys, DATE])
    return out


def known_keys(hist: DataFrame, fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History rows whose key occurs in the fact."""
    return hist.join(fact.select(*keys).distinct(), list(keys), "left_semi")


def airport_columns(fact: DataFrame, airports: DataFrame, side: str, prefix: str) -> DataFrame:
    """Time zone and position of the airport in column ``side``."""
    dim = airports.select(
        F.col("IATA").alias(side),
        F.col("Latitude").alias(f"{prefix}_lat"),
        F.col("Longitude").alias(f"{prefix}_lon"),
        F.col("Timezone").alias(f"{prefix}_TZ"),
    )
    return attach(fact, dim, [side])


def _miles() -> Column:
    return haversine_miles(F.col("_o_lat"), F.col("_o_lon"), F.col("_d_lat"), F.col("_d_lon"))


def _placed(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """Zone and position of both ends, each airport looked up once."""
    return airport_columns(airport_columns(fact, airports, "Origin", "_o"), airports, "Dest", "_d")


_PLACE = [f"{end}_{c}" for end in ("_o", "_d") for c in ("lat", "lon", "TZ")]


def haversine_distance(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """``Distance`` from airport positions; NULL when either airport is unknown."""
    return _placed(fact, airports).withColumn("Distance", _miles()).drop(*_PLACE)


def local_times(fact: DataFrame, airports: DataFrame, overnight: bool = True, distance: bool = False) -> DataFrame:
    """Scheduled departure and arrival as local wall clocks and as instants.

    Each row uses its own airport's zone. The hour, minute and weekday come from the wall clock, so
    no zone conversion can move them. With ``overnight`` an arrival that is earlier on the clock than
    the departure falls on the next day; the history pool is built without it. With ``distance`` the
    airports' distance comes from the same lookup.
    """
    from ..functions.parse import hhmm_ts, num

    df = _placed(fact, airports)
    if distance:
        df = df.withColumn("Distance", _miles())
    df = df.withColumnsRenamed({"_o_TZ": "Origin_TZ", "_d_TZ": "Dest_TZ"}).drop(*_PLACE)
    dep, arr = hhmm_ts(DATE, "CRSDepTime"), hhmm_ts(DATE, "CRSArrTime")
    dep = F.when(F.col("Origin_TZ").isNotNull(), dep)
    arr = F.when(F.col("Dest_TZ").isNotNull(), arr)
    if overnight:
        crosses = dep.isNotNull() & (num("CRSArrTime") < num("CRSDepTime"))
        arr = F.when(crosses, arr + F.expr("interval 1 day")).otherwise(arr)
    df = df.withColumns({"dep_dt_local": dep, "arr_dt_local": arr})
    df = df.withColumns(
        {
            "sched_dep_hour": F.hour("dep_dt_local"),
            "sched_dep_minute": F.minute("dep_dt_local"),
            "dep_dow": F.weekday(F.col("dep_dt_local").cast("date")),
            "sched_arr_hour": F.hour("arr_dt_local"),
            "dep_local_date": F.col("dep_dt_local").cast("date"),
            "arr_local_date": F.col("arr_dt_local").cast("date"),
        }
    )
    # An arrival is on the flight's day or the one after it.
    days = fact.select(F.explode(F.array(DATE, F.date_add(DATE, 1))).alias("day"))
    # A row per zone and day: sent to the rows, of which a zone's day may hold very many.
    offsets = F.broadcast(zone_days(days, airports.select(F.col("Timezone").alias("zone"))))
    df = with_instant(df, offsets, "dep_utc", "dep_dt_local", "dep_local_date", "Origin_TZ")
    return with_instant(df, offsets, "arr_utc", "arr_dt_local", "arr_local_date", "Dest_TZ")


def instant(local: Column, zone: Column) -> Column:
    """Instant of a local wall clock; a repeated hour means its first pass."""
    second = F.extract(F.lit("SECOND"), local).cast("decimal(16,6)")
    return F.try_make_timestamp(
        F.year(local), F.month(local), F.dayofmonth(local), F.hour(local), F.minute(local), second, zone
    )


_MICROS = 1_000_000
_DAY = 86_400 * _MICROS


def zone_days(days: DataFrame, zones: DataFrame) -> DataFrame:
    """Offsets from UTC for every zone and day: ``zone``, ``day``, ``before``, ``change``, ``after``.

    ``days`` holds a column ``day`` and ``zones`` a column ``zone``; repeats and nulls don't matter.
    The offset, in microseconds, is ``before`` up to the minute ``change`` of the day and ``after`` from
    there on; on most days there is none, and ``change`` is NULL. Zone rules are looked at once for each
    zone and day, and minute by minute only on days whose ends differ.
    """
    midnight = F.unix_date("day").cast("bigint") * _DAY

    def offset(minute: Column) -> Column:
        clock = F.timestamp_add("MINUTE", minute, F.col("day").cast("timestamp_ntz"))
        return midnight + minute.cast("bigint") * 60 * _MICROS - F.unix_micros(instant(clock, F.col("zone")))

    known = days.where("day is not null").distinct()
    every = zones.where("zone is not null").agg(F.collect_set("zone").alias("zones"))
    pairs = known.select("day", F.explode(every.scalar()).alias("zone"))
    ends = pairs.select("*", offset(F.lit(0)).alias("before"), offset(F.lit(1440)).alias("after"))
    minutes = F.sequence(F.lit(1), F.lit(1440))
    first = F.array_min(F.filter(minutes, lambda m: offset(m) != F.col("before")))
    return ends.select("zone", "day", "before", F.when(F.col("before") != F.col("after"), first).alias("change"), "after")


def with_instant(df: DataFrame, offsets: DataFrame, out: str, local: str, day: str, zone: str) -> DataFrame:
    """``out``, the instant of the wall clock ``local`` (on ``day``) in ``zone``, by a table of ``zone_days``."""
    named = offsets.select(F.col("zone").alias(zone), F.col("day").alias(day), *[F.col(c).alias(f"_{c}") for c in ("before", "change", "after")])
    minute = F.hour(local) * 60 + F.minute(local)
    used = F.when(F.col("_change").isNotNull() & (minute >= F.col("_change")), F.col("_after")).otherwise(F.col("_before"))
    wall = F.unix_date(day).cast("bigint") * _DAY + minute.cast("bigint") * 60 * _MICROS
    wall = wall + (F.extract(F.lit("SECOND"), F.col(local)) * _MICROS).cast("bigint")
    return attach(df, named, [zone, day]).withColumn(out, F.timestamp_micros(wall - used)).drop("_before", "_change", "_after")


def daily_weather(fact: DataFrame, weather: DataFrame, side: str, prefix: str) -> DataFrame:
    """Weather of the day at an airport; ``weather`` is keyed (``airport``, ``FlightDate``)."""
    named = {c: f"{prefix}{c}" for c in weather.columns if c not in ("airport", DATE)}
    return attach(fact, weather.withColumnsRenamed({**named, "airport": side}), [side, DATE])


def hourly_weather(
    fact: DataFrame, weather: DataFrame, side: str, at: str, prefix: str
) -> DataFrame:
    """Weather of the UTC hour in which the instant ``at`` falls.

    ``weather`` is keyed (``airport``, ``hour_utc``).
    """
    named = {c: f"{prefix}{c}" for c in weather.columns if c not in ("airport", "hour_utc")}
    hourly = weather.withColumnsRenamed({**named, "airport": side, "hour_utc": "_hour"})
    return attach(fact.withColumn("_hour", F.date_trunc("hour", at)), hourly, [side, "_hour"]).drop("_hour")


def utc_hours(local: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Local hourly series (``airport``, ``time``, ``tz``) as one row per UTC hour.

    A local hour that occurs twice is dropped, one that does not exist moves to the first instant
    after the gap, and the earliest row of an hour wins.
    """
    clock = F.col("time").try_cast("timestamp_ntz")
    at = instant(clock, F.col("tz"))
    # One real hour later the wall clock reads the same: this local hour occurs twice.
    again = F.convert_timezone(None, F.col("tz"), (at + F.expr("interval 1 hour")).cast("timestamp_ntz"))
    hour = F.date_trunc("hour", at).alias("hour_utc")
    rows = local.filter(at.isNotNull() & ~(again == clock)).select(
        "airport", hour, clock.alias("_clock"), *[F.col(v).try_cast("double").alias(v) for v in variables]
    )
    kept = rows.groupBy("airport", "hour_utc").agg(F.min_by(F.struct(*variables), "_clock").alias("_v"))
    return kept.select("airport", "hour_utc", *[F.col(f"_v.{v}").alias(v) for v in variables])


def merge_hourly(archive: DataFrame, forecast: DataFrame, only_forecast: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """Archive hours with the variables that only the forecast feed has; absent ones are NULL."""
    left = archive.drop(*only_forecast)
    extra = [v for v in only_forecast if v in forecast.columns]
    out = attach(left, forecast.select("airport", "hour_utc", *extra), ["airport", "hour_utc"])
    return out.withColumns({v: F.lit(None).cast("double") for v in wanted if v not in out.columns})


def hourly_visibility(reports: DataFrame) -> DataFrame:
    """Visibility of the earliest report of each airport and hour, keyed (``Origin``, ``_hour``).

    ``reports`` holds ``airport``, ``valid_utc`` and ``visibility_m``.
    """
    return (
        reports.filter(F.col("valid_utc").isNotNull())
        .groupBy(F.upper("airport").alias("Origin"), F.date_trunc("hour", "valid_utc").alias("_hour"))
        .agg(F.min_by(F.struct("visibility_m"), "valid_utc").alias("_v"))
        .select("Origin", "_hour", F.col("_v.visibility_m").alias("origin_dep_visibility_isd_m"))
    )


def report_visibility(fact: DataFrame, reports: DataFrame, at: str = "dep_utc") -> DataFrame:
    """Visibility from the earliest airport report in the hour of departure."""
    timed = fact.withColumn("_hour", F.date_trunc("hour", at))
    return attach(timed, hourly_visibility(reports), ["Origin", "_hour"]).drop("_hour")


def populated_rate(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.avg(F.col(col).isNotNull().cast("double")).alias("populated_rate"))


def aircraft_age(fact: DataFrame, registry: DataFrame) -> DataFrame:
    """Age in years from the build year, and its bucket."""
    years = F.year(DATE) - F.col("Year_Mfr")
    age = F.col("Aircraft_Age_Years")
    bucket = (
        F.when(age.isNull(), "Unknown").when(age <= 5, "0-5").when(age <= 10, "6-10").when(age <= 15, "11-15").otherwise("16+")
    )
    joined = attach(fact, registry.select("Tail_Number", F.col("Year_Mfr").cast("double")), ["Tail_Number"])
    return joined.withColumn("Aircraft_Age_Years", years.cast("double")).withColumn("Aircraft_Age_Bucket", bucket)


def aircraft_type(fact: DataFrame, master: DataFrame, models: DataFrame) -> DataFrame:
    """Maker and model through the registry: tail number, then model code."""
    codes = master.select(F.col("n_number").alias("_reg"), F.col("mfr_mdl_code").alias("_code"))
    named = models.select(F.col("code").alias("_code"), "mfr", "model")
    joined = attach(attach(fact.withColumn("_reg", registry_number("Tail_Number")), codes, ["_reg"]), named, ["_code"])
    blank = F.lit("")
    text = F.trim(F.concat_ws(" ", F.trim(F.coalesce("mfr", blank)), F.trim(F.coalesce("model", blank))))
    return joined.withColumn(
        "aircraft_type", F.when(text == "", F.lit("Unknown")).otherwise(text)
    ).drop("_reg", "_code", "mfr", "model")


def merge_features(left: DataFrame, right: DataFrame, wanted_keys: Sequence[str]) -> DataFrame:
    """Left join of the columns only ``right`` has, on those wanted keys both sides have.

    When the shared keys do not identify a right row, a left row matches several, as a merge would.
    """
    keys = [k for k in wanted_keys if k in left.columns and k in right.columns]
    new = [c for c in right.columns if c not in left.columns]
    return attach(left, right.select(*keys, *new), keys)


def leaders(df: DataFrame, keys: Sequence[str], tie: str, row: str) -> DataFrame:
    """For each row, the number (``_at``) of the row of its key that comes first by ``tie``; stored by ``row``.

    Rows with an unknown part of the key, and keys without any ``tie``, have none. ``df`` is stored by ``row``.
    """
    known = df.select(row, tie, *[k for k in keys if k != tie]).na.drop(subset=list(keys))
    rows = df.count()

    def made(table: DataFrame) -> DataFrame:
        # Of rows that share the tie, the one numbered last.
        order = F.when(F.col(tie).isNotNull(), F.struct(F.col(tie), (-F.col(row)).alias("_late")))
        first = table.groupBy(*keys).agg(F.min_by(row, order).alias("_at")).filter(F.col("_at").isNotNull())
        return table.select(row, *keys).join(first, list(keys)).select(row, "_at")

    return materialise_rows((made(p(known)) for p in cuts(keys, rows)), "leaders", row, rows)


def merge_first(left: DataFrame, right: DataFrame, first: DataFrame, row: str) -> DataFrame:
    """``left`` with the columns only ``right`` has, from the row that ``first`` (``leaders``) names for each row.

    Both have ``row``, under which they are stored. Nearly every row leads its key, and these rows are
    joined where they lie; only the others are dealt anew.
    """
    new = [c for c in right.columns if c not in left.columns]
    led = attach(left, first, [row])
    own = F.col("_at").isNull() | (F.col("_at") == F.col(row))
    named = right.select(F.col(row).alias("_right"), *new)

    def merged(rows: DataFrame, at: Column) -> DataFrame:
        return rows.join(named, (at == F.col("_right")) & F.col("_at").isNotNull(), "left").select(*left.columns, *new)

    return merged(led.filter(own), F.col(row)).unionByName(merged(led.filter(~own), F.col("_at")))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when the key identifies a row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def compare_versions(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key present in both tables, with the value of each; keys are reduced first."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.avg(value).alias(name))

    return side(a, "value_a").join(side(b, "value_b"), list(keys))


def diff_snapshots(
    a: DataFrame, b: DataFrame, keys: Sequence[str], numeric: Sequence[str], texts: Sequence[str] = ()
) -> DataFrame:
    """Long comparison of two feature tables: one row per key and feature.

    Numbers get ``delta`` (b minus a), texts get ``match``; both are NULL unless both sides are known.
    """
    cols = [*numeric, *texts]

    def packed(df: DataFrame, name: str) -> DataFrame:
        # One small struct per feature keeps the join to one row per key.
        return df.select(*keys, F.struct(*cols).alias(name))

    pair = packed(a, "_a").join(packed(b, "_b"), list(keys))
    cells = []
    for c in cols:
        is_text = c in texts
        left, right = F.col(f"_a.{c}"), F.col(f"_b.{c}")
        cells.append(
            F.struct(
                F.lit(c).alias("feature"),
                left.cast("string").alias("trained"),
                right.cast("string").alias("served"),
                (F.lit(None).cast("double") if is_text else (right - left).cast("double")).alias("delta"),
                ((left == right) if is_text else F.lit(None).cast("boolean")).alias("match"),
            )
        )
    return pair.select(*keys, F.inline(F.array(*cells)))


def override_families(
    a: DataFrame, b: DataFrame, keys: Sequence[str], families: Mapping[str, Sequence[str]]
) -> dict[str, DataFrame]:
    """Tables that take one family of columns from ``b`` and the rest from ``a``.

    ``none`` and ``all`` are added. One join serves every configuration.
    """
    pair = a.select(*keys, F.struct("*").alias("_a")).join(b.select(*keys, F.struct("*").alias("_b")), list(keys))
    plain = [c for c in a.columns if c not in keys]

    def pick(chosen: set[str]) -> DataFrame:
        return pair.select(
            *keys, *[F.col(f"{'_b' if c in chosen else '_a'}.{c}").alias(c) for c in plain]
        )

    every = {c for cols in families.values() for c in cols}
    return {"none": pick(set()), **{k: pick(set(v)) for k, v in families.items()}, "all": pick(every)}


def schedule_buffer(df: DataFrame) -> DataFrame:
    """Scheduled elapsed time minus the route's median actual elapsed time."""
    counts = df.filter(F.col("ActualElapsedTime").isNotNull()).groupBy(
        "Origin", "Dest", F.col("ActualElapsedTime").alias("_x")
    ).agg(F.count(F.lit(1)).alias("_n"))
    route = counts.groupBy("Origin", "Dest").agg(F.expr("percentile(_x, 0.5, _n)").alias("_median"))
    return attach(df, route, ["Origin", "Dest"]).withColumn(
        "schedule_buffer_min", F.col("CRSElapsedTime") - F.col("_median")
    ).drop("_median")

"""Operators that need the order of an aircraft's or a flight number's legs.

Legs are ordered and timed by instants, since a leg's two airports may lie in different zones; the
local clock only says which day a leg belongs to. A key's rows are cut into segments of time. A window
runs inside a segment, and what crosses from one segment to the next is carried by a small table with
one row per key and segment, so a placeholder tail number holds no more than a segment in one task.
Rows that lack a part of their key have no neighbours and no position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import num
from .joins import attach

DATE = "FlightDate"
CARRIER, FLIGHT_NUM = "Reporting_Airline", "Flight_Number_Reporting_Airline"
ORIGIN, DEST, TAIL = "Origin", "Dest", "Tail_Number"
DEP, ARR = "dep_utc", "arr_utc"
SEGMENT = "hour"
_SEG = "_segment"


def _keyed(keys: Sequence[str]) -> Column:
    held = F.lit(True)
    for k in keys:
        held = held & F.col(k).isNotNull()
    return held


def previous(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str],
    carry: dict[str, str],
    segment: str = SEGMENT,
) -> DataFrame:
    """Values of the previous row of the key; ``carry`` maps a new name to the column it repeats.

    Rows are ordered by ``time`` and then ``ties``, which should make the order total.
    """
    order = [time, *ties]
    packed = F.struct(*[F.col(c).alias(n) for n, c in carry.items()])
    cut = df.withColumn(_SEG, F.date_trunc(segment, time))
    ends = cut.filter(_keyed(keys)).groupBy(*keys, _SEG).agg(F.max_by(packed, F.struct(*order)).alias("_end"))
    carried = ends.select(
        *keys, _SEG, F.lag("_end").over(Window.partitionBy(*keys).orderBy(_SEG)).alias("_carried")
    )
    inside = Window.partitionBy(*keys, _SEG).orderBy(*order)
    placed = attach(cut.withColumn("_before", F.lag(packed).over(inside)), carried, [*keys, _SEG])
    prior = F.when(_keyed(keys), F.coalesce("_before", "_carried"))
    return placed.select(*df.columns, *[prior[n].alias(n) for n in carry])


def position(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str],
    out: str,
    segment: str = SEGMENT,
) -> DataFrame:
    """Number of the row within its key, from 1."""
    cut = df.withColumn(_SEG, F.date_trunc(segment, time))
    sizes = cut.filter(_keyed(keys)).groupBy(*keys, _SEG).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy(_SEG).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, _SEG, F.sum("_rows").over(earlier).alias("_offset"))
    inside = Window.partitionBy(*keys, _SEG).orderBy(time, *ties)
    joined = attach(cut.withColumn("_n", F.row_number().over(inside)), offsets, [*keys, _SEG])
    number = F.col("_n") + F.coalesce("_offset", F.lit(0))
    return joined.select(*df.columns, F.when(_keyed(keys), number).cast("bigint").alias(out))


def _where(df: DataFrame, held: Column, made: DataFrame) -> DataFrame:
    """Rows that have the operator's columns, plus the others with NULL there."""
    return made.unionByName(df.filter(~F.coalesce(held, F.lit(False))), allowMissingColumns=True)


def tail_leg_number(df: DataFrame, ties: Sequence[str], segment: str = SEGMENT) -> DataFrame:
    """Leg of the day per aircraft; NULL without a tail number or a departure time."""
    held = F.col(TAIL).isNotNull() & F.col("dep_dt_local").isNotNull() & F.col(DEP).isNotNull()
    keyed = df.filter(held).withColumn("_d", F.col("dep_dt_local").cast("date"))
    made = position(keyed, [TAIL, "_d"], DEP, ties, "tail_leg_num_day", segment)
    made = made.withColumn("tail_leg_num_day", F.col("tail_leg_num_day").cast("int"))
    return _where(df, held, made.drop("_d"))


def hours_since_first(df: DataFrame) -> DataFrame:
    """Hours since the flight number's first departure of the local day."""
    day = F.col("dep_dt_local").cast("date")
    first = (
        df.filter(F.col("dep_dt_local").isNotNull() & F.col(FLIGHT_NUM).isNotNull())
        .groupBy(CARRIER, FLIGHT_NUM, day.alias("_d"))
        .agg(F.min(DEP).alias("_first"))
    )
    joined = attach(df.withColumn("_d", day), first, [CARRIER, FLIGHT_NUM, "_d"])
    hours = _seconds(DEP, "_first") / 3600.0
    return joined.withColumn("flightnum_hours_since_first_departure_today", hours).drop("_d", "_first")


def _seconds(late: str, early: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(early), F.col(late)) / 1e6


def recent_arrival(
    df: DataFrame, ties: Sequence[str], hours: float = 5.0, segment: str = SEGMENT
) -> DataFrame:
    """1 when the aircraft's previous leg arrived at this airport within the last 5 hours."""
    held = F.col(TAIL).isNotNull() & F.col(DEP).isNotNull()
    made = previous(df.filter(held), [TAIL], DEP, ties, {"_arr": ARR, "_dest": DEST}, segment)
    gap = _seconds(DEP, "_arr") / 3600.0
    near = (F.col("_dest") == F.col(ORIGIN)) & gap.between(0.0, hours)
    name = "has_recent_arrival_turn_5h"
    made = made.withColumn(name, F.coalesce(near, F.lit(False)).cast("int")).drop("_arr", "_dest")
    return _where(df, held, made).withColumn(name, F.coalesce(name, F.lit(0)))


def turn_time(
    df: DataFrame,
    ties: Sequence[str],
    keys: Sequence[str] = (CARRIER, FLIGHT_NUM),
    segment: str = SEGMENT,
) -> DataFrame:
    """Hours since the key's previous arrival here, between 0 and 48; NULL when it was elsewhere."""
    held = F.col(DEP).isNotNull() & _keyed(keys)
    made = previous(df.filter(held), keys, DEP, ties, {"_arr": ARR, "_dest": DEST}, segment)
    hours = _seconds(DEP, "_arr") / 3600.0
    clipped = F.when(hours.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(48.0), hours)))
    made = made.withColumn("turn_time_hours", F.when(F.col("_dest") == F.col(ORIGIN), clipped))
    return _where(df, held, made.drop("_arr", "_dest"))


def tail_cascade(df: DataFrame, tight_hours: float = 0.75) -> DataFrame:
    """Legs of the aircraft's day, its shortest turn, and whether any turn is tight.

    A group-by and a join back rather than a window: the group-by combines before the shuffle.
    """
    day = (
        df.filter(F.col(TAIL).isNotNull() & F.col(DATE).isNotNull())
        .groupBy(TAIL, DATE)
        .agg(F.count(F.lit(1)).alias("tail_n_legs_scheduled"), F.min("turn_time_hours").alias("tail_min_turn_time"))
    )
    tight = F.coalesce(F.col("tail_min_turn_time") < tight_hours, F.lit(False)).cast("int")
    return attach(df, day, [TAIL, DATE]).withColumn("tail_has_tight_turn", tight)


def prior_leg(hist: DataFrame, ties: Sequence[str], segment: str = SEGMENT) -> DataFrame:
    """History with the delay of the same aircraft's previous leg that day, if it ended here."""
    kept = hist.filter(
        F.col(TAIL).isNotNull() & F.col(DATE).isNotNull() & F.col(DEP).isNotNull()
    )
    made = previous(
        kept, [TAIL, DATE], DEP, ties, {"_delay": "DepDelayMinutes", "_dest": DEST}, segment
    )
    linked = F.upper(F.col("_dest")) == F.upper(F.col(ORIGIN))
    return made.withColumn("prior_leg_depdelay", F.when(linked, F.col("_delay"))).drop("_delay", "_dest")


def prior_leg_stats(
    hist: DataFrame, ties: Sequence[str], windows: Sequence[int] = (7, 14), segment: str = SEGMENT
) -> DataFrame:
    """Rolling mean over observed days of the previous leg's delay, per flight number and origin."""
    return prior_leg_lags(prior_leg_sums(hist, ties, segment), windows)


def prior_leg_sums(hist: DataFrame, ties: Sequence[str], segment: str = SEGMENT) -> DataFrame:
    """Sum and number of the previous legs' known delays per flight number, origin and day.

    An aircraft's legs are needed together, so tables of different aircraft may be worked out in turn
    and put under one another.
    """
    from .daily import daily_agg

    made = prior_leg(hist, ties, segment)
    delay = num("prior_leg_depdelay")
    measures = {"_s": F.sum(delay), "_n": F.count(F.lit(1))}
    return daily_agg(made.filter(delay.isNotNull()), [CARRIER, FLIGHT_NUM, ORIGIN], measures)


def prior_leg_lags(sums: DataFrame, windows: Sequence[int] = (7, 14)) -> DataFrame:
    from .lags import row_lags

    keys = [CARRIER, FLIGHT_NUM, ORIGIN]
    daily = sums.groupBy(*keys, DATE).agg((F.sum("_s") / F.sum("_n")).alias("_v"))
    return row_lags(daily, keys, {"prior_leg_depdelay_mean": "_v"}, windows)


def first_leg(df: DataFrame) -> Column:
    """1 on the aircraft's first leg of the day, 0 on others, NULL if legs aren't numbered."""
    leg = F.col("tail_leg_num_day") if "tail_leg_num_day" in df.columns else F.lit(None).cast("int")
    return (leg == 1).cast("int")


def prior_leg_features(
    fact: DataFrame,
    hist: DataFrame,
    ties: Sequence[str],
    windows: Sequence[int] = (7, 14),
    segment: str = SEGMENT,
) -> DataFrame:
    """First-leg flag, and how late the inbound leg of this flight number usually is."""
    out = fact.withColumn("is_first_leg_of_day", first_leg(fact))
    stats = prior_leg_stats(hist, ties, windows, segment)
    return attach(out, stats, [CARRIER, FLIGHT_NUM, ORIGIN, DATE])


def previous_leg(
    df: DataFrame, time: str, ties: Sequence[str], flag: str, minutes: str, segment: str = SEGMENT
) -> DataFrame:
    """Delay flag and minutes of the aircraft's previous leg of the day."""
    return previous(df, [TAIL, DATE], time, ties, {"prev_delayed": flag, "prev_delay_min": minutes}, segment)


def cascade_daily(df: DataFrame, time: str, ties: Sequence[str], flag: str, minutes: str) -> DataFrame:
    """Aircraft-day rollup: legs, first leg delayed, delays, and whether a delay spread."""
    order = F.struct(time, *ties)
    day = df.groupBy(TAIL, DATE).agg(
        F.count(flag).alias("n_legs"),
        F.min_by(F.col(flag), F.when(F.col(flag).isNotNull(), order)).alias("first_delayed"),
        F.sum(flag).alias("total_delayed"),
        F.max(minutes).alias("max_delay_min"),
        F.avg(minutes).alias("mean_delay_min"),
    )
    spread = (F.coalesce("total_delayed", F.lit(0)) > 1).cast("int")
    return day.withColumns(
        {
            "any_delayed": (F.coalesce("total_delayed", F.lit(0)) > 0).cast("int"),
            "cascade": spread,
            "cascade_given_first": F.when(F.col("first_delayed") == 1, spread),
        }
    )


def tail_schedule(df: DataFrame) -> DataFrame:
    """Aircraft-day schedule: turn time, first and last departure, airports, distance."""
    return df.groupBy(TAIL, DATE).agg(
        F.avg("turn_time_hours").alias("mean_turn"),
        F.min("CRSDepTime").alias("min_sched_dep"),
        F.max("CRSDepTime").alias("max_sched_dep"),
        F.countDistinct(ORIGIN).alias("n_airports"),
        F.avg("Distance").alias("mean_distance"),
    )


def row_rolling(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str],
    value: Column,
    out: str,
    rows: int = 7,
    block: int = 100_000,
    segment: str = SEGMENT,
) -> DataFrame:
    """Mean of the value over the last ``rows`` rows of the key, the row itself included.

    Rows are numbered, cut into blocks of consecutive numbers, and the last few rows of a block are
    repeated at the head of the next one, so a window never holds more than a block.
    """
    placed = position(df.withColumn("_v", value), keys, time, ties, "_at", segment)
    number = F.floor((F.col("_at") - 1) / block)
    tail = (F.col("_at") - 1) % block >= block - (rows - 1)
    copies = F.array_compact(
        F.array(
            F.struct(number.alias("_block"), F.lit(True).alias("_own")),
            F.when(tail, F.struct((number + 1).alias("_block"), F.lit(False).alias("_own"))),
        )
    )
    frame = Window.partitionBy(*keys, "_block").orderBy("_at").rowsBetween(-(rows - 1), 0)
    mean = F.when(F.col("_at").isNotNull(), F.avg("_v").over(frame))
    spread = placed.select("*", F.inline(copies)).withColumn(out, mean)
    return spread.filter("_own").select(*df.columns, out)

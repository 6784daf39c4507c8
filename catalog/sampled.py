"""Samples, splits and set operations; the hash is the same in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import sampling, sets

from . import bindings as b
from .registry import plain, query

ID = ["row_id"]
DAY = "CAST(FlightDate AS VARCHAR) AS FlightDate"


def ranked(seed: int, by: str = "", source: str = "ord") -> str:
    """Rows with their position by hash within a class."""
    part = f"PARTITION BY {by} " if by else ""
    return f"SELECT *, row_number() OVER ({part}ORDER BY md5(row_id || ':{seed}')) AS pos FROM {source}"


@query(
    "exact_sample",
    "L10",
    b.sql("ord", f"SELECT row_id, {DAY} FROM r WHERE pos <= 777", r=ranked(42)),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(sampling.take_exact(b.orders(spark, sf), 777, ID, 42).select("row_id", "FlightDate"))


_SIZES = "SELECT sum(y) AS np, count(*) - sum(y) AS nn FROM ord"


def _round_even(x: str) -> str:
    return f"round_even({x}, 0)"


@query(
    "balanced_set",
    "L01 U01",
    b.sql(
        "ord",
        f"SELECT row_id, y FROM r, s WHERE (y = 1 AND pos <= CASE WHEN {_round_even('np * (0.6 / 0.4)')} <= nn THEN np ELSE least({_round_even('nn * (0.4 / 0.6)')}, np) END) "
        f"OR (y = 0 AND pos <= least({_round_even('np * (0.6 / 0.4)')}, nn))",
        r=ranked(42, "y"),
        s=_SIZES,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.balance(b.orders(spark, sf), "y", 0.4, ID).select("row_id", "y")


@query(
    "balanced_set_capped",
    "L01",
    b.sql(
        "ord",
        "SELECT row_id, y FROM (SELECT *, row_number() OVER (ORDER BY md5(row_id || ':43')) AS p2 FROM k) WHERE p2 <= 1000",
        r=ranked(42, "y"),
        s=_SIZES,
        k=f"SELECT row_id, y FROM r, s WHERE (y = 1 AND pos <= least({_round_even('nn * (0.9 / (1 - 0.9))')}, np)) OR (y = 0 AND pos <= CASE WHEN {_round_even('np * ((1 - 0.9) / 0.9)')} <= nn THEN {_round_even('np * ((1 - 0.9) / 0.9)')} ELSE nn END)",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.balance(b.orders(spark, sf), "y", 0.9, ID, max_rows=1000).select("row_id", "y")


@query(
    "last_days_holdout",
    "L02",
    b.sql("ord", f"SELECT row_id, {DAY} FROM ord WHERE FlightDate > (SELECT max(FlightDate) FROM ord) - 90"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(sampling.split_last_days(b.orders(spark, sf), 90)[1].select("row_id", "FlightDate"))


@query(
    "last_days_training",
    "L02 U03 L09",
    b.sql("ord", f"SELECT row_id, {DAY} FROM ord WHERE FlightDate < (SELECT max(FlightDate) FROM ord) - 90"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(sampling.split_last_days(b.orders(spark, sf), 90, inclusive=True)[0].select("row_id", "FlightDate"))


@query(
    "random_holdout",
    "L03",
    b.sql("ord", f"SELECT row_id, pos <= (SELECT {_round_even('count(*) * 0.15')} FROM ord) AS is_eval FROM r", r=ranked(42)),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_random(b.orders(spark, sf), 0.15, ID).select("row_id", "is_eval")


@query(
    "latest_holdout",
    "L04",
    b.sql(
        "ord",
        "SELECT row_id, pos <= floor((SELECT count(*) FROM ord) * 0.1503) AS is_eval FROM (SELECT *, row_number() OVER (ORDER BY FlightDate DESC, md5(row_id || ':42')) AS pos FROM ord)",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_latest(b.orders(spark, sf), 0.1503, ID).select("row_id", "is_eval")


@query(
    "presample",
    "L05",
    b.sql(
        "ord",
        "SELECT row_id, y FROM r, s WHERE y = 1 OR pos <= least(floor(np * (1 - 0.7) / 0.7 / (1 - 0.15) * 1.2), nn)",
        r=ranked(42, "y"),
        s=_SIZES,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.presample(b.orders(spark, sf), "y", 0.7, 0.15, ID).select("row_id", "y")


@query(
    "rebalanced_set",
    "L06 L02 L01",
    b.sql(
        "",
        f"SELECT row_id, y FROM r, s WHERE (y = 1 AND pos <= CASE WHEN {_round_even('np * (0.7 / 0.3)')} <= nn THEN np ELSE least({_round_even('nn * (0.3 / 0.7)')}, np) END) "
        f"OR (y = 0 AND pos <= least({_round_even('np * (0.7 / 0.3)')}, nn))",
        ord0=b.ORDERS,
        ord="SELECT * FROM ord0 WHERE FlightDate <= (SELECT max(FlightDate) FROM ord0) - 200",
        r=ranked(42, "y"),
        s=_SIZES,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.rebalance(b.orders(spark, sf), "y", 0.3, ID, eval_days=200)[0].select("row_id", "y")


@query(
    "stratified_split",
    "L07",
    b.sql(
        "ord",
        f"SELECT row_id, y, CASE WHEN pos <= {_round_even('n * 0.6')} THEN 'train' WHEN pos <= {_round_even('n * 0.8')} THEN 'stop' ELSE 'test' END AS split FROM r JOIN (SELECT y, count(*) AS n FROM ord GROUP BY y) USING (y)",
        r=ranked(7, "y"),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_split(b.orders(spark, sf), "y", [0.6, 0.2, 0.2], ["train", "stop", "test"], ID, 7).select("row_id", "y", "split")


@query(
    "capped_rows",
    "L08",
    b.sql(
        "ord",
        f"SELECT row_id, y FROM r, k WHERE (y = 1 AND pos <= kp) OR (y = 0 AND pos <= greatest(1, least(2000 - kp, nn)))",
        r=ranked(42, "y"),
        s=_SIZES,
        k=f"SELECT nn, greatest(1, least({_round_even('2000 * (np / (np + nn))')}, np)) AS kp FROM s",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.cap_rows(b.orders(spark, sf), "y", 2000, ID).select("row_id", "y")


@query(
    "date_split",
    "L09",
    b.sql(
        "ord",
        "SELECT row_id, is_train FROM ord JOIN d USING (FlightDate)",
        d="SELECT FlightDate, row_number() OVER (ORDER BY FlightDate) <= floor(count(*) OVER () * 0.8) AS is_train FROM (SELECT DISTINCT FlightDate FROM ord)",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_dates(b.orders(spark, sf)).select("row_id", "is_train")


@query(
    "sampled_dates",
    "L10",
    b.sql(
        "ord",
        "SELECT row_id, CAST(FlightDate AS VARCHAR) AS FlightDate FROM ord WHERE FlightDate IN (SELECT FlightDate FROM (SELECT DISTINCT FlightDate FROM ord) ORDER BY md5(CAST(FlightDate AS VARCHAR) || ':42') LIMIT 50)",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(sampling.sample_dates(b.orders(spark, sf), 50).select("row_id", "FlightDate"))


@query(
    "top_pairs",
    "L11",
    b.sql("ord", "SELECT priority, cust, count(*) AS n FROM ord GROUP BY ALL ORDER BY n DESC, priority, cust LIMIT 20"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    counts = b.orders(spark, sf).groupBy("priority", "cust").agg(F.count(F.lit(1)).alias("n"))
    return sampling.top_k(counts, [F.desc("n"), F.col("priority"), F.col("cust")], 20)


@query(
    "first_rows",
    "L12",
    b.sql("ord", f"SELECT row_id, {DAY}, cust, priority FROM ord QUALIFY row_number() OVER (PARTITION BY cust, priority ORDER BY FlightDate, row_id) = 1"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    o = b.orders(spark, sf).select("row_id", "FlightDate", "cust", "priority")
    return plain(sampling.keep_first(o, ["cust", "priority"], ["FlightDate", "row_id"]))


@query(
    "parts_together",
    "U01",
    "SELECT 'c' AS kind, c_custkey AS k, c_acctbal AS bal, CAST(NULL AS VARCHAR) AS name FROM customer UNION ALL SELECT 's', s_suppkey, NULL, s_name FROM supplier",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    c = b.table(spark, sf, "customer").select(F.lit("c").alias("kind"), F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"))
    s = b.table(spark, sf, "supplier").select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return sets.concat([c, s])


@query("endpoint_airports", "U02", b.sql("flights", "SELECT Origin AS IATA FROM flights UNION SELECT Dest FROM flights"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sets.endpoints(b.flights(spark, sf))


@query(
    "complement_rows",
    "U03",
    b.sql("ord", "SELECT row_id, cust FROM ord WHERE row_id NOT IN (SELECT row_id FROM ord WHERE price > 200000)"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    o = b.orders(spark, sf)
    return sets.complement(o, o.filter("price > 200000"), ID).select("row_id", "cust")


@query(
    "column_differences",
    "U04",
    "SELECT 'missing' AS kind, 'no_such' AS name, count(*) AS n_rows FROM orders UNION ALL SELECT 'forbidden', 'o_orderstatus', count(*) FROM orders",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    o = b.table(spark, sf, "orders")
    report = sets.column_report(o, ["o_orderkey", "no_such"], ["o_orderstatus", "absent"])
    cells = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("name")) for k, names in report.items() for n in names])
    return o.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(cells), "n_rows")


@query(
    "shared_members",
    "U05",
    b.sql("flights", "SELECT Tail_Number, count(DISTINCT Dest) AS n_groups FROM flights GROUP BY ALL HAVING count(DISTINCT Dest) >= 5"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sets.shared_by_all(b.flights(spark, sf), "Tail_Number", "Dest", 5)

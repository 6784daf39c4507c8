"""Exact samples and splits that do not depend on partitioning.

Rows are ordered by a hash of their id. The n first rows of a class are those up to one cut value,
which is found by counting hash prefixes (at most 65,536 counts per class) and then counting the
hashes of the prefix in which the cut falls. Taking the sample is then a comparison with that value:
no sort, no shuffle of the rows, and the complement is the same comparison negated. The cuts (one row
a class) are sent to the rows: a join by class would put all rows of a class into one task. Where rows share
an id, as many of those at the cut are taken as are missing, in the order of a hash of all columns;
only these rows are numbered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DATE = "FlightDate"
_H, _P, _K = "_hash", "_prefix", "_class"


def row_hash(ids: Sequence[str], seed: int) -> Column:
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in ids], F.lit(str(seed)))
    return F.md5(text)


def _hashed(df: DataFrame, cls: Column, ids: Sequence[str], seed: int) -> DataFrame:
    return df.withColumns({_K: cls, _H: row_hash(ids, seed)})


def class_sizes(df: DataFrame, cls: Column) -> DataFrame:
    return df.groupBy(cls.alias(_K)).agg(F.count(F.lit(1)).alias("_size"))


def cut_values(
    df: DataFrame, cls: Column, ids: Sequence[str], seed: int, takes: DataFrame, names: Sequence[str]
) -> DataFrame:
    """Per class and name, the hash of the row at that position and how many rows of this hash are in.

    ``takes`` holds ``_class`` and one count per name. A count of 0 gives NULL, and a count of at
    least the class size the last hash.
    """
    hashed = _hashed(df, cls, ids, seed).select(_K, _H, F.substring(_H, 1, 4).alias(_P))
    earlier = Window.partitionBy(_K).orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    counts = hashed.groupBy(_K, _P).agg(F.count(F.lit(1)).alias("_n"))
    placed = counts.select(
        _K,
        _P,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + F.col("_n")).alias("_upto"),
        F.sum("_n").over(Window.partitionBy(_K)).alias("_size"),
    )
    wanted = F.array(*[F.struct(F.lit(n).alias("_cut"), F.col(n).cast("bigint").alias("_take")) for n in names])
    edges = (
        placed.join(takes.select(_K, F.inline(wanted)), [_K])
        .withColumn("_take", F.least("_take", "_size"))
        .filter((F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_upto")))
        .select(_K, _P, "_cut", (F.col("_take") - F.col("_before")).alias("_rank"))
    )
    upto = F.sum("_copies").over(Window.partitionBy(_K, _P).orderBy(_H))
    tallied = (
        hashed.join(F.broadcast(edges.select(_K, _P).distinct()), [_K, _P], "left_semi")
        .groupBy(_K, _P, _H)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_last", upto)
    )
    before = F.col("_last") - F.col("_copies")
    found = tallied.join(edges, [_K, _P]).filter((before < F.col("_rank")) & (F.col("_rank") <= F.col("_last")))
    cut = F.struct(F.col(_H).alias("hash"), (F.col("_rank") - before).alias("need"))
    return found.groupBy(_K).agg(*[F.max(F.when(F.col("_cut") == n, cut)).alias(n) for n in names])


def _within(
    df: DataFrame, cls: Column, ids: Sequence[str], seed: int, takes: DataFrame, names: Sequence[str]
) -> DataFrame:
    """``df`` with one boolean per name: whether the row is among the first so many of its class."""
    cuts = cut_values(df, cls, ids, seed, takes, names)
    joined = _hashed(df, cls, ids, seed).join(F.broadcast(cuts), [_K], "left")
    at_cut = F.lit(False)
    for n in names:
        at_cut = at_cut | F.coalesce(F.col(_H) == F.col(n)["hash"], F.lit(False))
    copies = Window.partitionBy(_K, _H).orderBy(F.xxhash64(*df.columns))
    numbered = joined.filter(at_cut).withColumn("_copy", F.row_number().over(copies))
    rows = numbered.unionByName(joined.filter(~at_cut).withColumn("_copy", F.lit(0)))
    held = {
        n: F.coalesce(
            (F.col(_H) < F.col(n)["hash"]) | ((F.col(_H) == F.col(n)["hash"]) & (F.col("_copy") <= F.col(n)["need"])),
            F.lit(False),
        )
        for n in names
    }
    return rows.select(*df.columns, *[h.alias(n) for n, h in held.items()])


def _flagged(df: DataFrame, cls: Column, ids: Sequence[str], seed: int, takes: DataFrame, out: str) -> DataFrame:
    """Adds whether the row is among its class's first ``_take`` rows."""
    return _within(df, cls, ids, seed, takes, ["_take"]).withColumnRenamed("_take", out)


def take_exact(df: DataFrame, n: Column | int, ids: Sequence[str], seed: int) -> DataFrame:
    """Exactly n rows (all, when there are fewer); n may use ``_size``, the number of rows."""
    return flag_exact(df, n, ids, seed, "_in").filter("_in").drop("_in")


def flag_exact(df: DataFrame, n: Column | int, ids: Sequence[str], seed: int, out: str) -> DataFrame:
    one = F.lit(0)
    count = F.lit(n) if isinstance(n, int) else n
    return _flagged(df, one, ids, seed, class_sizes(df, one).withColumn("_take", count), out)


def _two_classes(df: DataFrame, label: str) -> DataFrame:
    """One row with the number of positives and negatives."""
    y = F.col(label).cast("int")
    return df.agg(
        F.sum((y == 1).cast("bigint")).alias("_pos"), F.sum((y == 0).cast("bigint")).alias("_neg")
    )


def _takes(sizes: DataFrame, pos: Column, neg: Column) -> DataFrame:
    return sizes.select(
        F.inline(
            F.array(
                F.struct(F.lit(1).alias(_K), pos.cast("bigint").alias("_take")),
                F.struct(F.lit(0).alias(_K), neg.cast("bigint").alias("_take")),
            )
        )
    )


def balance(
    df: DataFrame, label: str, pos_frac: float, ids: Sequence[str], seed: int = 42, max_rows: int | None = None
) -> DataFrame:
    """Rows with a target share of positives: all of the limiting class, a sample of the other.

    With one class empty the input comes back unchanged. The result has no order; ``max_rows`` caps
    it by a further exact sample.
    """
    if not 0.0 < pos_frac < 1.0:
        raise ValueError("pos_frac must be in (0, 1)")
    pos, neg = F.col("_pos"), F.col("_neg")
    want_neg = F.bround(pos * ((1 - pos_frac) / pos_frac))
    want_pos = F.least(F.bround(neg * (pos_frac / (1 - pos_frac))), pos)
    by_pos = want_neg <= neg
    empty = (pos == 0) | (neg == 0)
    takes = _takes(
        _two_classes(df, label),
        F.when(empty | by_pos, pos).otherwise(want_pos),
        F.when(~empty & by_pos, want_neg).otherwise(neg),
    )
    picked = _flagged(df, F.col(label).cast("int"), ids, seed, takes, "_in").filter("_in").drop("_in")
    return picked if max_rows is None else take_exact(picked, max_rows, ids, seed + 1)


def presample(
    df: DataFrame, label: str, pos_frac: float, eval_frac: float, ids: Sequence[str], seed: int = 42
) -> DataFrame:
    """All positives and enough negatives to balance later, with a fifth to spare."""
    want = F.floor(F.col("_pos") * (1 - pos_frac) / pos_frac / (1 - eval_frac) * 1.2)
    takes = _takes(_two_classes(df, label), F.col("_pos"), F.least(want, F.col("_neg")))
    return _flagged(df, F.col(label).cast("int"), ids, seed, takes, "_in").filter("_in").drop("_in")


def cap_rows(df: DataFrame, label: str, max_rows: int, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """At most ``max_rows`` rows with the class shares kept, and at least one row of each class."""
    pos, neg = F.col("_pos"), F.col("_neg")
    size = pos + neg
    keep_pos = F.greatest(F.lit(1), F.least(F.bround(F.lit(float(max_rows)) * (pos / size)), pos))
    keep_neg = F.greatest(F.lit(1), F.least(max_rows - keep_pos, neg))
    small = size <= max_rows
    takes = _takes(
        _two_classes(df, label), F.when(small, pos).otherwise(keep_pos), F.when(small, neg).otherwise(keep_neg)
    )
    return _flagged(df, F.col(label).cast("int"), ids, seed, takes, "_in").filter("_in").drop("_in")


def split_last_days(
    df: DataFrame, days: int, date: str = DATE, inclusive: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rest, last days): days after the newest day minus N, or from it on when inclusive."""
    cut = df.agg(F.date_sub(F.max(date), days)).scalar()
    late = (F.col(date) >= cut) if inclusive else (F.col(date) > cut)
    return df.filter(~late), df.filter(late)


def split_random(df: DataFrame, frac: float, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """Adds ``is_eval`` for exactly the given share of rows."""
    return flag_exact(df, F.bround(F.col("_size") * frac), ids, seed, "is_eval")


def split_latest(df: DataFrame, frac: float, ids: Sequence[str], date: str = DATE, seed: int = 42) -> DataFrame:
    """Adds ``is_eval`` for exactly the given share of rows at the end of the date order.

    Whole days go to one side; the day in which the share ends is cut by hash.
    """
    later = Window.partitionBy(F.lit(0)).orderBy(F.col(date).desc()).rowsBetween(Window.unboundedPreceding, -1)
    per_day = df.groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    placed = per_day.select(
        date,
        "_n",
        F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("_after"),
        F.floor(F.sum("_n").over(Window.partitionBy(F.lit(0))) * frac).alias("_take"),
    )
    need = F.least(F.greatest(F.col("_take") - F.col("_after"), F.lit(0)), F.col("_n"))
    placed = placed.select(date, need.alias("_need"), (need == F.col("_n")).alias("_whole"))
    edge = placed.filter((F.col("_need") > 0) & ~F.col("_whole"))
    at_edge = df.join(edge.select(date), [date], "left_semi")
    takes = edge.select(F.col(date).alias(_K), F.col("_need").alias("_take"))
    cut = _flagged(at_edge, F.col(date), ids, seed, takes, "is_eval")
    whole = df.join(edge.select(date), [date], "left_anti").join(placed.select(date, "_whole"), [date], "left")
    held = F.coalesce("_whole", F.lit(False)).alias("is_eval")
    return cut.unionByName(whole.select(*df.columns, held))


def stratified_split(
    df: DataFrame, label: str, shares: Sequence[float], names: Sequence[str], ids: Sequence[str], seed: int = 42
) -> DataFrame:
    """Adds ``split``: each class is cut at the same shares; the last name takes what is left."""
    cls = F.col(label).cast("int")
    cuts, upto = [], 0.0
    for i, share in enumerate(shares[:-1]):
        upto += share
        cuts.append((f"_cut{i}", F.bround(F.col("_size") * upto)))
    takes = class_sizes(df, cls).withColumns(dict(cuts))
    placed = _within(df, cls, ids, seed, takes, [n for n, _ in cuts])
    part = F.lit(names[-1])
    for (cut, _), name in reversed(list(zip(cuts, names))):
        part = F.when(F.col(cut), F.lit(name)).otherwise(part)
    return placed.select(*df.columns, part.alias("split"))


def split_dates(df: DataFrame, frac: float = 0.8, date: str = DATE) -> DataFrame:
    """Adds ``is_train`` for the rows on the first share of distinct dates."""
    days = df.select(date).filter(F.col(date).isNotNull()).distinct()
    everything = Window.partitionBy(F.lit(0))
    ordered = days.select(
        date,
        (F.row_number().over(everything.orderBy(date)) <= F.floor(F.count(F.lit(1)).over(everything) * frac)).alias(
            "is_train"
        ),
    )
    return df.join(ordered, [date], "left")


def sample_dates(df: DataFrame, n: int, seed: int = 42, date: str = DATE) -> DataFrame:
    """Every row of n whole dates, so that sequences within a day stay complete."""
    days = take_exact(df.select(date).distinct(), n, [date], seed)
    return df.join(days, [date], "left_semi")


def top_k(df: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*by).limit(k)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key; combines before the shuffle, so a hot key costs nothing extra."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def rebalance(
    stored: DataFrame,
    label: str,
    pos_frac: float,
    ids: Sequence[str],
    eval_days: int | None = None,
    eval_frac: float | None = None,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(balanced training rows, untouched holdout) from a stored feature table."""
    if eval_days is not None:
        pool, held = split_last_days(stored, eval_days)
    else:
        marked = split_random(stored, eval_frac or 0.15, ids, seed)
        pool, held = marked.filter("not is_eval").drop("is_eval"), marked.filter("is_eval").drop("is_eval")
    return balance(pool, label, pos_frac, ids, seed), held

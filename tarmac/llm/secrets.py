"""Secrets in texts, with the corpus telling copied examples from the credentials of one owner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as sp
from .common import let, materialise

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

# The kinds of spans in their order: three that are always reported, then those that the corpus decides.
BASE = ["assign", "access", "hex"]
EXTRA = {
    "private_key": r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----",
    "forge_token": r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}",
    "chat_token": r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{20,}",
    "web_token": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+",
    "bearer": r"(?<![A-Za-z])(?i:bearer)\x20{1,4}[A-Za-z0-9._~+/=-]{24,}",
    "url_login": r"(?<![a-z])[a-z]{3,12}://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._~+=!-]{6,128}@",
}
KINDS = [*BASE, *EXTRA]


def find_secrets(text: Column) -> Column:
    """All candidate spans of a text, sorted by start and kind."""
    long_enough = lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= 6
    found = [
        sp.matches(text, ASSIGN, 0, long_enough),
        # A run of the class is taken whole, so a least length finds what a filter on runs would keep.
        sp.matches(text, "AKIA[A-Z0-9]{16,}", 1),
        sp.matches(text, "[0-9a-f]{24,}", 2),
    ]
    found += [sp.matches(text, p, len(BASE) + k) for k, p in enumerate(EXTRA.values())]
    return F.sort_array(F.concat(*found))


def secret_value(kind: Column, value: Column) -> Column:
    """The secret itself, without the name that it is assigned to."""
    bare = F.when(kind == 0, F.regexp_extract(value, ASSIGN, 2))
    bare = bare.when(kind == KINDS.index("bearer"), F.regexp_extract(value, r"\x20+(.*)$", 1))
    return bare.otherwise(value)


def varied(value: Column) -> Column:
    """The number of different characters, a cheap stand-in for entropy."""
    return F.size(F.array_distinct(F.split(value, "")))


def ownership(found: DataFrame, repository: str, owner: str) -> DataFrame:
    """(secret, repositories, owners): in how many distinct ones a hashed value occurs.

    Every value is reduced to its distinct owners, and to its distinct repositories, on both columns
    before it is counted, so a value that a third of all rows hold is spread over all tasks.
    """
    by_owner = found.select("secret", F.col(owner).alias("who")).distinct().groupBy("secret").agg(F.count("who").alias("owners"))
    by_repository = found.select("secret", F.col(repository).alias("place")).distinct().groupBy("secret").agg(F.count("place").alias("repositories"))
    return by_owner.join(by_repository, "secret")


def scan(
    docs: DataFrame,
    repository: Column,
    owner: Column,
    copied_owners: int = 5,
    copied_repositories: int = 3,
    least_varied: int = 8,
) -> DataFrame:
    """One row for every row of ``docs``: doc_id, secrets (sorted spans of base kinds and of those
    further kinds that look live) with ``live`` for each.

    A value is copied when at least ``copied_owners`` owners and ``copied_repositories`` repositories
    hold it; it looks live when it isn't copied and has ``least_varied`` different characters. Base
    spans are always kept, whether live or not.

    Null and empty texts have no spans. Repeated rows are reported one by one; their value counts once
    for each owner. Null owners or repositories aren't counted. Only ``doc_id``, ``text`` and the two
    columns are used, so other columns of any name do no harm. An empty table gives an empty one.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), repository.alias("repository"), owner.alias("owner"), find_secrets(text).alias("spans"))
    found = materialise(found, "secrets")
    each = found.select("row", "repository", "owner", F.explode("spans").alias("span"))
    each = each.withColumn("secret", F.xxhash64(secret_value(F.col("span.kind"), F.col("span.value"))))
    known = ownership(each, "repository", "owner")
    copied = (F.col("owners") >= copied_owners) & (F.col("repositories") >= copied_repositories)
    judged = each.join(known.select("secret", copied.alias("copied")), "secret")
    live = ~F.col("copied") & (varied(secret_value(F.col("span.kind"), F.col("span.value"))) >= least_varied)
    judged = judged.select("row", "span", live.alias("live")).where((F.col("span.kind") < len(BASE)) | F.col("live"))
    one = F.struct("span.start", "span.kind", "span.end", "live").alias("one")
    by_row = judged.select("row", one).groupBy("row").agg(F.sort_array(F.collect_list("one")).alias("secrets"))
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint,live:boolean>>)")
    return found.select("doc_id", "row").join(by_row, "row", "left").select("doc_id", F.coalesce("secrets", none).alias("secrets"))


def digest(scanned: DataFrame) -> DataFrame:
    """The counts, positions and hash of the spans of each row."""
    base = F.filter("secrets", lambda s: s["kind"] < len(BASE))
    counts = [sp.count(F.col("secrets"), k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    return scanned.select(
        "doc_id",
        *counts,
        let(base, lambda b: F.sha2(sp.joined(b, KINDS), 256)).alias("base_sha256"),
        sp.joined(F.col("secrets"), KINDS).alias("spans"),
        F.size(F.filter("secrets", lambda s: s["live"])).cast("long").alias("n_live"),
    )

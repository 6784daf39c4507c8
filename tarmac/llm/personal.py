"""Personal data by weak supervision: labelers vote, reliabilities are estimated, a classifier decides.

Candidates come from patterns. Six labelers (pattern, checksum, gazetteers, contexts) vote on each.
Expectation-maximisation over the counts of vote patterns, at most 3**6 rows, estimates how reliable
each labeler is; a logistic regression over counted feature patterns, weighted by the estimated
probabilities, is the final judge of spans. All of it runs in built-in expressions and aggregates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as sp
from .common import free_name, let, materialise

# The kinds of spans in their order: four that are always reported, then those that are judged.
BASE = ["email", "ip", "card", "phone"]
EXTRA = {
    "local_phone": r"(?<![0-9A-Za-z+.-])(?<!\+[0-9]{1,3}[\x20().-]{1,2})\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
    "national_id": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z.-])",
    "account": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "spelled_email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,40}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{2,40}(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]{2,20}){1,3}",
}
KINDS = [*BASE, *EXTRA]

# A match can only begin where a run of its first class begins or the last match ended, since all
# later starts in a run meet the same end of the run. This keeps long runs linear.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Fixed word lists of the labelers.
CONTEXT = {
    "email": "mail email e-mail contact write reply courriel correo kontakt",
    "ip": "ip host server address addr login client adresse",
    "card": "card visa credit debit payment paid karte carte tarjeta",
    "phone": "phone tel call mobile fax cell telefon téléphone teléfono",
    "local_phone": "phone tel call mobile fax cell telefon téléphone teléfono",
    "national_id": "ssn social security id taxpayer",
    "account": "iban account bank konto compte cuenta",
    "spelled_email": "mail email e-mail contact write reply courriel correo kontakt",
}
AGAINST = "version isbn issn order invoice example sample test release doi part serial"
DOMAINS = "com org net edu gov io de fr es uk info biz eu us co"
RESERVED = r"(?i)example\.|test\.|localhost|^127\.|^0\.|^255\.|^10\.|^192\.168\.|555-?01|^(.)\1{4,}"
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91"
LABELERS = ["shape", "checksum", "listed", "reserved", "context", "against"]
CONTEXT_CHARS = 40


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check of payment cards."""

    def total(r):
        twice = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        digit = lambda i: F.substring(r, i, F.lit(1)).cast("int")
        return F.aggregate(F.sequence(F.lit(1), F.length(r)), F.lit(0), lambda acc, i: acc + F.when(i % 2 == 0, twice(digit(i))).otherwise(digit(i)))

    return (F.length(number) > 0) & (let(F.reverse(number), total) % 10 == 0)


def _card(value: Column) -> Column:
    return let(digits(value), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))


def _ip(value: Column) -> Column:
    small = lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3
    return F.forall(F.split(value, r"\."), lambda p: F.when(small(p), F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255).otherwise(False))


def find_candidates(text: Column) -> Column:
    """All candidate spans of a text, sorted by start and kind."""
    found = [
        sp.matches(text, EMAIL, 0),
        sp.matches(text, IP, 1, _ip),
        sp.matches(text, CARD, 2, _card),
        sp.matches(text, PHONE, 3, lambda v: F.length(digits(v)).between(9, 15)),
    ]
    found += [sp.matches(text, p, len(BASE) + k) for k, p in enumerate(EXTRA.values())]
    return F.sort_array(F.concat(*found))


def _any_word(words: str) -> str:
    return r"(?i)(?<![\p{L}])(?:" + "|".join(words.split()) + r")(?![\p{L}])"


def votes(kind: Column, value: Column, left: Column) -> Column:
    """1, 0 (no opinion) or -1 of each labeler for one span."""
    name = F.get(F.array(*[F.lit(k) for k in KINDS]), kind)
    number = digits(value)
    domain = r"(?i)\.(?:" + "|".join(DOMAINS.split()) + r")$"
    calling = r"^\+(?:" + "|".join(sorted(CALLING.split(), key=len, reverse=True)) + ")"
    shape = F.when(name.isin("email", "spelled_email"), value.rlike(r"[A-Za-z]{2,}[\])]?$") & ~value.rlike(r"\.\.|^\."))
    shape = shape.when(name == "ip", ~value.rlike(r"(?:^|\.)0[0-9]"))
    shape = shape.when(name == "card", value.rlike(r"^[3-6]"))
    shape = shape.when(name.isin("phone", "local_phone"), ~value.rlike(r"[ ().-]{3,}"))
    shape = shape.otherwise(~number.rlike(r"^(.)\1+$"))
    checksum = F.when(name == "card", F.when(luhn(number), 1).otherwise(-1)).when(name == "national_id", F.when(value.rlike("^(?:000|666|9)|-00-|-0000$"), -1).otherwise(1))
    listed = F.when(name.isin("email") & value.rlike(domain), 1).when((name == "phone") & value.rlike(calling), 1)
    about = reduce(lambda a, b: a.when(name == b[0], left.rlike(_any_word(b[1]))), CONTEXT.items(), F.when(F.lit(False), False))
    return F.array(
        F.when(shape, 1).otherwise(-1),
        checksum.otherwise(0),
        listed.otherwise(0),
        F.when(value.rlike(RESERVED), -1).otherwise(0),
        F.when(about, 1).otherwise(0),
        F.when(left.rlike(_any_word(AGAINST)), -1).otherwise(0),
    )


@dataclass(frozen=True)
class Reliability:
    """The share of true spans, and for each labeler how likely each vote is if true and if not."""

    prior: float
    if_true: list[dict[int, float]]
    if_false: list[dict[int, float]]

    def posterior(self, pattern: list[int]) -> float:
        a, b = math.log(self.prior), math.log(1 - self.prior)
        for k, v in enumerate(pattern):
            a, b = a + math.log(self.if_true[k][v]), b + math.log(self.if_false[k][v])
        return 1 / (1 + math.exp(min(700.0, b - a)))


def estimate(patterns: list[tuple[list[int], int]], rounds: int = 50) -> Reliability:
    """Expectation-maximisation over (vote pattern, count); starts from the majority of votes.

    Estimates are smoothed by one row for each vote, so no vote is impossible; without patterns every
    vote is as likely either way.
    """
    belief = [0.9 if sum(p) > 0 else 0.5 if sum(p) == 0 else 0.1 for p, _ in patterns]
    n = len(LABELERS)
    model = Reliability(0.5, [dict.fromkeys((-1, 0, 1), 1 / 3)] * n, [dict.fromkeys((-1, 0, 1), 1 / 3)] * n)
    for _ in range(rounds):
        total = sum(c for _, c in patterns)
        weight = sum(b * c for b, (_, c) in zip(belief, patterns, strict=True))
        likely: list[list[dict[int, float]]] = [[], []]
        for k in range(n):
            for side in (0, 1):
                held = {v: 1.0 for v in (-1, 0, 1)}
                for b, (p, c) in zip(belief, patterns, strict=True):
                    held[p[k]] += c * (b if side == 0 else 1 - b)
                whole = sum(held.values())
                likely[side].append({v: x / whole for v, x in held.items()})
        model = Reliability((weight + 1) / (total + 2), likely[0], likely[1])
        belief = [model.posterior(p) for p, _ in patterns]
    return model


FEATURES = [*LABELERS, *(f"is_{k}" for k in KINDS), "length"]


def _features(kind: Column, value: Column, vote: Column) -> list[Column]:
    own = [F.get(vote, k).cast("double").alias(n) for k, n in enumerate(LABELERS)]
    kinds = [(kind == k).cast("double").alias(f"is_{n}") for k, n in enumerate(KINDS)]
    return [*own, *kinds, F.least(F.length(value), F.lit(40)).cast("double").alias("length")]


def fit(candidates: DataFrame) -> tuple[list[float], float]:
    """Weights and intercept of the span classifier; ``candidates`` has kind, value and vote.

    Without candidates every weight is 0 and nothing but base spans is reported.
    """
    counted = materialise(candidates.select("vote", *_features(F.col("kind"), F.col("value"), F.col("vote"))).groupBy("vote", *FEATURES).count(), "patterns")
    patterns = [(list(r["vote"]), r["n"]) for r in counted.groupBy("vote").agg(F.sum("count").alias("n")).collect()]
    if not patterns:
        return [0.0] * len(FEATURES), -1.0
    model = estimate(patterns)
    believed = {tuple(p): model.posterior(p) for p, _ in patterns}
    if len(believed) == 0 or max(believed.values()) < 0.5:
        return [0.0] * len(FEATURES), -1.0
    # The pattern's probability as an expression: the same sum of logarithms, in the engine.
    logit = F.lit(math.log(model.prior / (1 - model.prior)))
    for k in range(len(LABELERS)):
        ratio = F.create_map(*[F.lit(x) for v in (-1, 0, 1) for x in (v, math.log(model.if_true[k][v] / model.if_false[k][v]))])
        logit = logit + ratio[F.get("vote", k)]
    belief = 1 / (1 + F.exp(-logit))
    sides = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), (belief * F.col("count")).alias("w")), F.struct(F.lit(0.0).alias("y"), ((1 - belief) * F.col("count")).alias("w")))).alias("side")
    rows = counted.select(*FEATURES, sides).select(*FEATURES, "side.y", "side.w")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows)
    fitted = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=0.001, maxIter=40).fit(rows)
    return [float(v) for v in fitted.coefficients], float(fitted.intercept)


def _found(text: Column) -> Column:
    """Candidates with their votes."""
    text = F.coalesce(text, F.lit(""))

    def voted(s):
        first = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)).cast("int")
        left = F.substring(text, first + 1, (s["start"] - first).cast("int"))
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"), votes(s["kind"], s["value"], left).alias("vote"))

    return F.transform(find_candidates(text), voted)


def find(docs: DataFrame, columns: list[str], result: str = "found") -> DataFrame:
    """The named columns of every row of ``docs`` and, as ``result``, sorted spans with their score.

    Base spans are always there; a span of another kind is there when the classifier gives it 0.5 or
    more. Null and empty texts have none. Repeated rows are searched one by one; overlapping spans of
    different kinds are all reported. A column of ``docs`` called like ``result`` is left out, others
    pass unchanged whatever their names. An empty table gives an empty one.
    """
    names = [F.col(f"`{c}`") for c in columns if c != result]
    kept = materialise(docs.select(*names, _found(F.col("text")).alias(result)), "candidates")
    each = kept.select(F.explode(result).alias("s")).select("s.kind", "s.value", "s.vote")
    weights, intercept = fit(each)

    def score(s):
        made = _features(s["kind"], s["value"], s["vote"])
        margin = reduce(lambda a, b: a + b, [w * f for w, f in zip(weights, made, strict=True)], F.lit(intercept))
        return 1 / (1 + F.exp(-margin))

    scored = F.transform(result, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), score(s).alias("score")))
    judged = F.filter(scored, lambda s: (s["kind"] < len(BASE)) | (s["score"] >= 0.5))
    return kept.select(*names, judged.alias(result))


def digest(found: DataFrame) -> DataFrame:
    """The counts, positions and hash of the spans of each row."""
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    counts = [sp.count(F.col("found"), k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    return found.select("doc_id", *counts, let(base, lambda b: F.sha2(sp.joined(b, KINDS), 256)).alias("base_sha256"), sp.joined(F.col("found"), KINDS).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets.

    Spans that overlap or touch are replaced together, by the kind of the first. Null texts stay null.
    ``n_chars``, if there, is that of the new text. All other columns are unchanged.
    """
    columns = docs.columns
    spans = free_name("found", columns)
    found = find(docs, columns, spans)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def merge(acc, s):
        last = F.get(acc, F.size(acc) - 1)
        wider = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        own = F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
        joins = (F.size(acc) > 0) & (s["start"] < last["end"])
        return F.when(joins, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(wider))).otherwise(F.concat(acc, F.array(own)))

    merged = F.aggregate(spans, F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)"), merge)

    def rebuilt(runs):
        n = F.size(runs)

        def part(s, i):
            before = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(runs, i - 1)["end"])
            return F.concat(F.substring(F.col("text"), (before + 1).cast("int"), (s["start"] - before).cast("int")), F.get(names, s["kind"]))

        tail = F.substring(F.col("text"), (F.get(runs, n - 1)["end"] + 1).cast("int"), F.length("text"))
        return F.concat(F.array_join(F.transform(runs, part), ""), tail)

    text = F.when(F.size(spans) == 0, F.col("text")).otherwise(let(merged, rebuilt))
    out = found.withColumn("text", text).drop(spans)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*[F.col(f"`{c}`") for c in columns])

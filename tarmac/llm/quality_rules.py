"""Quality verdicts by a decision list that is learned from labelled statistics.

Everything runs in built-in expressions and aggregates. Rules are found by sequential covering: a
conjunction of thresholds grows on two thirds of the labelled rows by information gain, is pruned on
the other third, and the rows it covers leave before the next rule is sought. Each step reads counts
by (statistic, bin, label), a result of fixed size, so the labelled rows may be any number.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, materialise

BLANK = r"[\x20\x09-\x0D]+"
WINDOW = 5
BINS = 48
# Shares in either tail at which there are edges as well.
TAILS = (0.001, 0.003, 0.01)

FEATURES = [
    "n_words",
    "word_length",
    "symbols_per_word",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "bar_share",
    "bang_share",
    "distinct_share",
    "words_per_line",
]


@dataclass(frozen=True)
class Condition:
    """``feature <= threshold`` or, if not ``below``, ``feature > threshold``."""

    feature: str
    below: bool
    threshold: float

    def column(self, stats: Column) -> Column:
        value = stats[self.feature]
        return value <= self.threshold if self.below else value > self.threshold


Rule = tuple[Condition, ...]


def _repeated_words(words: Column, size: int) -> Column:
    """How many words lie in windows of ``size`` words that the text holds twice or more."""
    n = F.size(words)

    def join(make, at):
        return make(*[F.get(words, at + j) for j in range(size)])

    places = F.sequence(F.lit(0), n - size)
    hashes = F.transform(places, lambda i: join(F.xxhash64, i))
    windows = F.sort_array(F.transform(places, lambda i: F.struct(join(lambda *w: F.concat_ws(" ", *w), i).alias("w"), i.alias("at"))))

    def covered(rows):
        # Windows whose neighbour in sorted order has the same words, back in the order of the text.
        def twin(i):
            own = F.get(rows, i)["w"]
            return F.coalesce(own == F.get(rows, i + 1)["w"], F.lit(False)) | ((i > 0) & F.coalesce(own == F.get(rows, F.greatest(i - 1, F.lit(0)))["w"], F.lit(False)))

        twins = F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(rows) - 1), twin), lambda i: F.get(rows, i)["at"]))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, at: F.struct((at + size).alias("end"), (acc["n"] + at + size - F.greatest(acc["end"], at)).alias("n"))
        return F.aggregate(twins, start, step, lambda acc: acc["n"])

    none = F.lit(0).cast("long")
    return F.when(n < size, none).when(F.size(F.array_distinct(hashes)) == n - size + 1, none).otherwise(let(windows, covered))


def text_statistics(text: Column) -> Column:
    """A struct of the counts of a text and the shares that rules are learned from.

    Null is the empty text. Counts are long: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words; shares are 0 for a text without words.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, BLANK), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w):
        return F.struct(
            F.size(w).cast("long").alias("n"),
            F.aggregate(w, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x)).alias("chars"),
            _repeated_words(w, WINDOW).alias("repeated"),
            F.size(F.array_distinct(w)).cast("long").alias("distinct"),
        )

    def of_lines(x):
        return F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))

    def share(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    def count(pattern):
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    def out(w, x, c):
        return F.struct(
            w["n"].alias("n_words"),
            w["chars"].alias("word_chars"),
            c["symbols"].alias("n_symbols"),
            x["dup"].alias("n_dup_lines"),
            w["repeated"].alias("n_repeat_words"),
            share(w["chars"], w["n"]).alias("word_length"),
            share(c["symbols"], w["n"]).alias("symbols_per_word"),
            share(x["dup"], x["n"]).alias("dup_line_share"),
            share(w["repeated"], w["n"]).alias("repeat_share"),
            share(c["upper"], w["chars"]).alias("upper_share"),
            share(c["digits"], w["chars"]).alias("digit_share"),
            share(c["bars"], w["n"]).alias("bar_share"),
            share(c["bangs"], w["n"]).alias("bang_share"),
            share(w["distinct"], w["n"]).alias("distinct_share"),
            share(w["n"], x["n"]).alias("words_per_line"),
        )

    counts = F.struct(count(r"[#*$%&|<>]").alias("symbols"), count(r"\p{Lu}").alias("upper"), count(r"[0-9]").alias("digits"), count(r"\|").alias("bars"), count(r"!").alias("bangs"))
    return let(F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("x"), counts.alias("c")), lambda s: out(s["w"], s["x"], s["c"]))


def base_failed(stats: Column) -> Column:
    """Too short (under 10 words), or over a fifth of the words in repeated windows."""
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


def _matches(rule: Rule, stats: Column) -> Column:
    return reduce(lambda a, b: a & b, [c.column(stats) for c in rule], F.lit(True))


def _place(value: Column, edges: list[float]) -> Column:
    """How many edges lie below a value; an array keeps the expression small for any number of them."""
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: value > e))


def _counts(rows: DataFrame) -> dict[str, dict[int, list[float]]]:
    """For every statistic and bin the numbers of bad and good rows."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin")) for f in FEATURES])).alias("cell")
    found = rows.select("bad", cells).groupBy("cell.feature", "cell.bin").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
    out: dict[str, dict[int, list[float]]] = {f: {} for f in FEATURES}
    for r in found:
        out[r["feature"]][r["bin"]] = [r["p"], r["n"]]
    return out


def _best(counts: dict[str, dict[int, list[float]]], edges: dict[str, list[float]]) -> tuple[float, Condition | None, float, float]:
    """The condition of the largest information gain, with the bad and good rows it keeps."""
    best: tuple[float, Condition | None, float, float] = (0.0, None, 0.0, 0.0)
    for feature in FEATURES:
        bins = counts[feature]
        p0, n0 = sum(v[0] for v in bins.values()), sum(v[1] for v in bins.values())
        if not p0:
            continue
        before, p, n = math.log2(p0 / (p0 + n0)), 0.0, 0.0
        for k, edge in enumerate(edges[feature]):
            p, n = p + bins.get(k, [0, 0])[0], n + bins.get(k, [0, 0])[1]
            for below, (a, b) in ((True, (p, n)), (False, (p0 - p, n0 - n))):
                if a > 0 and a + b < p0 + n0:
                    gain = a * (math.log2(a / (a + b)) - before)
                    if gain > best[0]:
                        best = (gain, Condition(feature, below, edge), a, b)
    return best


def learn(rows: DataFrame, max_conditions: int = 4, precision: float = 0.95, least: float = 0.01) -> list[Rule]:
    """Rules, in order, that cover bad rows.

    ``rows`` has ``stats`` (struct with ``FEATURES``), ``bad`` (0/1) and ``part`` (0 to 2; 2 prunes).
    A rule is a conjunction of at most ``max_conditions`` thresholds. It must reach ``precision`` on the
    pruning rows and cover a share ``least`` of their bad ones; one that does not is dropped, and the
    rows it matches no longer count for growing. There are as many rules as that gives: the list ends
    when the next rule would match less than the share ``least`` of the bad growing rows, so after
    some 1 / ``least`` candidates at most. Of conditions of equal gain the first by feature and threshold
    is taken. Rows without either label give no rule.
    """
    total = rows.groupBy("part").agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect()
    if not total or sum(r["bad"] for r in total) in (0, sum(r["n"] for r in total)):
        return []
    points = sorted({k / BINS for k in range(1, BINS)} | set(TAILS) | {1 - t for t in TAILS})
    # The quantiles of the bad rows as well, so that a rare kind of bad row has edges of its own.
    of = {"all": lambda f: F.col("stats")[f].cast("double"), "bad": lambda f: F.when(F.col("bad") == 1, F.col("stats")[f].cast("double"))}
    found = rows.agg(*[F.percentile_approx(value(f), points, 10_000).alias(f"{f}_{k}") for f in FEATURES for k, value in of.items()]).first()
    # Thresholds lie midway between neighbouring quantiles, clear of the rows on either side.
    values = {f: sorted({*found[f"{f}_all"], *found[f"{f}_bad"]}) for f in FEATURES}
    edges = {f: [(a + b) / 2 for a, b in zip(v, v[1:], strict=False)] or v for f, v in values.items()}
    places = {f"bin_{f}": _place(F.col("stats")[f], edges[f]) for f in FEATURES}
    rows = materialise(rows.withColumns(places), "labelled")
    bad_in = {part: sum(r["bad"] for r in total if (r["part"] == 2) == (part == 2)) for part in (0, 2)}
    rules: list[Rule] = []
    left, grow = rows.where("part = 2"), rows.where("part <> 2")
    stats = F.col("stats")
    while True:
        rule: Rule = ()
        bad = 0.0
        while len(rule) < max_conditions:
            _, condition, matched, good = _best(_counts(grow.where(_matches(rule, stats))), edges)
            if condition is None:
                break
            rule, bad = (*rule, condition), matched
            if good <= 0.01 * bad:
                break
        if not rule or bad < max(1, least * bad_in[0]):
            break
        # Every prefix of the rule on the pruning rows, in one pass.
        tests = [_matches(rule[:k], stats) for k in range(1, len(rule) + 1)]
        sums = [F.sum(F.when(t, x).otherwise(0)).alias(f"{s}{k}") for k, t in enumerate(tests) for s, x in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]
        seen = left.agg(*sums).first()
        worth = [((seen[f"p{k}"] or 0), (seen[f"n{k}"] or 0)) for k in range(len(rule))]
        good_enough = [k for k, (p, n) in enumerate(worth) if p >= max(1, least * bad_in[2]) and p >= precision * (p + n)]
        if good_enough:
            rule = rule[: max(good_enough, key=lambda k: (worth[k][0] - worth[k][1], -k)) + 1]
            rules.append(rule)
            left = left.where(~_matches(rule, stats))
        grow = grow.where(~_matches(rule, stats))
    return rules


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The ordered conditional expression: false for the first rule that matches, else true."""
    if not rules:
        return F.lit(True)
    chain = F.when(_matches(rules[0], stats), False)
    for rule in rules[1:]:
        chain = chain.when(_matches(rule, stats), False)
    return chain.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, columns: list[str], results: tuple[str, str, str] = ("stats", "base_failed", "kept")) -> DataFrame:
    """The named columns of every row of ``docs``, with its statistics, base verdict and verdict.

    ``results`` names the three; a column of ``docs`` of such a name is left out, others of any name
    pass. ``labels`` has ``doc_id`` and ``quality`` (0 bad, 1 good; others and nulls are not learned
    from). Null texts are empty and fail the base rules. Repeated rows are judged one by one and alike.
    With no labelled rows the base rules alone decide; an empty table gives an empty one.
    """
    stats, base, kept = results
    passed = [F.col(f"`{c}`") for c in columns if c not in results]
    scored = materialise(docs.select(*passed, text_statistics(F.col("text")).alias(stats)), "statistics")
    known = labels.where("quality in (0, 1)").select("doc_id", (1 - F.col("quality")).cast("long").alias("bad"))
    rows = scored.select("doc_id", F.col(stats).alias("stats")).join(known, "doc_id").where(~base_failed(F.col("stats")))
    rows = rows.select("stats", "bad", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("part"))
    rules = learn(rows)
    failed = base_failed(F.col(stats))
    return scored.select("*", failed.alias(base), (~failed & verdict(rules, F.col(stats))).alias(kept))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    columns = docs.columns
    names = tuple(free_name(n, columns) for n in ("stats", "base_failed", "kept"))
    return judge(docs, labels, columns, names).where(F.col(names[2])).select(*[F.col(f"`{c}`") for c in columns])

"""Quality rules: text statistics, and a decision list learned from labelled ones.

Built-in functions only. Sequential covering: a rule is grown threshold by threshold on two thirds
of the labelled texts not covered yet, pruned on the other third, and kept if it is right often
enough there; what it covers is set aside and the next one is grown. The result is an ordered
conditional expression. All counting is done by Spark over all labelled texts; the driver sees a
few counts per threshold. A threshold lies half-way between the values of the growing texts that it
parts, so a text a little beyond all good ones seen is not rejected yet.

A null text has no words. Rows that repeat are judged alike. A document with several labels counts
once, as bad if any label says so; labels that are null or belong to no document are left out. With
no labels, or one kind only, the list is empty and the base rule alone decides.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from math import exp, log, log2
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import SPACE_CLASS, SPACES, whole_text
from tillroll.operators.lookup import lookup_join
from tillroll.session import scratch_dir

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
MARKS = "!?;:\"'()[]{}/\\~^_=+@`"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _holding(text: Column, chars: str) -> Column:
    """How many of ``chars`` are in the text."""
    return (F.char_length(text) - F.char_length(_without(text, chars))).cast("bigint")


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tie`` (a hash of the text) and the text's statistics; one pass, no shuffle.

    Repeated windows are found by sorting a document's windows by hash; neighbours of one hash are
    compared word by word.
    """
    text = F.col("text")
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"{SPACE_CLASS}+")
    )
    lines = F.filter(F.split(text, "\n", -1), lambda x: _without(x, SPACES) != "")
    plain = docs.select("doc_id", whole_text().alias("text"))
    read = plain.select(
        "doc_id",
        F.xxhash64(text).alias("tie"),
        words.alias("words"),
        F.char_length(_without(text, SPACES)).cast("bigint").alias("word_chars"),
        lines.alias("lines"),
        _holding(text, SYMBOLS).alias("n_symbols"),
        _holding(text, UPPER).alias("n_upper"),
        _holding(text, DIGITS).alias("n_digits"),
        _holding(text, MARKS).alias("n_marks"),
    )
    at = lambda i: F.get("words", i)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.struct(F.xxhash64(at(i), at(i + 1), at(i + 2)).alias("h"), i.alias("i")),
    )
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    counted = read.select(
        "doc_id", "tie", "word_chars", "n_symbols", "n_upper", "n_digits", "n_marks", "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("words") >= 3, F.sort_array(windows)).otherwise(none).alias("sorted"),
    )

    def same(x: Column, y: Column) -> Column:
        equal = [at(x["i"] + k) == at(y["i"] + k) for k in range(3)]
        return (x["h"] == y["h"]) & reduce(and_, equal)

    def repeated(x: Column, k: Column) -> Column:
        beside = [same(x, F.get("sorted", k - 1)), same(x, F.get("sorted", k + 1))]
        return F.coalesce(beside[0], F.lit(False)) | F.coalesce(beside[1], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("sorted", repeated), lambda x: x["i"]))
    found = counted.select(
        "doc_id", "tie", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_upper",
        "n_digits", "n_marks", starts.alias("starts"),
    )
    following = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.lit(2**31 - 1)))
    steps = F.zip_with("starts", following, lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.aggregate(steps, F.lit(0), lambda a, x: a + x)
    return found.withColumn(
        "n_repeat_words", F.when(F.size("starts") > 0, covered).otherwise(0).cast("bigint")
    ).drop("starts")


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def _share(count: str, of: str) -> Column:
    return F.when(F.col(of) > 0, F.col(count) / F.col(of)).otherwise(F.lit(0.0))


#: What rules are made of, as shares, so that they mean the same in texts of any length.
FEATURES = {
    "repeat_share": ("n_repeat_words", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "word_length": ("word_chars", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def feature(name: str) -> Column:
    return _share(*FEATURES[name])


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` or ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float

    def holds(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule) -> Column:
    return reduce(and_, (c.holds() for c in rule))


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects a text, null if none does."""
    chain = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        chain = F.when(covers(rules[i]), F.lit(i)).otherwise(chain)
    return chain


@dataclass(frozen=True)
class Learning:
    """How rules are learned.

    On the pruning third a rule must reach ``least_precision``, and cover so many bad texts that as many
    among texts taken at random are less likely than ``most_chance``: a few where bad texts are
    rare, more where they are common, so that small sets of labels are learned from too.
    """

    max_rules: int = 8
    max_conditions: int = 3
    cuts: int = 24
    least_precision: float = 0.95
    most_chance: float = 0.001


def _gain(bad: int, good: int, bad0: int, good0: int) -> float:
    """First-order information gain of narrowing (bad0, good0) to (bad, good)."""
    if not bad or not bad0:
        return 0.0
    return bad * (log2(bad / (bad + good)) - log2(bad0 / (bad0 + good0)))


def _chance(bad: int, good: int, share: float) -> float:
    """A bound (Chernoff's) of how likely such a share of bad texts is, where ``share`` of all are bad."""
    n = bad + good
    if not n or bad / n <= share:
        return 1.0
    told = sum(k * log(k / (n * of)) for k, of in ((bad, share), (good, 1 - share)) if k)
    return exp(-told)


def _cuts(rows: DataFrame, options: Learning) -> dict[str, list[float]]:
    """Candidate thresholds per feature: quantiles of the bad texts and of the good ones."""
    shares = [i / options.cuts for i in range(options.cuts + 1)]
    quantiles = [
        F.percentile_approx(F.when(F.col("bad") == b, F.col(f)), shares, 2000).alias(f"{f}_{int(b)}")
        for f in FEATURES
        for b in (True, False)
    ]
    got = rows.agg(*quantiles).first()
    return {f: sorted({*(got[f"{f}_1"] or []), *(got[f"{f}_0"] or [])}) for f in FEATURES}


def _histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """Per feature and interval between cuts: good and bad texts. One job, a few hundred rows."""
    placed = [
        F.struct(
            F.lit(f).alias("f"),
            reduce(add, ((F.col(f) > c).cast("int") for c in cuts[f]), F.lit(0)).alias("bin"),
        )
        for f in FEATURES
    ]
    counts = (
        rows.select("bad", F.explode(F.array(*placed)).alias("x"))
        .groupBy("x.f", "x.bin")
        .agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    )
    out = {f: [[0, 0] for _ in range(len(cuts[f]) + 1)] for f in FEATURES}
    for r in counts.collect():
        out[r["f"]][r["bin"]] = [r["good"], r["bad"]]
    return out


def _best(histogram, cuts) -> tuple[float, Condition | None, int]:
    best, chosen, left = 0.0, None, 0
    for f, bins in histogram.items():
        good0, bad0 = (sum(b[i] for b in bins) for i in (0, 1))
        good, bad = 0, 0
        for cut, (g, b) in zip(cuts[f], bins, strict=False):
            good, bad = good + g, bad + b
            for above, n_bad, n_good in ((False, bad, good), (True, bad0 - bad, good0 - good)):
                gain = _gain(n_bad, n_good, bad0, good0)
                if gain > best + 1e-9:
                    best, chosen, left = gain, Condition(f, above, float(cut)), n_good
    return best, chosen, left


def _half_way(rows: DataFrame, condition: Condition) -> Condition:
    """The condition with its threshold in the middle of the gap between rows that it lies in."""
    value, c = F.col(condition.feature), condition.threshold
    gap = rows.agg(F.max(F.when(value <= c, value)), F.min(F.when(value > c, value))).first()
    return replace(condition, threshold=(gap[0] + gap[1]) / 2)


def _grow(rows: DataFrame, cuts, options: Learning) -> Rule:
    rule: Rule = ()
    while len(rule) < options.max_conditions:
        now = rows.where(_on_columns(rule)) if rule else rows
        gain, condition, n_good = _best(_histogram(now, cuts), cuts)
        if condition is None:
            break
        rule = (*rule, _half_way(now, condition))
        if n_good == 0:
            break
    return rule


def _on_columns(rule: Rule) -> Column:
    """The rule over rows that hold the features as columns."""
    tests = [
        F.col(c.feature) > c.threshold if c.above else F.col(c.feature) <= c.threshold
        for c in rule
    ]
    return reduce(and_, tests)


def _prune(rows: DataFrame, rule: Rule, options: Learning) -> Rule:
    """The shortest beginning of the rule with the best precision on rows it was not grown on."""
    stems = [rule[: i + 1] for i in range(len(rule))]
    counts = rows.agg(
        F.count_if("bad").alias("bad"),
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(_on_columns(s) & (F.col("bad") == b)).alias(f"n{i}_{int(b)}")
            for i, s in enumerate(stems)
            for b in (True, False)
        ],
    ).first()
    best: tuple[float, Rule] = (0.0, ())
    for i, stem in enumerate(stems):
        bad, good = counts[f"n{i}_1"], counts[f"n{i}_0"]
        if bad < options.least_precision * (bad + good):
            continue
        precision = (bad + 0.5) / (bad + good + 1)
        likely = _chance(bad, good, counts["bad"] / counts["n"]) if bad else 1.0
        if likely <= options.most_chance and precision > best[0]:
            best = (precision, stem)
    return best[1]


def learn(stats: DataFrame, labels: DataFrame, options: Learning = Learning()) -> list[Rule]:
    """Rules that reject, from the statistics of labelled texts and their ``quality`` (0 is bad)."""
    spark = stats.sparkSession
    judged = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.min("quality") == 0).alias("bad"))
    )
    known = (
        stats.where(~base_failed())  # the base rule has the others already
        .join(judged, "doc_id")
        .select(
            "bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("pruning"),
            *[feature(f).alias(f) for f in FEATURES],
        )
    )
    path = scratch_dir(spark, "labelled")
    known.write.parquet(path)
    rows = spark.read.parquet(path)
    kinds = {r["bad"] for r in rows.groupBy("bad").count().collect()}
    if kinds != {True, False}:
        return []
    cuts = _cuts(rows, options)
    growing, pruning = rows.where(~F.col("pruning")), rows.where("pruning")
    rules: list[Rule] = []
    for _ in range(options.max_rules):
        rule = _grow(growing, cuts, options)
        rule = _prune(pruning, rule, options) if rule else rule
        if not rule:
            break
        rules.append(rule)
        growing, pruning = (r.where(~_on_columns(rule)) for r in (growing, pruning))
    return rules


def judge(docs: DataFrame, labels: DataFrame, options: Learning = Learning()) -> DataFrame:
    """One row per document: statistics, ``base_failed``, ``rule`` that rejects it, ``kept``.

    The statistics are written once; learning and judging both read them.
    """
    path = scratch_dir(docs.sparkSession, "statistics")
    statistics(docs).write.parquet(path)
    stats = docs.sparkSession.read.parquet(path)
    rules = learn(stats, labels, options)
    judged = stats.select(
        "doc_id", "tie", *STATISTICS, base_failed().alias("base_failed"), verdict(rules).alias("rule")
    )
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame, options: Learning = Learning()) -> DataFrame:
    """The documents, all columns, that the rules keep."""
    judged = judge(docs, labels, options).where("kept").select("doc_id", "tie").distinct()
    marked = docs.select(
        F.struct("*").alias("row"), "doc_id", F.xxhash64(whole_text()).alias("tie")
    )
    keys = {"doc_id": "doc_id", "tie": "tie"}
    kept = lookup_join(marked, judged, keys, "left_semi", nulls_match=True)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

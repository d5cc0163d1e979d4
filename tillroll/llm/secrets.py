"""Secrets: known forms, and strings whose sliding-window entropy is high for their class.

Built-in functions only. A text that is null or empty has no spans; rows that repeat are reported
as often as they come; columns other than ``doc_id`` and ``text`` play no part.

The base kinds stand as they match. A further candidate is a run of token characters with letters
and digits in it, outside of base spans and not on the allow list; it counts if some window of
``WINDOW`` characters has the entropy that its character class asks for. Counts are carried from
window to window: one character leaves, one enters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import spans as sp
from tillroll.llm.tables import whole_text

KINDS = ("assign", "access", "hex", "entropy")
N_BASE = 3

VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = (
    r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*+[:=]\x20*+[\"']?"
    rf"({VALUE}++)"
)
# Runs too short to count cannot pass wherever they are entered, so length belongs to the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}+"
HEX = "[0-9a-f]{24,}+"
CANDIDATE = "[A-Za-z0-9+/=_-]{20,}+"

WINDOW = 20
# Bits per character that a window of a class must reach.
LEAST_BITS = {"hex": 3.0, "upper": 3.4, "mixed": 3.7}
# Forms that look random and are none.
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|changeme|x{6,}|0123456789|abcdefgh"
    r"|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    r"|^(?:sha(?:1|256|384|512)|md5)[-=_]|^[0-9]{4}-[0-9]{2}-[0-9]{2}"
)


def _weight(n: Column) -> Column:
    """n * log2(n), 0 for none."""
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def _in(window: Column, char: Column) -> Column:
    return F.length(window) - F.length(F.replace(window, char, F.lit("")))


def peak_entropy(value: Column, width: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits per character, of any window of ``value``.

    ``value`` is ASCII and at least ``width`` long. The state is the window and the sum of
    n * log2(n) over its characters; a step changes the two terms of the characters that move.
    """
    chars = F.split(value, "")
    first = F.left(value, F.lit(width))
    total = F.aggregate(
        F.array_distinct(F.split(first, "")),
        F.lit(0.0),
        lambda s, c: s + _weight(_in(first, c)),
    )
    moves = F.slice(chars, F.lit(width + 1), F.greatest(F.size(chars) - width, F.lit(0)))
    start = F.struct(first.alias("w"), total.alias("sum"), total.alias("least"))

    def step(acc: Column, entering: Column) -> Column:
        leaving = F.left(acc["w"], F.lit(1))
        gone = _in(acc["w"], leaving)
        come = _in(acc["w"], entering)
        moved = acc["sum"] - _weight(gone) + _weight(gone - 1) + _weight(come + 1) - _weight(come)
        now = F.when(leaving == entering, acc["sum"]).otherwise(moved)
        return F.struct(
            F.concat(F.right(acc["w"], F.lit(width - 1)), entering).alias("w"),
            now.alias("sum"),
            F.least(acc["least"], now).alias("least"),
        )

    least = F.aggregate(moves, start, step, lambda acc: acc["least"])
    return F.log2(F.lit(float(width))) - least / width


def _suspicious(m: Column) -> Column:
    lettered = m.rlike("[0-9]") & m.rlike("[A-Za-z]") & ~m.rlike(ALLOWED)
    least = (
        F.when(m.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), LEAST_BITS["hex"])
        .when(m.rlike("^[A-Z0-9_-]+$"), LEAST_BITS["upper"])
        .otherwise(LEAST_BITS["mixed"])
    )
    return F.when(lettered, peak_entropy(m) >= least).otherwise(F.lit(False))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``spans``: arrays of (s, kind, e, score), in order.

    ``kind`` indexes ``KINDS``, offsets are code points, ``e`` is exclusive. An assignment's span
    runs from its keyword to the end of its value.
    """
    always = lambda m: F.lit(True)
    long_enough = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 6
    text = F.col("text")
    texts = docs.select("doc_id", whole_text().alias("text"))
    found = texts.select(
        "doc_id",
        sp.spans(text, ASSIGN, 0, long_enough).alias("assign"),
        sp.spans(text, ACCESS, 1, always).alias("access"),
        sp.spans(text, HEX, 2, always).alias("hex"),
        sp.spans(text, CANDIDATE, 3, _suspicious).alias("entropy"),
    )
    based = found.select("doc_id", sp.in_order("assign", "access", "hex").alias("base"), "entropy")
    added = sp.apart_from(F.col("entropy"), F.col("base"))
    return based.select("doc_id", "base", sp.in_order(F.col("base"), added).alias("spans"))

"""Regular expression matches with their places, as columns of built-in functions.

Spark returns matches without offsets. The pieces between matches, from ``split``, and the matches
alternate, so lengths added up along both give every offset in code points.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s:int,kind:int,e:int,score:double>>"
CONTEXT = 48  # code points looked at on either side of a match
BLOCK = 256  # matches gathered by one aggregate


def spans(
    text: Column,
    pattern: str,
    kind: int,
    valid: Callable[[Column], Column],
    score: Callable[[Column, Column, Column], Column] | None = None,
) -> Column:
    """Leftmost, non-overlapping matches of ``pattern`` that are ``valid``, in order.

    ``score(match, before, after)`` sees up to ``CONTEXT`` code points of text on either side, but
    not beyond a neighbouring match. The pattern must not match the empty string.

    An aggregate copies what it has gathered at every step, so matches are taken in blocks: lengths are
    added up over blocks first, then within each.
    """
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    after = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    steps = F.arrays_zip(pieces.alias("p"), found.alias("m"), after.alias("a"))
    zipped = F.transform(
        steps, lambda z: F.struct(z["p"].alias("0"), z["m"].alias("1"), z["a"].alias("2"))
    )

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["0"])
        end = begin + F.coalesce(F.char_length(x["1"]), F.lit(0))
        near = (F.right(x["0"], F.lit(CONTEXT)), F.left(x["2"], F.lit(CONTEXT)))
        value = F.lit(1.0) if score is None else score(x["1"], *near)
        span = F.struct(
            begin.alias("s"), F.lit(kind).alias("kind"), end.alias("e"), value.alias("score")
        )
        ok = x["1"].isNotNull() & F.coalesce(valid(x["1"]), F.lit(False))
        grown = F.when(ok, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), grown.alias("out"))

    def places_from(begin: Column, part: Column) -> Column:
        start = F.struct(begin.alias("at"), F.array().cast(SPAN).alias("out"))
        return F.aggregate(part, start, step, lambda acc: acc["out"])

    def in_blocks(whole: Column) -> Column:
        numbers = F.sequence(F.lit(1), F.size(whole), F.lit(BLOCK))
        blocks = F.transform(numbers, lambda i: F.slice(whole, i, F.lit(BLOCK)))
        widths = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), _width))
        begins = F.aggregate(
            widths, F.array(F.lit(0)), lambda acc, w: F.concat(acc, F.array(F.element_at(acc, -1) + w))
        )
        placed = F.arrays_zip(blocks.alias("block"), begins.alias("begin"))
        # The last begin is the end of the text and has no block.
        held = F.filter(placed, lambda z: z["block"].isNotNull())
        return F.flatten(F.transform(held, lambda z: places_from(z["begin"], z["block"])))

    few = places_from(F.lit(0), zipped)
    places = F.when(F.size(pieces) <= BLOCK, few).otherwise(in_blocks(zipped))
    # Most texts have no match at all: one scan then, and no interpreted steps.
    return F.when(text.rlike(pattern), places).otherwise(F.array().cast(SPAN))


def _width(total: Column, x: Column) -> Column:
    """The code points of a piece and of the match after it, added."""
    return total + F.char_length(x["0"]) + F.coalesce(F.char_length(x["1"]), F.lit(0))


def scored(found: Column, least: float) -> Column:
    return F.filter(found, lambda x: x["score"] >= least)


def apart_from(found: Column, others: Column) -> Column:
    """Those that overlap none of ``others``."""
    overlap = lambda x: F.exists(others, lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"]))
    return F.when(F.size(found) == 0, found).otherwise(F.filter(found, lambda x: ~overlap(x)))


def in_order(*found: Column) -> Column:
    """All spans by start, then kind as numbered."""
    return F.sort_array(F.concat(*found))


def written(found: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    one = lambda x: F.concat(
        F.get(names, x["kind"]), F.lit(":"), x["s"].cast("string"), F.lit(":"),
        x["e"].cast("string"),
    )
    return F.array_join(F.transform(found, one), ",")


def count(found: Column) -> Column:
    return F.size(found).cast("bigint")

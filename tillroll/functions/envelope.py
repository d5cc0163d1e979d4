"""The log envelope: a record's JSON text carried as a JSON string literal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the lenient decoder.
OUTER_QUOTES = '^"|"$'
ESCAPED_QUOTE = '\\"'


def strip_quotes(line: Column) -> Column:
    """The raw line without the quote characters around it."""
    quote = F.lit('"')
    # Trimming looks at each character of a line, and most have nothing to trim.
    quoted = F.startswith(line, quote) | F.endswith(line, quote)
    return F.when(quoted, F.btrim(line, quote)).otherwise(line)


def encode(record: Column) -> Column:
    """The record as a JSON string literal; null stays null."""
    listed = F.to_json(F.array(record)).cast("binary")  # cut as bytes, without counting characters
    literal = F.substring(listed, F.lit(2), F.octet_length(listed) - 2).cast("string")
    return F.nullif(literal, F.lit("null"))


def decode(value: Column, mode: str = "json") -> Column:
    """The record inside an envelope.

    ``json`` undoes every escape. ``regex`` only strips the outer quotes and unescapes quote
    characters: records with quotes or backslashes in their text come out damaged.
    """
    if mode == "json":
        return F.from_json(F.concat(F.lit('{"v":'), value, F.lit("}")), "v string")["v"]
    if mode == "regex":
        bare = F.regexp_replace(value, OUTER_QUOTES, "")
        return F.replace(bare, F.lit(ESCAPED_QUOTE), F.lit('"'))
    raise ValueError(f"unknown envelope mode {mode!r}")

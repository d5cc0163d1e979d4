"""Personal data: expressions propose spans, checksums confirm them, context words score them.

Built-in functions only. A text that is null or empty has no spans; rows that repeat are reported
as often as they come; columns other than ``doc_id`` and ``text`` play no part.

The base kinds (e-mail, address, card, phone) stand as they match. The further kinds are only kept
where checksum and context words bring their score to ``least_score``, and where no base span
overlaps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import spans as sp
from tillroll.llm.tables import whole_text

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
N_BASE = 4

# Where a part of a pattern can only match in one way, the possessive form keeps Java's matcher
# from going back over long runs. A run of e-mail characters is entered at its start, or where the
# last match ended, as entering it later can only find less.
EMAIL_CHARS = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{EMAIL_CHARS})){EMAIL_CHARS}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Runs of fewer digits than a card has cannot pass wherever they are entered.
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The length of account numbers by country, as registered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """Account numbers of each country's own length, in groups of four or none."""
    kinds = []
    for length, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        kinds.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    # Most places fail at the first look, before any country is tried.
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(kinds)})(?![A-Za-z0-9])"


IBAN = _iban_pattern()
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

# Words that make a kind likelier, and less likely, within reach of a match.
CONTEXT = {
    "iban": (r"(?i)\b(iban|account|bank|konto|cuenta|compte|transfer)\b", r"(?i)\b(serial|sku)\b"),
    "ssn": (r"(?i)\b(ssn|social security|tax id|taxpayer)\b", r"(?i)\b(part|order|invoice|item)\b"),
    "local_phone": (
        r"(?i)\b(tel|telephone|phone|call|mobile|cell|fax|telefon|tel[eé]fono)\b",
        r"(?i)\b(part|order|invoice|item|isbn)\b",
    ),
}
# How sure a pattern alone is, what a passed checksum adds, what context changes.
PRIOR = {"iban": 0.3, "ssn": 0.4, "local_phone": 0.3}
CHECKED = 0.4
NEAR = 0.4
LEAST_SCORE = 0.6


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits of ``number`` have a valid Luhn check digit."""
    backwards = F.split(F.reverse(number), "")
    weighed = F.transform(
        backwards,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (2 * d.cast("int")) % 10 + F.when(d.cast("int") >= 5, 1).otherwise(0)
        ),
    )
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number, spaces removed, leaves 1 when divided by 97."""
    plain = F.regexp_replace(value, r"\x20", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def step(a: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise(
            (a * 100 + letter) % 97
        )

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _is_card(m: Column) -> Column:
    number = digits(m)
    return F.when(F.length(number).between(12, 19), luhn(number)).otherwise(F.lit(False))


def _is_ip(m: Column) -> Column:
    small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (
        F.concat(F.lit("0"), F.right(p, F.lit(3))).cast("int") <= 255
    )
    return F.forall(F.split(m, r"\."), small)


def _is_phone(m: Column) -> Column:
    return F.length(digits(m)).between(9, 15)


def _is_ssn(m: Column) -> Column:
    area = F.left(m, F.lit(3))
    return ~(area.isin("000", "666") | area.startswith("9") | m.contains("-00-")) & ~m.endswith(
        "0000"
    )


def _score(kind: str, checked: bool):
    likelier, less = CONTEXT[kind]

    def score(_: Column, before: Column, after: Column) -> Column:
        near = F.concat_ws(" ", before, after)
        return (
            F.lit(PRIOR[kind] + (CHECKED if checked else 0.0))
            + F.when(near.rlike(likelier), NEAR).otherwise(0.0)
            - F.when(near.rlike(less), NEAR).otherwise(0.0)
        )

    return score


def find_pii(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """``doc_id``, ``base`` and ``spans``: arrays of (s, kind, e, score), in order.

    ``kind`` indexes ``KINDS``, offsets are code points, ``e`` is exclusive.
    """
    always = lambda m: F.lit(True)
    text = F.col("text")
    texts = docs.select("doc_id", whole_text().alias("text"))
    base = {
        "email": (EMAIL, always),
        "ip": (IP, _is_ip),
        "card": (CARD, _is_card),
        "phone": (PHONE, _is_phone),
    }
    further = {
        "iban": (IBAN, mod97, True),
        "ssn": (SSN, _is_ssn, False),
        "local_phone": (LOCAL_PHONE, always, False),
    }
    columns = {k: sp.spans(text, p, KINDS.index(k), ok) for k, (p, ok) in base.items()}
    columns |= {
        k: sp.scored(sp.spans(text, p, KINDS.index(k), ok, _score(k, checked)), least_score)
        for k, (p, ok, checked) in further.items()
    }
    found = texts.select("doc_id", *[c.alias(k) for k, c in columns.items()])
    based = found.select(
        "doc_id", sp.in_order(*[F.col(k) for k in base]).alias("base"), *further
    )
    added = F.concat(*[F.col(k) for k in further])
    return based.select(
        "doc_id", "base",
        sp.in_order(F.col("base"), sp.apart_from(added, F.col("base"))).alias("spans"),
    )


def digest(found: DataFrame, kinds=KINDS, n_base: int = N_BASE) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as text."""
    of_kind = lambda k: sp.count(F.filter("base", lambda x: x["kind"] == k))
    return found.select(
        "doc_id",
        *[of_kind(i).alias(f"n_{kinds[i]}") for i in range(n_base)],
        F.sha2(sp.written(F.col("base"), kinds), 256).alias("base_sha256"),
        sp.written(F.col("spans"), kinds).alias("spans"),
    )

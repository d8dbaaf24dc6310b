"""Personal data in texts: patterns propose spans, checksums confirm them and
nearby context words adjust the score.  Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larch.llm.common import text_or_empty, let
from larch.llm.spans import matches, of_kind

BASE_KINDS = ("email", "ip", "card", "phone")
METHOD_KINDS = ("iban", "national_id")

# Leftmost non-overlapping matches of the base kinds equal those of the plain
# patterns of the contract: possessive quantifiers and look-behinds only spare the search
# starts inside a run that its first character already failed for.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@"
         r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Length of a country's account numbers.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}
_COUNTRIES = "|".join(c for names in IBAN_LENGTHS.values() for c in names.split())
# The match is the number's first four characters, so that one that fails hides
# none that begins within it; group 1 is the number: as long as its country's, and
# for other codes as long as it can be.
IBAN = (r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?=((?:"
        + "|".join(r"(?:%s)[0-9]{2}(?: ?[A-Z0-9]){%d}" % (names.replace(" ", "|"), n - 4)
                   for n, names in IBAN_LENGTHS.items())
        + r"|(?!%s)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])))[A-Z]{2}[0-9]{2}" % _COUNTRIES)
#: Characters of a number after the first four, with spaces.
IBAN_REST = 60
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

CONTEXT_CHARS = 40
#: Score before checksum and context, what a valid checksum adds, context words.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.5, "iban": 0.2, "national_id": 0.3}
CHECKSUM_BONUS = 0.4
CONTEXT_BONUS = 0.3
CONTEXT_MALUS = 0.3
CONTEXT_FOR = {
    "email": "mail|contact|write to|correo|courriel|kontakt",
    "ip": "\\bip\\b|host|server|address|login|adresse",
    "card": "card|visa|mastercard|amex|payment|tarjeta|carte|karte",
    "phone": "phone|call|mobile|\\btel\\b|fax|telefon|téléphone|teléfono",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "national_id": "ssn|social security|tax id|national id|passport",
}
CONTEXT_AGAINST = {
    "email": "example only|noreply", "ip": "version|release|build|section",
    "card": "order|tracking|serial|isbn|invoice", "phone": "isbn|part no|version",
    "iban": "serial|licen[cs]e key", "national_id": "part no|serial|isbn",
}


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_valid(value: Column) -> Column:
    """13 to 19 digits whose Luhn sum is a multiple of ten."""
    return let(digits(value), lambda d: F.length(d).between(13, 19) & F.call_function("luhn_check", d))


def mod97_valid(value: Column) -> Column:
    """IBAN check: country and check digits moved to the end, letters as 10 to
    35, the number modulo 97 is 1."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = let(plain, lambda p: F.concat(F.substring(p, 5, 64), F.substring(p, 1, 4)))
    rest = F.aggregate(
        F.split(moved, ""), F.lit(0),
        lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97)
        .otherwise((acc * 100 + F.ascii(c) - 55) % 97))
    return F.length(plain).between(15, 34) & (rest == 1)


def iban_matches(text: Column, context: int) -> Column:
    """Account numbers with a valid checksum, as :func:`matches` gives them.  A
    number of a country without a known length is the longest part of whole
    groups that is valid."""
    found = matches(text, IBAN, text.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]"), value_group=1,
                    context=context + IBAN_REST)

    def valid(value: Column) -> Column:
        parts = let(F.split(value, " "), lambda w: F.transform(
            F.sequence(F.size(w), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(w, F.lit(1), n), " ")))
        tried = F.when(value.rlike("^(?:%s)" % _COUNTRIES), F.array(value)).otherwise(parts)
        return F.get(F.filter(tried, mod97_valid), F.lit(0))

    told = F.transform(found, lambda m: let(valid(m["value"]), lambda v: F.struct(
        m["start"].alias("start"), (m["start"] + F.length(v)).alias("end"), v.alias("value"),
        F.right(m["before"], F.lit(context)).alias("before"),
        F.substring(m["after"], F.length(v) - 3, F.lit(context)).alias("after"))))
    return F.filter(told, lambda m: m["value"].isNotNull())


def octets_valid(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda part: let(
        F.regexp_replace(part, "^0+(?=.)", ""),
        lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p).cast("int") <= 255)))


def _score(kind: str, checked: bool):
    def of(m: Column) -> Column:
        near = F.lower(F.concat_ws(" ", m["before"], m["after"]))
        prior = PRIOR[kind] + (CHECKSUM_BONUS if checked else 0.0)
        return F.least(F.lit(1.0), F.greatest(
            F.lit(0.0), F.lit(prior)
            + F.when(near.rlike(CONTEXT_FOR[kind]), CONTEXT_BONUS).otherwise(0.0)
            - F.when(near.rlike(CONTEXT_AGAINST[kind]), CONTEXT_MALUS).otherwise(0.0)))
    return of


def find_pii(docs: DataFrame, text_col: str = "text", threshold: float = 0.5,
             context_chars: int = CONTEXT_CHARS) -> DataFrame:
    """Adds ``pii``: ``array<struct<kind, start, end, score>>`` per row, ordered
    by kind (base kinds first, as listed), then start.

    The base kinds (email, ip, card, phone) are reported wherever their pattern
    and validator hold, with a score.  The kinds the method adds (iban,
    national_id) are reported when prior, checksum and context words reach
    ``threshold``.  Positions are code points, end exclusive.

    Null and empty texts get an empty array.  Repeated rows, extra columns and
    null keys pass through unchanged.  An empty table gives an empty result.
    """
    text = text_or_empty(text_col)
    ctx = context_chars
    email = matches(text, EMAIL, text.contains("@"), context=ctx)
    ip = matches(text, IP, text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), context=ctx)
    card = matches(text, CARD, text.rlike(r"[0-9](?:[ -]?[0-9]){12}"), context=ctx)
    phone = matches(text, PHONE, text.rlike(r"\+[0-9]"), context=ctx)
    iban = iban_matches(text, ctx)
    nid = matches(text, NATIONAL_ID, text.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), context=ctx)
    n_digits = lambda m: F.length(digits(m["value"]))
    parts = [
        of_kind("email", email, _score("email", False)),
        of_kind("ip", ip, _score("ip", False), lambda m: octets_valid(m["value"])),
        of_kind("card", card, _score("card", True), lambda m: luhn_valid(m["value"])),
        of_kind("phone", phone, _score("phone", False), lambda m: n_digits(m).between(9, 15)),
        F.filter(of_kind("iban", iban, _score("iban", True)),
                 lambda s: s["score"] >= threshold),
        F.filter(of_kind("national_id", nid, _score("national_id", False)),
                 lambda s: s["score"] >= threshold),
    ]
    return docs.withColumn("pii", F.concat(*parts))

"""Match positions of a regular expression as column expressions.

Spark's functions return matches without positions.  The pieces between the
matches (``split``) and the matches themselves (``regexp_extract_all``) come
from the same left-to-right search, so running sums of their lengths give each
match's start and end in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larch.llm.common import let

_BLOCK = 256
_POS = "array<struct<s:int,e:int>>"


def _ends(lengths: Column) -> Column:
    """Start and end of every match from ``array<struct<gap, len>>``.

    Running sums are folded within blocks and then over blocks, so a text with
    very many matches costs no quadratic copying.
    """
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(lengths) / _BLOCK).cast("int") - 1),
        lambda b: F.aggregate(
            F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)),
            F.struct(F.lit(0).alias("pos"), F.array().cast(_POS).alias("out")),
            lambda acc, v: F.struct(
                (acc["pos"] + v["gap"] + v["len"]).alias("pos"),
                F.concat(acc["out"], F.array(F.struct(
                    (acc["pos"] + v["gap"]).alias("s"),
                    (acc["pos"] + v["gap"] + v["len"]).alias("e")))).alias("out"))))

    def shifted(blks: Column) -> Column:
        offsets = F.aggregate(
            blks, F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("out")),
            lambda acc, b: F.struct((acc["pos"] + b["pos"]).alias("pos"),
                                    F.concat(acc["out"], F.array(acc["pos"])).alias("out")))
        return let(offsets, lambda off: F.flatten(F.zip_with(
            blks, off["out"], lambda b, o: F.transform(
                b["out"], lambda v: F.struct((v["s"] + o).alias("s"), (v["e"] + o).alias("e"))))))

    return let(blocks, shifted)


def matches(text: Column, pattern: str, maybe: Column, value_group: int = 0,
            context: int = 0) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` in ``text``.

    Returns ``array<struct<start int, end int, value string, before string,
    after string>>``: positions in code points (end exclusive), the text of
    ``value_group``, and up to ``context`` characters on either side, as far as
    the neighbouring matches.  Only texts for which the cheap test ``maybe``
    holds are searched; it must hold wherever the pattern matches.
    """
    def build(whole: Column, gaps: Column, values: Column) -> Column:
        lengths = F.transform(whole, lambda m, i: F.struct(
            F.length(gaps[i]).alias("gap"), F.length(m).alias("len")))
        return let(lengths, lambda ls: let(_ends(ls), lambda pos: F.transform(
            pos, lambda p, i: F.struct(
                p["s"].alias("start"), p["e"].alias("end"), values[i].alias("value"),
                (F.right(gaps[i], F.lit(context)) if context else F.lit("")).alias("before"),
                (F.left(gaps[i + 1], F.lit(context)) if context else F.lit("")).alias("after")))))

    kind = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))

    def found(m: Column) -> Column:
        rest = let(F.split(text, pattern, -1), lambda g: (
            build(m, g, m) if value_group == 0 else let(values, lambda v: build(m, g, v))))
        return F.when(F.size(m) > 0, rest.cast(kind)).otherwise(F.array().cast(kind))

    return F.when(maybe, let(whole, found)).otherwise(F.array().cast(kind))


def rendered(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def of_kind(kind: str, found: Column, score: Column | None = None, keep=None) -> Column:
    """Found matches as ``array<struct<kind, start, end, score>>``; ``keep`` and
    ``score`` are functions of a match."""
    kept = F.filter(found, keep) if keep is not None else found
    return F.transform(kept, lambda m: F.struct(
        F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
        (score(m) if score is not None else F.lit(1.0)).cast("double").alias("score")))

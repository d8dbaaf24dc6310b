"""Secrets in texts: base patterns, and character Markov models of random
strings and of ordinary identifiers compared by log-likelihood ratio.  The
models are trained from labelled samples.  Column expressions and aggregations
only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larch.llm.common import text_or_empty, let
from larch.llm.spans import matches, of_kind

BASE_KINDS = ("assign", "access", "hex")
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
SIZE = len(ALPHABET) + 1  # class 0: any other character
#: About so many documents give the ordinary identifiers.
SAMPLE_DOCS = 20_000
#: Strength, in transitions, of the order-zero distribution within a row.
PRIOR_WEIGHT = 20.0
MIN_LENGTH = 20


def base_spans(text: Column) -> Column:
    """``array<struct<kind, start, end, score>>`` of the base patterns, ordered
    by start, then by kind as listed.

    An assignment needs a value of 12 or more characters.  A shorter one is
    dropped after the search, so its text is not searched again.
    """
    assign = matches(text, ASSIGN, text.rlike(r"(?i:password|passwd|secret|token|api_?key)"),
                     value_group=1)
    access = matches(text, ACCESS, text.contains("AKIA"))
    # A maximal run of hexadecimal characters: 16 or more of it make a match.
    hexes = matches(text, HEX, text.rlike(HEX))
    every = F.concat(
        of_kind("assign", assign, keep=lambda m: F.length(m["value"]) >= 12),
        of_kind("access", access, keep=lambda m: F.length(m["value"]) >= 18),
        of_kind("hex", hexes))
    return by_start(every)


def by_start(spans: Column) -> Column:
    """Spans ordered by start, then by kind (base kinds as listed, then others)."""
    rank = lambda s: (F.when(s["kind"] == "assign", 0).when(s["kind"] == "access", 1)
                      .when(s["kind"] == "hex", 2).otherwise(3))
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), rank(s).alias("rank"), s["kind"].alias("kind"),
        s["end"].alias("end"), s["score"].alias("score")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        s["score"].alias("score")))


def _classes(string: Column) -> Column:
    """Character classes of a string, with the class 0 before its first one."""
    return F.concat(F.array(F.lit(0)), F.transform(
        F.split(string, ""), lambda c: F.position(c, F.lit(ALPHABET))))


def labelled_samples(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``(random boolean, sample string)``: values that the base patterns name in
    any document are random strings; words of letters and joining signs of about
    ``sample_docs`` documents, chosen by a hash of their id, are ordinary identifiers.
    """
    total = docs.count()
    share = 1.0 if total <= sample_docs else sample_docs / total
    chosen = docs.where(
        F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("secrets")), F.lit(1_000_000))
        < F.lit(math.ceil(share * 1_000_000))).select(text_or_empty(text_col).alias("t"))
    text = F.col("t")
    rlike = text.rlike(r"(?i:password|passwd|secret|token|api_?key)")
    values = F.concat(
        F.transform(matches(text, ASSIGN, rlike, value_group=1), lambda m: m["value"]),
        F.transform(matches(text, ACCESS, text.contains("AKIA")), lambda m: m["value"]))
    secret = docs.select(text_or_empty(text_col).alias("t")).select(F.explode(values).alias("sample")).where(F.length("sample") >= 12)
    plain = (chosen.select(F.explode(F.split(text, r"[^A-Za-z_.-]+")).alias("sample"))
             .where(F.length("sample").between(4, 64)))
    return (secret.select(F.lit(True).alias("random"), "sample")
            .unionAll(plain.select(F.lit(False).alias("random"), "sample")))


def train(samples: DataFrame, prior_weight: float = PRIOR_WEIGHT) -> list[float] | None:
    """Log-likelihood ratios (random against ordinary) of every transition
    between two character classes, as ``SIZE * SIZE`` numbers; None when either
    label has no sample.

    Only the transition counts, at most ``2 * SIZE * SIZE`` rows, come to the
    driver.  Rows are smoothed towards the label's order-zero distribution.
    """
    cls = _classes(F.col("sample"))
    pairs = samples.select("random", F.explode(let(cls, lambda c: F.zip_with(
        F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1),
        lambda a, b: a * SIZE + b))).alias("pair"))
    counts = {True: [0.0] * SIZE * SIZE, False: [0.0] * SIZE * SIZE}
    for row in pairs.groupBy("random", "pair").count().collect():
        counts[row["random"]][row["pair"]] = float(row["count"])
    if not any(counts[True]) or not any(counts[False]):
        return None
    logs = {}
    for label, c in counts.items():
        ends = [sum(c[a * SIZE + b] for a in range(SIZE)) + 0.5 for b in range(SIZE)]
        total = sum(ends)
        logs[label] = []
        for a in range(SIZE):
            row = c[a * SIZE:(a + 1) * SIZE]
            n = sum(row) + prior_weight
            logs[label] += [math.log((row[b] + prior_weight * ends[b] / total) / n)
                            for b in range(SIZE)]
    return [round(r - o, 4) for r, o in zip(logs[True], logs[False])]


def ratio(string: Column, model: list[float]) -> Column:
    """Sum of the log-likelihood ratios of the transitions in ``string``."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    return F.aggregate(
        _classes(string),
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(c.alias("last"), F.when(
            acc["last"] < 0, 0.0).otherwise(
                acc["sum"] + F.get(table, acc["last"] * SIZE + c)).alias("sum")),
        lambda acc: acc["sum"])


def find_secrets(docs: DataFrame, model: list[float] | None, text_col: str = "text",
                 min_length: int = MIN_LENGTH, per_char: float = 0.5) -> DataFrame:
    """Adds ``base`` and ``secrets``: ``array<struct<kind, start, end, score>>``
    per row, ordered by start, then kind.

    ``base`` holds the spans of the base patterns; ``secrets`` holds these and,
    as kind ``markov``, every run of at least ``min_length`` token characters
    that overlaps no base span and whose log-likelihood ratio is at least
    ``per_char`` per character.  Without a model nothing is added.

    Null and empty texts get empty arrays.  Repeated rows, extra columns and
    null keys pass through unchanged.  An empty table gives an empty result.
    """
    text = text_or_empty(text_col)
    with_base = docs.withColumn("base", base_spans(text))
    if model is None:
        return with_base.withColumn("secrets", F.col("base"))
    run = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+" % min_length
    found = matches(text, run, text.rlike("[A-Za-z0-9+/_=-]{%d}" % min_length))
    free = F.filter(found, lambda m: ~F.exists(F.col("base"), lambda b: (
        b["start"] < m["end"]) & (m["start"] < b["end"])))
    scored = F.transform(free, lambda m: F.struct(
        F.lit("markov").alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
        (ratio(m["value"], model) / F.length(m["value"])).alias("score")))
    added = F.filter(scored, lambda s: s["score"] >= per_char)
    return with_base.withColumn("secrets", by_start(F.concat(F.col("base"), added)))

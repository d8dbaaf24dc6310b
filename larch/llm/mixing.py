"""Soft-membership mixing: a classifier learnt from a labelled table predicts
domain posteriors, and projected-gradient least squares fits nonnegative
document rates whose expected domain token totals match targets.  DataFrame
operations only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larch.llm.common import text_or_empty, let, written

BUCKETS = 16_384
#: About so many labelled documents of each domain are learnt from.
SAMPLE_DOCS = 4000
SMOOTHING = 0.5
#: A text counts as evidence of at most so many words, which keeps memberships soft.
EVIDENCE_WORDS = 30
#: Largest error of a domain's token share.  Where targets are out of reach, the
#: fit ends when ``KEPT_STEPS`` steps take less than this share off the error.
TOLERANCE = 1e-4
LEAST_GAIN = 0.05
#: Table of the classifier's domains for the tables at hand.
DOMAIN_TARGETS = {"high": 0.80, "low": 0.13, "toxic": 0.07}
#: Steps folded per pass before the documents' state is written.
KEPT_STEPS = 16
_SPACE = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    log_prior: tuple[float, ...]
    #: Per domain but the first: log-likelihood ratios of the word buckets.
    ratios: tuple[tuple[float, ...], ...]


def label_domain() -> Column:
    """Domain of a row of the labels table; null without a quality label."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(
        F.col("quality") == 0, "low")


def _words(text: Column) -> Column:
    return F.split(F.btrim(text, F.lit(_SPACE)), r"[ \t-\r]+")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def learn(docs: DataFrame, labels: DataFrame, domain: Column, id_col: str = "doc_id",
          text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Classifier:
    """Naive Bayes over hashed words from about ``sample_docs`` labelled
    documents of each domain, chosen by a hash of their id; the priors come from
    all labels.  Only domain counts and at most ``BUCKETS`` counts per domain
    come to the driver.  Several labels of a document: the largest name counts.
    """
    known = labels.select(F.col(id_col).alias("_id"), domain.alias("_domain")).where(
        F.col("_id").isNotNull() & F.col("_domain").isNotNull()).groupBy("_id").agg(
        F.max("_domain").alias("_domain"))
    sizes = {r["_domain"]: r["count"] for r in known.groupBy("_domain").count().collect()}
    names = sorted(sizes)
    if not names:
        return Classifier((), (), ())
    point = F.pmod(F.xxhash64("_id", F.lit("mixing")), F.lit(1_000_000))
    share = F.lit(0)
    for name in names:
        share = F.when(F.col("_domain") == name, math.ceil(1e6 * sample_docs / sizes[name])).otherwise(share)
    # About sample_docs ids and names per domain: a proven bound.
    chosen = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")).join(
        F.broadcast(known.where(point < share)), "_id")
    buckets = chosen.select("_domain", F.explode(_words(F.col("_text"))).alias("w")).where(
        "w <> ''").select("_domain", _bucket(F.col("w")).alias("b"))
    counts = {n: [0] * BUCKETS for n in names}
    for r in buckets.groupBy("_domain", "b").count().collect():
        counts[r["_domain"]][r["b"]] = r["count"]
    logs = {n: [math.log((c + SMOOTHING) / (sum(counts[n]) + SMOOTHING * BUCKETS)) for c in counts[n]]
            for n in names}
    total = sum(sizes.values())
    return Classifier(
        tuple(names), tuple(math.log(sizes[n] / total) for n in names),
        tuple(tuple(round(a - b, 5) for a, b in zip(logs[n], logs[names[0]])) for n in names[1:]))


def with_posteriors(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """Adds ``n_tokens`` (words between white space) and ``posterior``, one
    probability per domain of the model."""
    if not model.domains:
        words = F.size(F.filter(_words(text_or_empty(text_col)), lambda w: w != ""))
        return docs.withColumn("n_tokens", words.cast("long")).withColumn(
            "posterior", F.array().cast("array<double>"))

    def told(buckets: Column) -> Column:
        n = F.size(buckets)
        part = F.least(n, F.lit(EVIDENCE_WORDS)) / F.greatest(n, F.lit(1))
        scores = [F.lit(model.log_prior[0])]
        for prior, ratios in zip(model.log_prior[1:], model.ratios):
            table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
            total = F.aggregate(buckets, F.lit(0.0), lambda acc, b: acc + F.get(table, b))
            scores.append(F.lit(prior) + part * total)

        def normal(s: Column) -> Column:
            top = F.array_max(s)
            weights = F.transform(s, lambda x: F.exp(x - top))
            return let(weights, lambda w: let(
                F.aggregate(w, F.lit(0.0), lambda a, x: a + x),
                lambda z: F.transform(w, lambda x: x / z)))
        return F.struct(n.cast("long").alias("n"), let(F.array(*scores), normal).alias("p"))

    words = _words(text_or_empty(text_col))
    buckets = let(words, lambda ws: F.when(F.get(ws, F.lit(0)) == "", F.array().cast("array<int>"))
                  .otherwise(F.transform(ws, _bucket)))
    return docs.withColumn("_told", let(buckets, told)).withColumn(
        "n_tokens", F.col("_told.n")).withColumn("posterior", F.col("_told.p")).drop("_told")


@dataclass
class Fit:
    """Steps of the fit: the rate of a document is a function of its posterior."""

    domains: tuple[str, ...]
    targets: list[float]
    totals: list[float]
    steps: list[tuple]

    def rate(self) -> Column:
        return folded(self.steps, F.lit(1.0), F.lit(1.0))["x"]


def folded(steps: list[tuple], x: Column, y: Column) -> Column:
    """Rate ``x`` and extrapolated rate ``y`` of a row after more steps."""
    start = F.struct(x.alias("x"), y.alias("y"))
    if not steps:
        return start
    listed = F.array(*[F.struct(F.array(*map(F.lit, g)).alias("g"), F.lit(b).alias("b"))
                       for g, b in steps])

    def move(acc: Column, step: Column) -> Column:
        slope = F.aggregate(F.zip_with(step["g"], F.col("posterior"), lambda g, p: g * p),
                            F.lit(0.0), lambda a, v: a + v)
        new = F.greatest(F.lit(0.0), acc["y"] - slope)
        return let(new, lambda v: F.struct(
            v.alias("x"), (v + step["b"] * (v - acc["x"])).alias("y")))
    return F.aggregate(listed, start, move)


def inverse(rows: list[list[float]]) -> list[list[float]]:
    """Inverse of a small positive matrix, held away from singular."""
    k = range(len(rows))
    lift = 1e-6 * sum(rows[i][i] for i in k) + 1e-12
    m = [[rows[i][j] + (lift if i == j else 0.0) for j in k] + [float(i == j) for j in k] for i in k]
    for i in k:
        pivot = max(range(i, len(rows)), key=lambda r: abs(m[r][i]))
        m[i], m[pivot] = m[pivot], m[i]
        m[i] = [v / m[i][i] for v in m[i]]
        for r in k:
            if r != i:
                m[r] = [v - m[r][i] * u for v, u in zip(m[r], m[i])]
    return [row[len(rows):] for row in m]


def fit_rates(told: DataFrame, domains: tuple[str, ...], targets: dict[str, float]) -> Fit:
    """Nonnegative rates, starting from one, that bring each domain's expected
    token total (rate x tokens x posterior, summed) to its target share of all
    tokens; targets of domains that the classifier lacks are left out and the
    others scaled.

    The squares of the residual shares are weighted by the inverse of the
    domains' token-weighted second moments, so that all directions close at one
    pace.  Accelerated projected gradient steps are scaled by a document's
    tokens: its step is the weighted residuals' product with its posterior.  The
    driver keeps those few numbers of each step, and a rate is their fold.  Each
    step is one aggregation; the state is written every ``KEPT_STEPS`` steps.

    Ends within ``TOLERANCE`` of every target, or, when no rates reach the
    targets, once ``KEPT_STEPS`` steps gain less than ``LEAST_GAIN``.
    """
    wanted = [max(0.0, targets.get(d, 0.0)) for d in domains]
    share = [w / sum(wanted) for w in wanted] if sum(wanted) > 0 else []
    fit = Fit(domains, share, [], [])
    k = range(len(domains))
    first = told.agg(F.sum("n_tokens"), *[F.sum(
        F.col("n_tokens") * F.col("posterior")[i] * F.col("posterior")[j]) for i in k for j in k]).first()
    mass = first[0]
    if not mass or not share:
        return fit
    weight = inverse([[first[1 + i * len(domains) + j] / mass for j in k] for i in k])
    at = told.select("n_tokens", "posterior", F.lit(1.0).alias("x"), F.lit(1.0).alias("y"))
    new: list[tuple] = []
    momentum, last_error, block_error = 1.0, math.inf, math.inf
    while True:
        sums = at.select("n_tokens", "posterior", folded(new, F.col("x"), F.col("y")).alias("s")).agg(*[
            F.sum(F.col(f"s.{c}") * F.col("n_tokens") * F.col("posterior")[i])
            for c in "xy" for i in k]).first()
        fit.totals = [sums[i] for i in k]
        error = [sums[i] / mass - share[i] for i in k]
        ahead = [sums[len(domains) + i] / mass - share[i] for i in k]
        worst = sum(error[i] * weight[i][j] * error[j] for i in k for j in k)
        if max(map(abs, error)) <= TOLERANCE:
            return fit
        if len(new) == KEPT_STEPS:
            if worst > (1 - LEAST_GAIN) * block_error:
                return fit
            block_error = worst
            at = written(at.select("n_tokens", "posterior", folded(
                new, F.col("x"), F.col("y")).alias("s")).select(
                "n_tokens", "posterior", "s.x", "s.y"), "rates")
            new = []
        if worst > last_error:
            momentum = 1.0  # the last step went too far: start the acceleration again
        last_error = worst
        after = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        step = ([sum(weight[i][j] * ahead[j] for j in k) for i in k], (momentum - 1) / after)
        new.append(step)
        fit.steps.append(step)
        momentum = after


def copies(rate: Column, id_col: str = "doc_id") -> Column:
    """Whole copies with the rate as their mean over documents: the fraction is
    settled by a hash of the id, so a re-run gives the same."""
    point = F.pmod(F.xxhash64(F.col(id_col), F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (point < rate - F.floor(rate)).cast("int")).cast("int")


def mixed(docs: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float],
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` drawn by the fitted rates, columns as before: a row comes as many
    times as :func:`copies` says, so a rate over one repeats rows and a rate
    under one leaves some out.  Without labelled documents every rate is one."""
    model = learn(docs, labels, domain, id_col, text_col)
    named = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(docs.columns)])
    told = written(with_posteriors(named, model, f"_{docs.columns.index(text_col)}"), "mixing")
    fit = fit_rates(told, model.domains, targets)
    times = copies(fit.rate(), f"_{docs.columns.index(id_col)}")
    drawn = told.withColumn("_times", times).where("_times > 0").withColumn(
        "_nth", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return drawn.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])

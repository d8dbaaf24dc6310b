"""Compression-distance classification of toxic text.

Two zstandard dictionaries, one for toxic and one for ordinary text, compress
every window of a text; the difference of the two lengths is the window's gain.
Windows are words.  Each byte is spelled as a fixed random code of three bytes
first, so that a compressed length counts the phrases that a dictionary needs
for the window: with plain bytes a frame of one word is too short to shrink.

zstandard's own trainer picks segments by frequency alone, which common words
dominate (measured on labelled documents: area under the curve about 0.7).  So
a dictionary's content is chosen by document frequency: the words most frequent
in the sample, shared by both, then the words over-represented in its class.

Calibration: a logistic model over the document's largest gains and over the
shares of windows beyond gain thresholds, fitted on labelled documents that the
dictionaries have not seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larch.llm.common import text_or_empty, written

#: About so many labelled documents of each class are used for fitting; three
#: in five choose the dictionaries, the others calibrate.
SAMPLE_DOCS = 5000
COMMON_WORDS = 1000
#: A class word is in at least this share of the class's documents and this
#: many of them, and so many times likelier than in the other class.
CLASS_SHARE = 0.02
CLASS_LEAST = 8
CLASS_RATIO = 8.0
CLASS_WORDS = 4000
MAX_WORD_BYTES = 64
CODE_BYTES = 3
LEVEL = 9
GAIN_STEPS = (8, 11, 14)
CACHE_WORDS = 400_000


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    mean: tuple
    scale: tuple
    weights: tuple
    constant: float | None = None  # without labels of both classes


def _spelled(data: bytes) -> bytes:
    return _CODE[np.frombuffer(data, np.uint8)].tobytes()


_CODE = np.random.default_rng(5).integers(0, 256, (256, CODE_BYTES), dtype=np.uint8)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    words = zstandard.ZstdCompressionDict(_spelled(content),
                                          dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


class Gains:
    """Gain of every window, remembered per word within one task."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)
        self.known: dict[bytes, int] = {}

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        known = self.known
        new = [w for w in set(words) if w not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = list(set(words))
        for at in range(0, len(new), 10_000):
            part = new[at:at + 10_000]
            spelled = [_spelled(b" " + w + b" ") for w in part]
            for w, gain in zip(part, self._lengths(self.ordinary, spelled)
                               - self._lengths(self.toxic, spelled)):
                known[w] = int(gain)
        return np.fromiter((known[w] for w in words), np.int64, len(words))

    @staticmethod
    def _lengths(compressor, windows: list[bytes]) -> np.ndarray:
        frames = compressor.multi_compress_to_buffer(windows, threads=1)
        return np.fromiter((len(frames[i]) for i in range(len(frames))), np.int64, len(frames))


def features(gains: np.ndarray) -> list[float]:
    """Largest gains, windows beyond each threshold, mean gain and length."""
    if len(gains) == 0:
        gains = np.zeros(1, np.int64)
    top = np.sort(gains)[::-1].astype(float)
    row = [top[0], top[:3].mean(), top[:6].mean(), top[:12].mean()]
    for step in GAIN_STEPS:
        n = int((gains >= step).sum())
        row += [math.log1p(n), n / len(gains)]
    return row + [float(gains.mean()), math.log(len(gains))]


def _logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 1e-4):
    """Newton steps for a ridge-penalised logistic model on scaled features."""
    mean, scale = rows.mean(0), rows.std(0) + 1e-9
    x = np.c_[(rows - mean) / scale, np.ones(len(rows))]
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - labels) + ridge * len(x) * w
        hess = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * len(x) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Dictionaries and calibration from labelled documents that are not held
    out: about ``sample_docs`` of each class, chosen by a hash of their id.  Repeated
    texts count once.

    Without labelled documents of both classes every text gets the same score:
    1 when only toxic ones are known, else 0.
    """
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id"))
             .agg((F.max(label_col) == 1).alias("_toxic")).where(~held_out("_id")))
    counts = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}
    if not counts.get(True) or not counts.get(False):
        return Model(b"", b"", (), (), (), 1.0 if counts.get(True) else 0.0)
    point = F.pmod(F.xxhash64(F.col("_id"), F.lit("toxicity")), F.lit(1_000_000))
    chosen = known.where(F.when(
        F.col("_toxic"), point < math.ceil(1e6 * sample_docs / counts[True]))
        .otherwise(point < math.ceil(1e6 * sample_docs / counts[False])))
    # About two times sample_docs rows of an id and a flag: a proven bound.  Equal
    # texts are one row, toxic if any of them is, whose part follows from the text
    # alone: the model does not depend on the order of rows.
    sample = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")).join(
        F.broadcast(chosen), "_id").groupBy("_text").agg(F.max("_toxic").alias("_toxic"))
    sample = sample.withColumn("_fit", F.pmod(F.xxhash64("_text", F.lit("part")), F.lit(5)) < 3)
    return _fit(written(sample, "toxicity-sample"))


def _fit(sample: DataFrame) -> Model:
    fitting = sample.where("_fit")
    n = {r["_toxic"]: r["count"] for r in fitting.groupBy("_toxic").count().collect()}
    if not n.get(True) or not n.get(False):
        return Model(b"", b"", (), (), (), 0.0)
    lowered = F.translate("_text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = (fitting.select("_toxic", F.explode(F.array_distinct(
        F.split(lowered, r"[ \t-\r]+"))).alias("word"))
        .where((F.octet_length("word") > 0) & (F.octet_length("word") <= MAX_WORD_BYTES))
        .groupBy("word").agg(F.count_if("_toxic").alias("t"), F.count_if(~F.col("_toxic")).alias("o")))
    share = {k: F.col(c) for k, c in ((True, "t"), (False, "o"))}

    def class_words(label: bool) -> list[bytes]:
        rate = lambda k: (share[k] + 0.5) / (n[k] + 1)
        least = max(CLASS_LEAST, CLASS_SHARE * n[label])
        top = (words.where((share[label] >= least) & (F.length("word") >= 3)
                           & (rate(label) >= CLASS_RATIO * rate(not label)))
               .orderBy(share[label].desc(), "word").limit(CLASS_WORDS).collect())
        return [r["word"].encode() for r in reversed(top)]

    common = [r["word"].encode() for r in reversed(
        words.orderBy(F.col("o").desc(), "word").limit(COMMON_WORDS).collect())]
    dictionary = lambda own: b" ".join(common + own) + b" "
    toxic, ordinary = dictionary(class_words(True)), dictionary(class_words(False))
    schema = ", ".join(f"f{i} double" for i in range(6 + 2 * len(GAIN_STEPS)))

    @F.pandas_udf(schema)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        gains = Gains(toxic, ordinary)
        for texts in batches:
            yield pd.DataFrame([features(gains.of(t)) for t in texts],
                               columns=[f"f{i}" for i in range(6 + 2 * len(GAIN_STEPS))])

    # At most about four fifths of sample_docs rows of a few numbers.
    held = sample.where(~F.col("_fit")).select(
        "_toxic", measured(F.col("_text").cast("binary")).alias("f"),
        F.sha2("_text", 256).alias("_order")).orderBy("_order").collect()
    rows, marks = [list(r["f"]) for r in held], [float(r["_toxic"]) for r in held]
    if len(set(marks)) < 2:
        return Model(toxic, ordinary, (), (), (), float(marks[0]) if marks else 0.0)
    mean, scale, w = _logistic(np.array(rows), np.array(marks))
    return Model(toxic, ordinary, tuple(mean), tuple(scale), tuple(w))


def with_scores(docs: DataFrame, model: Model, text_col: str = "text",
                out_col: str = "score") -> DataFrame:
    """Adds the toxicity score (0 to 1) of every whole text.

    Null and empty texts have one window of gain zero and get that score.
    Repeated rows get equal scores; extra columns pass through; an empty table
    gives an empty result.
    """
    if model.constant is not None:
        return docs.withColumn(out_col, F.lit(model.constant))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        gains = Gains(model.toxic, model.ordinary)
        mean, scale, w = (np.array(v) for v in (model.mean, model.scale, model.weights))
        for texts in batches:
            rows = np.array([features(gains.of(t)) for t in texts]).reshape(len(texts), len(mean))
            z = np.c_[(rows - mean) / scale, np.ones(len(rows))] @ w
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.withColumn(out_col, score(text_or_empty(text_col).cast("binary")))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` less the rows with a score of at least ``threshold``."""
    model = fit(docs, labels, id_col, text_col)
    named = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(docs.columns)])
    scored = with_scores(named, model, f"_{docs.columns.index(text_col)}", "_score")
    return scored.where(F.col("_score") < threshold).select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])

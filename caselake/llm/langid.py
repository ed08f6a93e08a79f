"""Language identification with averaged subword embeddings and a linear softmax."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

# Subwords are runs of two and three letters, hashed to this many embeddings.
BUCKET_BITS, WIDTH = 15, 16
# Bound of what is learned from: documents of each language, chosen by hash. A share of them calibrates.
PER_LANGUAGE, CALIBRATION = 600, 5
# Languages that can be learned, the most frequent ones.
MOST_LANGUAGES = 1000
EPOCHS, RATE = 6, 40.0
# At most this share of the calibration documents may be rejected, and never one more probable than not.
REJECTED_SHARE, SUREST_REJECTED = 0.001, 0.5
UNKNOWN = "und"
_SPACE = np.uint32(32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def subwords(text: str | None) -> np.ndarray | None:
    """Bucket numbers of all subwords of the whole text; None without a letter. Other characters count as spaces."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return None
    points = np.concatenate([[_SPACE], np.where(letter, points, _SPACE), [_SPACE]]).astype(np.uint32)
    letter = np.concatenate([[False], letter, [False]])
    pairs = points[:-1] * np.uint32(0x9E3779B1) + points[1:] * np.uint32(0x85EBCA77)
    triples = pairs[:-1] * np.uint32(0xC2B2AE3D) + points[2:] * np.uint32(0x27D4EB2F)
    pairs = pairs[letter[:-1] | letter[1:]]
    triples = triples[letter[1:-1]]
    mixed = np.concatenate([pairs, triples])
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKET_BITS)


@dataclass
class LanguageModel:
    """``table`` holds each bucket's share in the scores: its embedding times the softmax weights."""

    languages: list[str]
    table: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def scores(self, buckets: np.ndarray) -> np.ndarray:
        return self.table.take(buckets, axis=0).mean(axis=0, dtype=float)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The most probable language and its calibrated probability; ``und`` and 0 without a letter."""
        buckets = subwords(text) if self.languages else None
        if buckets is None:
            return UNKNOWN, 0.0
        p = _softmax(self.scores(buckets) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def learnable(doc_id: Column) -> Column:
    """Whether a row may be learned from: the checksum of its id, as text, is not a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def fit(docs: DataFrame) -> LanguageModel:
    """A model of the languages in ``docs`` (``doc_id, text, lang``), by stochastic gradient descent in numpy.

    Learns from whole texts of at most ``PER_LANGUAGE`` rows of each non-null
    language, those of about the least id hashes that :func:`learnable` allows. Tasks
    turn texts into subword counts; only those reach the driver. Without such
    rows the model knows no language. Of more than ``MOST_LANGUAGES`` languages
    the most frequent are learned; documents of the others still get a prediction.
    """
    usable = docs.filter(learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    told = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    shares = {row["lang"]: min(1.0, 2 * PER_LANGUAGE / row["n"]) for row in told.limit(MOST_LANGUAGES).collect()}
    if not shares:
        return _fit_rows(pd.DataFrame(columns=["lang", "nth", "buckets", "times"]))
    # Few rows more than wanted pass this filter, however many there are; the exact choice is among them.
    at = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.from_json(F.lit(json.dumps(shares)), "map<string,double>"), F.col("lang"))
    near = usable.select("lang", "text", at.alias("at"), F.xxhash64("text").alias("then")).filter(F.col("at") < share)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("at", "then"))
    drawn = near.withColumn("nth", place).filter(F.col("nth") <= PER_LANGUAGE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(subwords(t), return_counts=True) for t in batch.column("text").to_pylist()]
            lists = [pa.array([x[i] for x in found], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("nth"), *lists], names=names)

    names = ["lang", "nth", "buckets", "times"]
    schema = "lang string, nth int, buckets array<int>, times array<int>"
    rows = drawn.select("lang", "nth", "text").mapInArrow(count, schema).toPandas()
    return _fit_rows(rows.sort_values(["nth", "lang"], ignore_index=True))


def _fit_rows(rows: pd.DataFrame) -> LanguageModel:
    languages = sorted(set(rows["lang"]))
    if not languages:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 0), np.float32))
    rng = np.random.default_rng(7)
    embedding = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BUCKET_BITS, WIDTH))
    weights = np.zeros((WIDTH, len(languages)))
    truth = np.array([languages.index(name) for name in rows["lang"]])
    held = rows["nth"].to_numpy() % CALIBRATION == 0
    shares = [t / t.sum() for t in rows["times"].map(np.asarray)]
    buckets = list(rows["buckets"].map(np.asarray))
    learned = np.flatnonzero(~held)
    total, done = EPOCHS * len(learned), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(learned):
            rate = RATE * (1 - done / total)
            at, share = buckets[i], shares[i]
            mean = share @ embedding[at]
            miss = -_softmax(mean @ weights)
            miss[truth[i]] += 1
            pull = weights @ miss
            weights += rate / 100 * np.outer(mean, miss)
            embedding[at] += rate * share[:, None] * pull
            done += 1
    model = LanguageModel(languages, (embedding @ weights).astype(np.float32))
    checked = np.flatnonzero(held) if held.any() else learned
    scores = np.array([shares[i] @ model.table[buckets[i]] for i in checked], float)
    model.temperature, model.threshold = _calibrated(scores, truth[checked])
    return model


def _calibrated(scores: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """The temperature of least loss on rows not learned from, and the probability below which to reject."""
    rows, n, others = np.arange(len(truth)), len(truth), max(1, scores.shape[1] - 1)

    def loss(t: float) -> float:
        # The truth counts as (n + 1) / (n + 2), so that rows without an error don't ask for certainty.
        logs = np.log(_softmax(scores / t) + 1e-12)
        right = logs[rows, truth]
        return -((n + 1) * right + (logs.sum(axis=1) - right) / others).mean()

    temperature = min(np.geomspace(0.05, 20, 80), key=loss)
    sure = _softmax(scores / temperature).max(axis=1)
    return float(temperature), float(min(SUREST_REJECTED, np.quantile(sure, REJECTED_SHARE)))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``; only ``text`` is looked at.

    Text that is null or has no letter is ``und`` with score 0 and rejected; so
    are texts whose calibrated probability is below the model's threshold,
    though these keep the most probable language. Columns of these three names
    are replaced, others passed on. Rows are independent. Texts are read whole,
    one after the other, however long.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
    kept = [f for f in docs.schema.fields if f.name not in {a.name for a in added}]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        for batch in batches:
            found = [m.predict(text) for text in batch.column("text").to_pylist()]
            named = [name for name, _ in found]
            scores = [score for _, score in found]
            refused = [name == UNKNOWN or score < m.threshold for name, score in found]
            columns = [pa.array(named, pa.string()), pa.array(scores, pa.float64()), pa.array(refused, pa.bool_())]
            passed = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(passed + columns, names=[f.name for f in kept + added])

    return docs.mapInArrow(predict, StructType(kept + added))

"""Quality by compression: zstandard dictionaries of good and bad text, and a calibrated difference.

Two dictionaries are trained, one on good and one on bad labelled texts. A text is cut into pieces of
``PIECE`` bytes, all of it, and every piece is compressed with either dictionary. The evidence is

    (bytes with the bad dictionary - bytes with the good one) / (bytes of the text + SMOOTH)

Pieces keep the evidence of a long text from fading as the compressor learns the text itself; SMOOTH
keeps a text of a few bytes near the middle. Logistic calibration on labelled rows that no dictionary
has seen turns the evidence into the probability of label 1, given how much text there is: its second
input is SMOOTH / (bytes + SMOOTH), so that no evidence from three words is not read as no evidence from a page.

The sample is drawn by class, so the intercept is moved by the classes' true shares among the labels.

The fit uses a bounded sample of labelled rows: at most ``per_class`` rows for each label and purpose,
the first in the order of a hash of the id, of texts up to ``max_chars`` code points. Only the chosen
ids (4 x per_class rows) are broadcast, so fitting is one scan of the texts without a shuffle. Scoring is
a map over Arrow batches.

Cases: ids with null or contradicting labels are left out of the fit; an id with several texts is fitted
on the smallest; if a class has no usable text, or there are no labels at all, every score is the share of
label 1 (0.5 if unknown); null and empty texts get the score of no evidence; repeated rows are
scored alike; an empty table gives an empty result; columns that are not kept are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.pieces import portions

PIECE = 512
SMOOTH = 64
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    #: Of the evidence, of the shortness of the text, and the intercept.
    weights: tuple[float, float, float]


class Scorer:
    """Evidence and score of single texts; one per task."""

    def __init__(self, model: Model):
        self.model = model
        self.pair = [self._compressor(d) for d in (model.good, model.bad)] if model.good and model.bad else None

    @staticmethod
    def _compressor(data: bytes):
        trained = data[:4] == b"\x37\xa4\x30\xec"  # fixed value: the format's dictionary mark
        kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
        dictionary = zstandard.ZstdCompressionDict(data, dict_type=kind)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    def evidence(self, text: str | None) -> tuple[float, float]:
        """The normalised difference, and the shortness of the text (1 if empty)."""
        data = (text or "").encode("utf-8", "surrogatepass")
        short = SMOOTH / (len(data) + SMOOTH)
        if not self.pair or not data:
            return 0.0, short
        good, bad = self.pair
        gain = 0
        for at in range(0, len(data), PIECE):
            piece = data[at : at + PIECE]
            gain += len(bad(piece)) - len(good(piece))
        return gain / (len(data) + SMOOTH), short

    def score(self, text: str | None) -> float:
        gain, short = self.evidence(text)
        z = self.model.weights[0] * gain + self.model.weights[1] * short + self.model.weights[2]
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def train_dictionary(texts: Iterable[str], size: int) -> bytes:
    """A trained dictionary; of samples too small to train on, their own last bytes."""
    samples = [t.encode("utf-8", "surrogatepass") for t in texts if t]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-size:].rjust(8, b"\n")


def calibrate(evidence: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Weights of a logistic curve over rows of (evidence, shortness), by Newton's method with a weak pull to 0."""
    if len(label) == 0:
        return 0.0, 0.0, 0.0
    scale = np.where(np.std(evidence, axis=0) > 0, np.std(evidence, axis=0), 1.0)
    x = np.column_stack([evidence / scale, np.ones(len(evidence))])
    w = np.zeros(3)
    ridge = np.diag([1e-2] * 3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (label - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale[0]), float(w[1] / scale[1]), float(w[2])


def in_fold(doc_id, fold: int):
    """Whether crc32 of the id as text leaves this remainder by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == fold


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 2000, max_chars: int = 20_000, size: int = 112_640
) -> Model:
    """Learn from labelled rows outside fold 0; fold 1 calibrates, the others train the dictionaries."""
    clean = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(~in_fold(F.col("doc_id"), 0))
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("top"))
        .where("y = top")
        .select("doc_id", "y", in_fold(F.col("doc_id"), 1).alias("calibrates"))
    )
    held = {r["y"]: r["n"] for r in clean.where("calibrates").groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        for purpose in (False, True):
            some = (
                clean.where((F.col("y") == y) & (F.col("calibrates") == purpose))
                .orderBy(F.xxhash64("doc_id"), "doc_id")
                .limit(per_class)
            )
            chosen = some if chosen is None else chosen.unionAll(some)
    texts = (
        docs.select("doc_id", "text")
        .where(F.length("text").between(1, max_chars))
        .join(F.broadcast(chosen), "doc_id")  # 4 * per_class rows at most
        .groupBy("doc_id", "y", "calibrates")
        .agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .collect()
    )
    good, bad = (train_dictionary((r.text for r in texts if r.y == y and not r.calibrates), size) for y in (1, 0))
    rest = [r for r in texts if r.calibrates]
    if not good or not bad:
        share = (sum(r.y for r in texts) + 1) / (len(texts) + 2)
        return Model(b"", b"", (0.0, 0.0, math.log(share / (1 - share))))
    scorer = Scorer(Model(good, bad, (0.0, 0.0, 0.0)))
    evidence = np.array([scorer.evidence(r.text) for r in rest]).reshape(-1, 2)
    gain, short, intercept = calibrate(evidence, np.array([float(r.y) for r in rest]))
    drawn = Counter(r.y for r in rest)
    if drawn[0] and drawn[1]:  # the sample has other shares of the classes than the labels
        intercept += math.log(held[1] / drawn[1]) - math.log(held[0] / drawn[0])
    return Model(good, bad, (gain, short, intercept))


def _scorer(shared) -> Scorer:
    return Scorer(Model(*shared.value))


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.good, model.bad, model.weights))
    rows = docs.select(*(F.col(f"`{k}`").alias(f"k{n}") for n, k in enumerate(keep)), F.col(f"`{text}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared)
        for batch in (p for whole in batches for p in portions(whole, len(keep))):
            scores = pa.array([scorer.score(t) for t in batch.column(len(keep)).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], scores], [*batch.schema.names[: len(keep)], "score"])

    schema = rows.select(*rows.columns[:-1], F.lit(0.0).cast("double").alias("score")).schema
    out = rows.mapInArrow(run, schema)
    return out.select(*(F.col(f"k{n}").alias(k) for n, k in enumerate(keep)), "score")


def filtered(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.good, model.bad, model.weights))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared)
        for batch in (p for whole in batches for p in portions(whole, at)):
            yield batch.filter(pa.array([scorer.score(t) >= threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

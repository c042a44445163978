"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased; every run of characters that are not letters becomes one boundary mark. Its features are
all single letters, pairs and triples of letters and marks (no triple has a mark in its middle, so no feature
crosses words), hashed into ``buckets``. Learning counts (language, bucket) over all documents of the learning
folds: each task folds its documents into one array, and only its non-zero cells are shuffled. The
matrix of log probabilities is broadcast. Scoring takes the features of a batch of texts as one sparse
matrix (text, bucket) and multiplies it with that matrix, as gathers and sums per text in numpy.

The matrix has at most CELLS cells, whatever the data: with more languages there are fewer buckets. A column with so
many values that fewer than 1024 buckets were left is refused, as it doesn't hold languages.

Cases: rows with null text, null language or null id are not learned from; a text that is null or has no letter is
``und`` with score 0, and so is every text if nothing was learned; of equally likely languages the first by
name is taken; repeated rows are scored alike; texts of any length are read whole, piece by piece; an empty table
gives an empty result; columns that are not kept are not read, whatever their names.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.pieces import portions
from reelgauge.llm.tables import numbered, place

UNKNOWN = "und"
#: Most cells of the matrix of log probabilities (8 bytes each).
CELLS = 1 << 22
BUCKETS = 1 << 16
#: Added to every count.
SMOOTH = 0.5
#: Code points that are handled at once.
PIECE = 1 << 17


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: Log probability of each bucket, a row per language.
    table: np.ndarray
    prior: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _codes(text: str) -> np.ndarray:
    """Code points in lower case; 0 for what is not a letter. No letter's code depends on its neighbours."""
    codes = np.frombuffer(text.lower().replace("\u03c2", "\u03c3").encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(_letters()[codes], codes, 0)


def _squeezed(codes: np.ndarray) -> np.ndarray:
    """Which codes stay, when every run of marks is one mark."""
    return np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])


def _grams(codes: np.ndarray, owner: np.ndarray, buckets: int, old: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(owner, bucket) of all features but those within the first ``old`` codes; ``owner`` is the text of each code."""
    c = codes.astype(np.uint64) + np.uint64(1)
    one = codes != 0
    # A feature belongs to the text of its first letter, so marks may belong to any.
    first = np.where(one[:-1], owner[:-1], owner[1:])
    pair = (c[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[1:]) * np.uint64(0x9FB21C651E98DF25)
    triple = ((pair[:-1] ^ (pair[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + c[2:]) * np.uint64(0x94D049BB133111EB)
    one[:old] = False
    inner, begin = codes[1:-1] != 0, max(old - 1, 0)
    rows = [owner[one], first[begin:], first[: len(triple)][inner]]
    hashes = np.concatenate([c[one] * np.uint64(0x9E3779B97F4A7C15), pair[begin:], triple[inner]])
    return np.concatenate(rows), (hashes >> np.uint64(65 - buckets.bit_length())).astype(np.int64)


def features(texts: Sequence[str | None], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the text, bucket) of all features, some at a time. Marks stand before and after every text."""
    mark = np.zeros(1, np.uint32)
    waiting: list[np.ndarray] = []
    owners: list[np.ndarray] = []

    def run() -> tuple[np.ndarray, np.ndarray]:
        codes, owner = np.concatenate(waiting), np.concatenate(owners)
        waiting.clear()
        owners.clear()
        kept = _squeezed(codes)
        return _grams(codes[kept], owner[kept], buckets)

    size = 0
    for at, text in enumerate(t or "" for t in texts):
        if len(text) <= PIECE:
            codes = _codes(text)
            waiting += [mark, codes, mark]
            owners.append(np.full(len(codes) + 2, at, np.int64))
            size += len(codes)
            if size >= PIECE:
                yield run()
                size = 0
            continue
        last = mark
        for begin in range(0, len(text), PIECE):
            codes = np.concatenate([last, _codes(text[begin : begin + PIECE]), mark if begin + PIECE >= len(text) else mark[:0]])
            codes = codes[_squeezed(codes)]
            if len(codes) > 1:
                yield _grams(codes, np.full(len(codes), at, np.int64), buckets, len(last) if begin else 0)
            last = codes[-2:]
    if waiting:
        yield run()


def in_fold(doc_id: Column, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder by 3; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == fold


def fit(docs: DataFrame, held_out: int = 1, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", cells: int = CELLS) -> Model:
    """Learn from all documents outside the held-out fold."""
    base = numbered(docs)
    name, language, whole_text = place(docs, doc_id), place(docs, lang), place(docs, text)
    rows = base.where(whole_text.isNotNull() & language.isNotNull() & ~in_fold(name, held_out)).select(
        language.cast("string").alias("lang"), whole_text.alias("text")
    )
    found = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(cells // 1024 + 1).collect()
    if len(found) * 1024 > cells:
        raise ValueError(f"column {lang} has more than {cells // 1024} values; a language column is expected")
    languages, n = tuple(r.lang for r in found), np.array([r.n for r in found], float)
    if not languages:
        return Model((), np.zeros((0, 1024)), n)
    buckets = min(BUCKETS, 1 << ((cells // len(languages)).bit_length() - 1))
    place_of = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(place_of) * buckets, np.int64)
        for batch in (p for whole in batches for p in portions(whole, 1)):
            codes = np.array([place_of[x] for x in batch.column(0).to_pylist()], np.int64)
            for rows_, bucket in features(batch.column(1).to_pylist(), buckets):
                cell, times = np.unique(codes[rows_] * buckets + bucket, return_counts=True)
                total[cell] += times
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], ["cell", "n"])

    counted = rows.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    seen = counted.toArrow()  # at most ``cells`` rows
    table = np.full(len(languages) * buckets, SMOOTH)
    table[seen.column("cell").to_numpy()] += seen.column("n").to_numpy()
    table = table.reshape(len(languages), buckets)
    return Model(languages, np.log(table / table.sum(axis=1, keepdims=True)), np.log(n / n.sum()))


def likelihoods(texts: Sequence[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log of prior and likelihood (a row per text, a column per language), and how many features each text has."""
    out, n = np.tile(model.prior, (len(texts), 1)), np.zeros(len(texts), np.int64)
    for rows, bucket in features(texts, model.table.shape[1]):
        n += np.bincount(rows, minlength=len(texts))
        for k in range(len(model.languages)):
            out[:, k] += np.bincount(rows, weights=model.table[k][bucket], minlength=len(texts))
    return out, n


def predict(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, ``lang_pred`` and ``score``, the probability of that language by the model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most CELLS cells
    numbers = [f"c{docs.columns.index(k)}" for k in keep]
    rows = numbered(docs).select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(numbers)), place(docs, text).alias("text"))
    schema = rows.drop("text").withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0).cast("double")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in (p for whole in batches for p in portions(whole, len(keep))):
            log, n = likelihoods(batch.column(len(keep)).to_pylist(), known)
            if known.languages and len(log):
                best = log.argmax(axis=1)
                chance = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
                names = [known.languages[b] if c else UNKNOWN for b, c in zip(best.tolist(), n.tolist(), strict=True)]
                chance = np.where(n > 0, chance, 0.0)
            else:
                names, chance = [UNKNOWN] * len(log), np.zeros(len(log))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(names, pa.string()), pa.array(chance, pa.float64())],
                [*batch.schema.names[: len(keep)], "lang_pred", "score"],
            )

    return rows.mapInArrow(run, schema).toDF(*keep, "lang_pred", "score")

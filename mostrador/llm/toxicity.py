"""Toxicity by multiple-instance learning: documents carry labels, sentences get scores.

A sentence's score is a logistic function of the words it holds, and a document's is the
noisy-or of its sentences: toxic if at least one of them is. Only document labels are
given; the likelihood of the noisy-or spreads them over sentences, so the fitted model
also points at the offending ones (``locate``).

The fit uses at most ``max_rows`` labelled rows, chosen by a hash of their ids, and of
their words those in ``least_docs`` documents or more, at most ``max_words``. Scoring
covers every sentence of every text.

Edge cases: null and empty texts have no sentence that could offend and score 0. Rows
without a label, or with a null label, teach nothing. Without any labelled row, or with
labels of one kind only, the score is that label's rate (0 if there is none) for every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 10_000
MAX_WORDS = 60_000
LEAST_DOCS = 5
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_STEPS = 80
_RATE = 0.15
_L1 = 2e-5
_CAP = 12.0


@dataclass(frozen=True)
class ToxicityModel:
    bias: float
    weights: dict[str, float]
    #: The score of every text where nothing could be learnt.
    constant: float | None = None


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-z))


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence, in characters."""
    return [m.span() for m in _SENTENCE.finditer(text)]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """``doc_id, text, y`` of at most ``max_rows`` labelled rows, in order of a hash of the id."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y"))
    chosen = known.orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), "doc_id").limit(max_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The chosen ids are at most max_rows, whatever the size of the corpus.
    return texts.join(F.broadcast(chosen), "doc_id")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    max_rows: int = MAX_ROWS,
    max_words: int = MAX_WORDS,
    least_docs: int = LEAST_DOCS,
) -> ToxicityModel:
    sample = training_rows(docs, labels, label, max_rows)

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = sorted(set(_WORD.findall(text.lower())))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y] * len(found), pa.int32())], ["word", "y"])

    seen = sample.select("text", F.col("y").cast("int")).mapInArrow(words_of, "word string, y int")
    counted = seen.groupBy("word").agg(F.count("*").alias("docs"), F.sum("y").alias("toxic_docs"))
    kept = counted.where(F.col("docs") >= least_docs).orderBy(F.col("docs").desc(), "word").limit(max_words).collect()
    words = {row["word"]: k for k, row in enumerate(kept)}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, sizes = [], []
                for sentence in _SENTENCE.findall(text.lower()):
                    own = {words[w] for w in _WORD.findall(sentence) if w in words}
                    codes += sorted(own)
                    sizes.append(len(own))
                rows.append({"y": y, "codes": np.array(codes, "<i4").tobytes(), "sizes": np.array(sizes, "<i4").tobytes()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("y", pa.int32()), ("codes", pa.binary()), ("sizes", pa.binary())]))

    rows = sample.select("text", F.col("y").cast("int")).mapInArrow(coded, "y int, codes binary, sizes binary").collect()
    y = np.array([r["y"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(0.0, {}, float(y.mean()) if len(y) else 0.0)
    sizes = [np.frombuffer(r["sizes"], "<i4") for r in rows]
    codes = np.concatenate([np.frombuffer(r["codes"], "<i4") for r in rows])
    del rows
    bias, weights = _descend(
        y,
        codes,
        np.concatenate(sizes),
        np.array([len(s) for s in sizes]),
        np.array([r["docs"] for r in kept], np.float64),
        np.array([r["toxic_docs"] for r in kept], np.float64),
    )
    return ToxicityModel(bias, {w: float(weights[k]) for w, k in words.items() if abs(weights[k]) > 0.05})


def _descend(
    y: np.ndarray, codes: np.ndarray, sizes: np.ndarray, sentences: np.ndarray, docs: np.ndarray, toxic_docs: np.ndarray
) -> tuple[float, np.ndarray]:
    """Bias and word weights that make the document labels likely under the noisy-or."""
    sentence_of = np.repeat(np.arange(len(sizes)), sizes)
    doc_of = np.repeat(np.arange(len(sentences)), sentences)
    rate = y.mean()
    # Start from how much more often a word stands in toxic documents, where that is beyond chance.
    odds = np.log((toxic_docs + 0.5) / (docs - toxic_docs + 0.5)) - np.log(rate / (1 - rate))
    surprise = (toxic_docs - rate * docs) / np.sqrt(docs * rate * (1 - rate) + 1e-9)
    weights = np.where(surprise > 4, np.clip(3 * odds, 0, 6), 0.0)
    bias = float(np.log(rate / max(1.0, len(sizes) / len(y))) - 2)
    m, v = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    for step in range(1, _STEPS + 1):
        z = bias + np.bincount(sentence_of, weights[codes], len(sizes))
        p = _sigmoid(z)
        none = np.bincount(doc_of, -np.logaddexp(0, z), len(y))  # log of: no sentence is toxic
        some = np.clip(-np.expm1(none), 1e-3, 1.0)
        per_doc = np.where(y == 1, -(1 - some) / some, 1.0) / len(y)
        slope = p * per_doc[doc_of]
        gradient = np.append(np.bincount(codes, slope[sentence_of], len(weights)), slope.sum())
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        rate_now = _RATE * min(1.0, 2 * (1 - step / (_STEPS + 1)))
        move = rate_now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        weights = weights - move[:-1]
        # Shrink towards none, so that words without evidence have no weight.
        shrink = rate_now * _L1 / (np.sqrt(v[:-1] / (1 - 0.99**step)) + 1e-6)
        weights = np.clip(np.sign(weights) * np.maximum(np.abs(weights) - shrink, 0.0), -_CAP, _CAP)
        bias -= float(move[-1])
    return bias, weights


class Scorer:
    def __init__(self, model: ToxicityModel) -> None:
        self._model = model
        self._quiet = float(np.logaddexp(0, model.bias))

    def sentences(self, text: str) -> list[float]:
        """The score of each sentence."""
        weights, bias = self._model.weights, self._model.bias
        out = []
        for sentence in _SENTENCE.findall(text.lower()):
            own = sum(weights[w] for w in set(_WORD.findall(sentence)) if w in weights)
            out.append(float(_sigmoid(np.float64(bias + own))))
        return out

    def document(self, text: str | None) -> float:
        """The noisy-or of the sentences' scores."""
        if self._model.constant is not None:
            return self._model.constant
        if not text:
            return 0.0
        weights, bias = self._model.weights, self._model.bias
        folded = text.lower()
        found = set(_WORD.findall(folded))
        if found.isdisjoint(weights):
            return -float(np.expm1(-self._quiet * len(_SENTENCE.findall(folded))))
        total = 0.0
        for sentence in _SENTENCE.findall(folded):
            here = weights.keys() & set(_WORD.findall(sentence))
            total += float(np.logaddexp(0, bias + sum(sorted(weights[w] for w in here)))) if here else self._quiet
        return -float(np.expm1(-total))


def score(text: Column, model: ToxicityModel) -> Column:
    """The probability that a text is toxic."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for batch in batches:
            yield pa.array([scorer.document(t) for t in batch.to_pylist()], pa.float64())

    return scored(text)


def locate(docs: DataFrame, model: ToxicityModel, least: float = 0.5) -> DataFrame:
    """``doc_id, sentence, start, end, score, text`` of each sentence that scores ``least`` or more."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1).to_pylist()):
                for k, ((start, end), value) in enumerate(zip(sentence_spans(text or ""), scorer.sentences(text or ""))):
                    if value >= least:
                        rows.append((doc.as_py(), k, start, end, value, text[start:end]))
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = [batch.column(0).type, pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.string()]
            names = ["doc_id", "sentence", "start", "end", "score", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    schema = f"doc_id {key}, sentence int, start int, end int, score double, text string"
    return docs.select("doc_id", "text").mapInArrow(found, schema)

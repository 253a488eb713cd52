"""Text quality by compression: how much better does a dictionary of good text fit than one of bad text?

Two zstandard dictionaries are built, from good and from bad labelled text. A text is cut
into blocks of ``BLOCK`` bytes, so that it cannot hide behind its own repetitions, and each
block is compressed with either dictionary. The difference of the sizes over the length is
the text's margin; a logistic curve fitted on labelled rows that built no dictionary turns
margins into calibrated scores. The length takes part in the curve, as short texts have
noisier margins, and so does the share of bytes left, as little is left of spam.

The fit uses at most ``max_rows`` labelled rows of each kind, chosen by a hash of their ids:
half of them for the dictionaries, with at most ``sample_bytes`` bytes of each, in blocks that a
hash chooses from all over the text, and half for the curve, whole. Scoring covers every byte of every text.

Edge cases: null and empty texts have margin 0 and length 0 and get the curve's value there.
Without labels of both kinds the score is the rate of good ones (1 if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 4_000
SAMPLE_BYTES = 8_192
DICTIONARY_BYTES = 64 << 10
BLOCK = 1_024
LEVEL = 3
_SPLIT_SEED = 23


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    #: Coefficients of the curve: constant, margin, worst margin, share left by the better dictionary, log length.
    curve: tuple[float, ...]
    constant: float | None = None


def build_dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the plain texts where there are too few to train one."""
    blocks = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-size:] or b"\n"


def sampled_blocks(data: bytes, sample_bytes: int) -> bytes:
    """The data, or as many of its blocks as ``sample_bytes`` hold, at least one, chosen by a hash; in their order."""
    if len(data) <= sample_bytes:
        return data
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    hashed = sorted(range(len(blocks)), key=lambda k: (xxhash.xxh3_64_intdigest(blocks[k], seed=k), k))
    return b"".join(blocks[k] for k in sorted(hashed[: max(1, sample_bytes // BLOCK)]))


def sample(text: Column, sample_bytes: int) -> Column:
    """``sampled_blocks`` of each text."""

    @F.arrow_udf("binary")
    def taken(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([sampled_blocks(t or b"", sample_bytes) for t in batch.to_pylist()], pa.binary())

    return taken(text.cast("binary"))


class Margins:
    """Compressed-size differences under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self._pair = [self._compressor(d) for d in (good, bad)]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        trained = content[:4] == b"\x37\xa4\x30\xec"
        kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
        held = zstandard.ZstdCompressionDict(content, dict_type=kind)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    def of(self, text: str | None) -> tuple[float, float, float, float]:
        """Margin of the whole text and of its worst block, the share of bytes left, and the logarithm of its length."""
        data = (text or "").encode()
        if not data:
            return 0.0, 0.0, 1.0, 0.0
        with_good, with_bad = self._pair
        total, left, worst = 0, 0, 9.0
        for i in range(0, len(data), BLOCK):
            block = data[i : i + BLOCK]
            bad, good = len(with_bad.compress(block)), len(with_good.compress(block))
            gain = bad - good
            total += gain
            left += min(bad, good)
            # A short last block says little.
            worst = min(worst, gain / max(len(block), BLOCK // 2))
        return total / len(data), worst, left / len(data), float(np.log1p(len(data)))


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """``doc_id, text, y, half`` of at most ``max_rows`` labelled rows of each kind."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y"))
    mixed = F.xxhash64(F.col("doc_id").cast("string"), F.lit(_SPLIT_SEED))
    halves = [known.where(F.col("y") == y).orderBy(mixed, "doc_id").limit(max_rows) for y in (0, 1)]
    chosen = halves[0].unionByName(halves[1]).withColumn("half", F.pmod(mixed, F.lit(2)))
    # At most 2 * max_rows ids, whatever the size of the corpus.
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS, sample_bytes: int = SAMPLE_BYTES
) -> QualityModel:
    rows = labelled(docs, labels, label, max_rows)
    built = rows.where(F.col("half") == 0).select("y", sample(F.col("text"), sample_bytes).alias("text"), "doc_id").collect()
    built.sort(key=lambda r: r["doc_id"])
    texts = {y: [bytes(r["text"]) for r in built if r["y"] == y and r["text"]] for y in (0, 1)}
    shares = {r["y"]: r["n"] for r in labels.where(F.col(label).isin(0, 1)).groupBy(F.col(label).alias("y")).agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    rate = shares.get(1, 0) / total if total else 1.0
    if not texts[0] or not texts[1]:
        return QualityModel(b"", b"", (), rate)
    good, bad = build_dictionary(texts[1]), build_dictionary(texts[0])
    margins = rows.where(F.col("half") == 1).select("y", margin(F.col("text"), good, bad).alias("m")).select("y", "m.*").collect()
    y = np.array([r["y"] for r in margins], np.float64)
    if not len(y) or y.min() == y.max():
        return QualityModel(good, bad, (), rate)
    x = np.array([(r["margin"], r["worst"], r["left"], r["length"]) for r in margins])
    # Kinds are taken in equal numbers; weights bring back their shares among the labels.
    weight = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
    return QualityModel(good, bad, tuple(_logistic(x, y, weight)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    """Newton's method for a slightly ridged logistic curve; coefficients for unscaled columns."""
    middle, spread = x.mean(0), np.maximum(x.std(0), 1e-9)
    design = np.column_stack([np.ones(len(x)), (x - middle) / spread])
    ridge = np.diag([0.0, *[1e-3 * len(x)] * x.shape[1]])
    beta = np.zeros(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - ridge @ beta
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge + 1e-9 * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    scaled = beta[1:] / spread
    return [float(beta[0] - scaled @ middle), *map(float, scaled)]


def margin(text: Column, good: bytes, bad: bytes) -> Column:
    """``struct<margin, worst, left, length>`` of each whole text."""

    @F.arrow_udf("struct<margin: double, worst: double, left: double, length: double>")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        margins = Margins(good, bad)
        for batch in batches:
            found = np.array([margins.of(t) for t in batch.to_pylist()], np.float64).reshape(-1, 4)
            yield pa.StructArray.from_arrays([pa.array(c) for c in found.T], ["margin", "worst", "left", "length"])

    return measured(text)


def score(text: Column, model: QualityModel) -> Column:
    """The calibrated probability that a text is good."""
    if not model.curve:
        return F.lit(model.constant)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        margins, curve = Margins(model.good, model.bad), np.array(model.curve)
        for batch in batches:
            found = np.array([margins.of(t) for t in batch.to_pylist()], np.float64).reshape(-1, 4)
            yield pa.array(1 / (1 + np.exp(-np.clip(curve[0] + found @ curve[1:], -30, 30))))

    return scored(text)

"""Quality by compression: zstandard dictionaries of good and of bad text.

Text is cut into blocks, and each block is compressed once with the dictionary
built from good rows and once with the one built from bad rows. What reads like
a dictionary's rows compresses better with it; the difference of the two sizes
over their sum, over all blocks of a text, is calibrated to a score. Text that
repeats itself compresses to almost nothing with either, so that the difference
says little; the compressed share of the text is the second calibrated number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.base import corpus_query, shared, table
from panelwright.llm.sampling import held_out, labelled_sample

FOLDS, FOLD = 5, 0  # crc32 of the id mod 5 is 0: held out
THRESHOLD = 0.3

# The bounded sample that is fitted on: rows of each class, and characters of a
# row. Scores cover all rows and whole texts.
ROWS_PER_CLASS, LONGEST_ROW = 2500, 20_000
CALIBRATION_SHARE = 3  # one of so many sampled rows calibrates

BLOCK = 2048  # bytes compressed at a time, so that a dictionary weighs the same in texts of any length
DICTIONARY, LEVEL = 256 << 10, 3
SAMPLE_BYTES = 8 << 20  # of each class, for a dictionary


def blocks(text: str) -> list[bytes]:
    data = text.encode("utf-8", "replace")
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def dictionary(texts: Sequence[str]) -> bytes:
    """A dictionary of at most DICTIONARY bytes, an eighth of what is there."""
    parts = [b for t in texts for b in blocks(t)]
    size = sum(map(len, parts))
    step = max(1, -(-size // SAMPLE_BYTES))
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(512, size // 8)), parts[::step], level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        # Too little text to train on: the text itself is the dictionary.
        return b"".join(parts)[-DICTIONARY:]


class Compression:
    """The two dictionaries and the calibration; some 500 KB."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.good, self.bad = good, bad
        self.slopes, self.shift, self.prior = np.zeros(2), 0.0, 0.5

    def measures(self, texts: Sequence[str]) -> np.ndarray:
        """Per text (bad - good) / (bad + good) of the compressed sizes, and the
        logarithm of their mean share of the text; NaN for an empty text."""
        good, bad = (self._compressor(d) for d in (self.good, self.bad))
        out = np.full((len(texts), 2), np.nan)
        for i, text in enumerate(texts):
            size = with_good = with_bad = 0
            for block in blocks(text):
                size += len(block)
                with_good += len(good(block))
                with_bad += len(bad(block))
            if size:
                both = with_bad + with_good
                out[i] = (with_bad - with_good) / both, np.log(both / (2 * size))
        return out

    @staticmethod
    def _compressor(data: bytes):
        known = zstandard.ZstdCompressionDict(data)
        known.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        logit = self.measures(texts) @ self.slopes + self.shift
        known = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        return np.where(np.isnan(logit), self.prior, known)

    def calibrate(self, texts: Sequence[str], good: np.ndarray, weight: np.ndarray) -> None:
        """Logistic fit of the label on the measures, with smoothed targets."""
        x = self.measures(texts)
        kept = ~np.isnan(x[:, 0])
        x, y, w = x[kept], good[kept], weight[kept]
        self.prior = float((weight * good).sum() / weight.sum())
        ones, zeros = w[y == 1].sum(), w[y == 0].sum()
        target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        scale = np.maximum(1e-6, x.std(axis=0))
        design = np.column_stack([x / scale, np.ones(len(x))])
        beta, ridge = np.zeros(3), np.diag([1e-3] * 3)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            gradient = design.T @ (w * (p - target)) + ridge @ beta
            curve = (design * (w * p * (1 - p))[:, None]).T @ design + ridge
            step = np.linalg.solve(curve, gradient)
            beta -= step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
            if np.abs(step).max() < 1e-8:
                break
        self.slopes, self.shift = beta[:2] / scale, float(beta[2])


def fit_quality(docs: DataFrame, labels: DataFrame) -> Compression | None:
    """Dictionaries and calibration from a bounded sample of labelled rows that
    are not held out: at most 2 * ROWS_PER_CLASS rows of LONGEST_ROW characters
    reach the driver. None without rows of both classes."""
    sample, sizes = labelled_sample(docs, labels, "quality", FOLDS, FOLD, ROWS_PER_CLASS, LONGEST_ROW)
    rows = sorted(
        (r["doc_id"], r["text"], r["label"])
        for r in sample.where("text is not null").select("doc_id", "text", "label").collect()
    )
    texts, good = [r[1] for r in rows], np.array([r[2] for r in rows], np.int64)
    if len(np.unique(good)) < 2:
        return None
    apart = np.zeros(len(rows), bool)
    for value in (0, 1):
        apart[np.flatnonzero(good == value)[CALIBRATION_SHARE - 1 :: CALIBRATION_SHARE]] = True
    if len(np.unique(good[apart])) < 2:
        apart[:] = True
    train = ~apart if len(np.unique(good[~apart])) == 2 else apart
    model = Compression(
        *(dictionary([texts[i] for i in np.flatnonzero(train & (good == value))]) for value in (1, 0))
    )
    # Weighted as often as the classes occur among all labelled rows.
    share = np.array([sizes[v] / (good[apart] == v).sum() for v in (0, 1)])
    weight = share[good[apart]] * apart.sum() / sum(sizes.values())
    model.calibrate([texts[i] for i in np.flatnonzero(apart)], good[apart], weight)
    return model


def score(spark: SparkSession, fitted: Compression | None, text: Column) -> Column:
    """Score of the whole text; an empty or null text gets the share of good
    rows, and without a model every text gets 1."""
    if fitted is None:
        return F.lit(1.0)
    read = shared(spark, fitted)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = read()
        for batch in batches:
            yield pd.Series(model.scores(batch.fillna("").tolist()))

    return of(text)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score >= 0.3).

    Labels are learnt outside the held-out fold only; the score comes from the
    text alone. Rows that repeat get the same score; an empty table gives an
    empty result; other columns are not read."""
    return docs.select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
        score(docs.sparkSession, fit_quality(docs, labels), F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


@corpus_query("op9_quality")
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))

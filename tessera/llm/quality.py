"""Quality classifier from compression: which dictionary, good or bad, shortens a text more."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import check_columns, col

# Texts are compressed in parts of this many bytes, each with the dictionary
# anew, so the dictionary counts as much late in a long text as at its start.
PART_BYTES = 512
LEVEL = 3


@dataclass(frozen=True)
class Sample:
    """Bounds of the labelled sample that the classifier is fitted on, in the driver.

    Ids are taken in the order of their hash: up to ``dictionary_rows`` of each
    label for its dictionary, then up to ``calibration_rows`` others of either
    label for the calibration. A text of more than ``max_bytes`` is never
    taken; one that would bring its part of the sample above that is left out,
    and the texts after it are not.
    """

    dictionary_rows: int = 1500
    calibration_rows: int = 4000
    max_bytes: int = 16 << 20
    dictionary_bytes: int = 112_640


def _parts(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[at : at + PART_BYTES] for at in range(0, len(raw), PART_BYTES)]


def build_dictionary(texts: Sequence[str], size: int) -> bytes:
    """A zstandard dictionary of at most ``size`` bytes; of few texts, their own bytes."""
    import zstandard

    parts = [p for t in texts for p in _parts(t)]
    if not parts:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, parts)) // 8)), parts).as_bytes()
    except zstandard.ZstdError:  # too few or too small samples to train on
        return b"".join(parts)[:size]


@dataclass(frozen=True)
class Model:
    """Two dictionaries and a logistic calibration of the normalised size difference."""

    good: bytes
    bad: bytes
    intercept: float = 0.0
    slope: float = 0.0
    _compressors: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_compressors": []}

    def difference(self, text: str | None) -> float:
        """(bad size - good size) over their sum: above 0 where the good dictionary fits."""
        import zstandard

        if not self._compressors:
            for raw in (self.good, self.bad):
                words = zstandard.ZstdCompressionDict(raw) if raw else None
                self._compressors.append(
                    zstandard.ZstdCompressor(
                        level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False
                    )
                )
        good, bad = self._compressors
        parts = _parts(text)
        if not parts:
            return 0.0
        g = sum(len(good.compress(p)) for p in parts)
        b = sum(len(bad.compress(p)) for p in parts)
        return (b - g) / (b + g)

    def score(self, text: str | None) -> float:
        z = self.intercept + self.slope * self.difference(text)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))

    def score_column(self, text: Column) -> Column:
        model = self

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            return pd.Series([model.score(t) for t in texts], dtype="float64")

        return score(text)


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> tuple[float, float]:
    """Intercept and slope of a lightly penalised logistic regression, by Newton's method."""
    scale = float(np.std(x)) or 1.0
    design = np.column_stack([np.ones(len(x)), x / scale])
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - ridge * len(x) * np.array([0, beta[1]])
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * len(x) * np.diag([1e-6, 1])
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1] / scale)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learnt from: crc32 of the id's text is divisible by 5; so are null ids."""
    return F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: Sample = Sample()) -> Model:
    """Fit on a bounded sample of labelled rows that are not held out.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1); other values and null
    ids are not learnt from, and of an id with both labels the lower holds.
    An id that several rows have counts once, with its shortest text (of equally
    long ones that of the least hash). Only ids, sizes and the chosen texts
    reach the driver, within ``sample``.
    Without rows of both labels every text scores the share of good ones (one
    half if there are none).
    """
    check_columns(docs, ["doc_id", "text"])
    check_columns(labels, ["doc_id", "quality"])
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    sized = docs.select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"), F.xxhash64("text").alias("hash")
    )
    drawn = (
        sized.drop("text")
        .join(known, "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min(F.struct("bytes", "hash")).alias("text"))
        .select("doc_id", "quality", "text.*")
        .filter(F.col("bytes") <= sample.max_bytes)
        .withColumn("draw", F.xxhash64("doc_id"))
    )
    ranked = {
        q: drawn.filter(F.col("quality") == q).orderBy("draw", "doc_id").limit(sample.dictionary_rows).toPandas()
        for q in (0, 1)
    }
    rest = sample.calibration_rows + 2 * sample.dictionary_rows
    mixed = drawn.orderBy("draw", "doc_id").limit(rest).toPandas()

    def within(rows: pd.DataFrame) -> pd.DataFrame:
        left, kept = sample.max_bytes, []
        for size in rows["bytes"]:
            kept.append(size <= left)
            left -= size if kept[-1] else 0
        return rows[np.array(kept, bool)]

    # Half of a scarce label's rows stay for the calibration.
    short = {q: ranked[q].head(max(1, min(len(ranked[q]), int(drawn_rows(mixed, q) // 2) or 1))) for q in (0, 1)}
    used = {q: within(short[q]) for q in (0, 1)}
    taken = pd.concat([used[0]["doc_id"], used[1]["doc_id"]])
    other = within(mixed[~mixed["doc_id"].isin(taken)].head(sample.calibration_rows))
    chosen = pd.concat([rows.assign(use=use) for use, rows in ((0, used[0]), (1, used[1]), (2, other))])
    wanted = docs.sparkSession.createDataFrame(
        [(r.doc_id, int(r.bytes), int(r.hash), int(r.use)) for r in chosen.itertuples()],
        T.StructType(
            [
                T.StructField("doc_id", docs.schema["doc_id"].dataType),
                T.StructField("bytes", T.IntegerType()),
                T.StructField("hash", T.LongType()),
                T.StructField("use", T.IntegerType()),
            ]
        ),
    )
    texts = (
        sized
        .join(F.broadcast(wanted), ["doc_id", "bytes", "hash"])
        .groupBy("doc_id", "use")
        .agg(F.min("text").alias("text"))
        .toPandas()
    )
    texts = texts.sort_values(["use", "doc_id"]).merge(
        pd.concat([ranked[0], ranked[1], mixed])[["doc_id", "quality"]].drop_duplicates("doc_id"), on="doc_id"
    )
    bad, good = (texts.loc[texts["use"] == q, "text"].tolist() for q in (0, 1))
    if not bad or not good:
        share = float(mixed["quality"].mean()) if len(mixed) else 0.5
        return Model(b"", b"", float(np.log((share + 1e-3) / (1 - share + 1e-3))), 0.0)
    model = Model(build_dictionary(good, sample.dictionary_bytes), build_dictionary(bad, sample.dictionary_bytes))
    check = texts[texts["use"] == 2]
    if check["quality"].nunique() < 2:
        check = texts
    x = np.array([model.difference(t) for t in check["text"]])
    return Model(model.good, model.bad, *calibrate(x, check["quality"].to_numpy(float)))


def drawn_rows(mixed: pd.DataFrame, quality: int) -> int:
    """Labelled rows of one label in the sample as a whole."""
    return int((mixed["quality"] == quality).sum())


def predicted(score: Column, threshold: float) -> Column:
    return (score >= threshold).cast("int")

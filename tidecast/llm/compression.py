"""Text quality from how much better good text's dictionary compresses it than bad text's.

Two zstandard dictionaries are built from a bounded sample of labelled texts. A text's compressed
sizes under both give a normalised difference; a logistic curve, fitted on other labelled texts,
turns it into the chance of label 1. The curve also sees how well the text compresses at all and
how long it is, since the same difference means less in a short or a repetitive text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import ROWS_AT_ONCE, crc_mod, named
from tidecast.session import bounded_batches

LEVEL = 3


@lru_cache(maxsize=4)
def _coders(good: bytes, bad: bytes) -> tuple:
    import zstandard

    out = []
    for data in (good, bad):
        dictionary = zstandard.ZstdCompressionDict(data)
        dictionary.precompute_compress(level=LEVEL)
        out.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return tuple(out)


def features(texts: list[bytes], good: bytes, bad: bytes):
    """Per text: size difference by length and by compressed size, size under ``good`` by length, log length."""
    import numpy as np

    by_good, by_bad = _coders(good, bad)
    n = np.array([len(x) for x in texts], float)
    a = np.array([len(by_good.compress(x)) for x in texts], float)
    b = np.array([len(by_bad.compress(x)) for x in texts], float)
    return np.stack([(b - a) / (n + 1), (b - a) / (a + b + 1), a / (n + 1), np.log(n + 2)], axis=1)


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and calibration; ``weights`` is empty where there was only one label to learn."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]
    constant: float

    def score_texts(self, texts: list[bytes]) -> list[float]:
        import numpy as np

        if not self.weights or not texts:
            return [self.constant] * len(texts)
        x = (features(texts, self.good, self.bad) - np.array(self.mean)) / np.array(self.spread)
        z = np.clip(self.weights[0] + x @ np.array(self.weights[1:]), -500, 500)
        return (1 / (1 + np.exp(-z))).tolist()

    def score(self, text: Column) -> Column:
        """The chance of label 1 of each text; null counts as empty."""
        model = self

        def scored(batches):
            import pyarrow as pa

            for batch in batches:
                parts = (batch.slice(at, ROWS_AT_ONCE).cast(pa.binary()) for at in range(0, len(batch), ROWS_AT_ONCE))
                scores = [x for part in parts for x in model.score_texts([x or b"" for x in part.to_pylist()])]
                yield pa.array(scores, pa.float64())

        return F.arrow_udf(scored, "double", F.ArrowUDFType.SCALAR_ITER)(text)


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; of the texts' own bytes where they are too few to train."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-size:] or b"\n"


def _fit_curve(x, y, rounds: int = 40, ridge: float = 1e-2):
    """Weights of a logistic curve by Newton's method, the constant first."""
    import numpy as np

    z = np.c_[np.ones(len(x)), x]
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6

    def loss(w) -> float:
        m = z @ w
        return float(np.sum(np.logaddexp(0, m) - np.asarray(y) * m) + w @ penalty @ w / 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        hessian = (z.T * np.maximum(p * (1 - p), 1e-9)) @ z + penalty
        step, t = np.linalg.solve(hessian, z.T @ (np.asarray(y) - p) - penalty @ w), 1.0
        while loss(w + t * step) > loss(w) and t > 1e-6:
            t /= 2
        w = w + t * step
    return w


def fit_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_label: int = 1500, calibration: int = 3000, dictionary_bytes: int = 65_536, text_bytes: int = 65_536,
) -> QualityModel:
    """A model from labelled rows whose crc32(key) mod 4 is not 2.

    Remainders 0 and 1 serve the dictionaries (at most ``per_label`` texts of each label), remainder
    3 the calibration (at most ``calibration`` texts); both take the smallest hashes of the keys.
    Texts over ``text_bytes`` are not learnt from, so at most (2 * per_label + calibration) *
    text_bytes bytes reach the driver. Keys with several labels count as the smallest; null keys
    and labels are left out. With one label only, or none, the score is that label's smoothed share.
    """
    fold = crc_mod(named(key), 4)
    known = (
        labels.where(named(key).isNotNull() & named(label).isNotNull())
        .groupBy(named(key).alias("labelled"))
        .agg(F.min(named(label)).cast("int").alias("label"))
        .withColumn("fold", crc_mod(F.col("labelled"), 4))
        .where("fold <> 2")
        .withColumn("order", F.md5(F.col("labelled").cast("string").cast("binary")))
    )
    taught = [known.where(f"fold < 2 AND label = {v}").orderBy("order").limit(per_label) for v in (0, 1)]
    drawn = taught[0].union(taught[1]).union(known.where("fold = 3").orderBy("order").limit(calibration))
    # at most 2 * per_label + calibration keys, so that sending them to every task is bounded
    texts = docs.where(fold != 2).select(named(key).alias("key"), named(text).alias("text"))
    rows = (
        texts.join(F.broadcast(drawn), F.col("key") == F.col("labelled"))
        .where(F.octet_length(F.coalesce("text", F.lit(""))) <= text_bytes)
        .groupBy("labelled")
        .agg(F.min("label").alias("label"), F.min("fold").alias("fold"), F.min("order").alias("order"), F.min("text").alias("text"))
        .select("label", "fold", "order", "text")
        .collect()
    )
    rows = sorted(((r.order, r.fold, r.label, (r.text or "").encode()) for r in rows), key=lambda r: r[0])
    good, bad = ([t for _, f, v, t in rows if f < 2 and v == k and t] for k in (1, 0))
    judged = [(t, v) for _, f, v, t in rows if f == 3]
    ones = sum(v for _, _, v, _ in rows)
    constant = (ones + 1) / (len(rows) + 2)
    if not good or not bad or len({v for _, v in judged}) < 2:
        return QualityModel(b"", b"", (), (), (), constant)
    kept = [_dictionary(x, dictionary_bytes) for x in (good, bad)]
    x = features([t for t, _ in judged], *kept)
    mean, spread = x.mean(0), x.std(0) + 1e-9
    weights = _fit_curve((x - mean) / spread, [float(v) for _, v in judged])
    return QualityModel(*kept, tuple(mean.tolist()), tuple(spread.tolist()), tuple(weights.tolist()), constant)


def score_quality(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and score of every row, repeated rows too; an empty table gives no rows."""
    bounded_batches(docs.sparkSession)
    return docs.select(named(key).alias(key), model.score(named(text)).alias("score"))


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", least: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with their columns."""
    bounded_batches(docs.sparkSession)
    return docs.where(model.score(named(text)) >= least)

"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on toxic text, of which the
words that ordinary text has as well are left out. Each window of ``WINDOW_WORDS`` words is
compressed twice, with the ordinary dictionary alone and with the toxic one before it; the
bytes saved are its distance. A document is scored from its windows' distances: how many reach
a calibrated threshold, their mean, maximum and scaled sum, by logistic regression on labelled
rows that no dictionary has seen.

Learning uses at most ``LEARN_ORDINARY`` + ``LEARN_TOXIC`` labelled documents of at most
``LEARN_BYTES`` each, picked by hash of the id; scoring reads every document whole.

Defined cases: NULL and empty texts have no windows and get the score of all-zero distances.
Labels that are NULL teach nothing; repeated labels count again. Without labels of both kinds
every score is the share of toxic labels (0 without any). NULL ids are not held out. An empty
table gives no rows. Columns of documents named like a result column are replaced.
"""

from __future__ import annotations

import pickle
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sparktally.llm.common import lean

WINDOW_WORDS = 16
ORDINARY_BYTES = 24_576
TOXIC_BYTES = 1_024
LEARN_ORDINARY = 12_000
LEARN_TOXIC = 4_000
LEARN_BYTES = 200_000
SAMPLE_BYTES = 4 << 20
THRESHOLDS = (2, 3, 4, 5, 6)
# One in so many learning rows is kept from the dictionaries, for calibration.
CALIBRATION = 4
TOXIC_SCORE = 0.3
LETTERS = re.compile(rb"[a-z\x80-\xff]+")


def windows_of(text: str | None, size: int = WINDOW_WORDS) -> Iterator[bytes]:
    words = text.lower().encode().split() if text else []
    return (b" ".join(words[i : i + size]) for i in range(0, len(words), size))


def content_dictionary(samples: list[bytes], size: int, segment: int, step: int) -> bytes:
    """The most useful segments of the samples; the samples themselves if they are too few."""
    whole = b"".join(samples)
    if len(whole) <= size:
        return whole
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=step).as_bytes()[-size:]
    except zstandard.ZstdError:
        return whole[-size:]


def train_dictionaries(ordinary: list[str], toxic: list[str], seed: int = 5) -> tuple[bytes, bytes]:
    common: set[bytes] = set()
    for text in ordinary:
        common.update(LETTERS.findall(text.lower().encode()))
    novel = [
        [w for w in LETTERS.findall(text.lower().encode()) if w not in common] for text in toxic
    ]
    seen = Counter(w for words in novel for w in set(words))
    least = max(3, len(toxic) // 300)
    telling = [[w for w in words if seen[w] >= least] for words in novel]
    if not any(telling):
        telling = novel
    rows = [b" " + b" ".join(words) + b" " for words in telling if words]

    pieces = [w for text in ordinary for w in windows_of(text, 256)]
    random.Random(seed).shuffle(pieces)
    samples, total = [], 0
    for piece in pieces:
        if total > SAMPLE_BYTES:
            break
        samples.append(piece)
        total += len(piece)
    return content_dictionary(samples, ORDINARY_BYTES, 64, 8), content_dictionary(rows, TOXIC_BYTES, 20, 6)


class Distance:
    """Bytes that the toxic dictionary saves on a window."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.plain = self.compressor(ordinary)
        self.both = self.compressor(toxic + ordinary)

    @staticmethod
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters.from_level(
            3,
            window_log=16,
            hash_log=15,
            chain_log=15,
            search_log=3,
            min_match=4,
            strategy=zstandard.STRATEGY_LAZY,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        if not content:
            return zstandard.ZstdCompressor(compression_params=settings)
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=words, compression_params=settings)

    def of(self, text: str | None) -> np.ndarray:
        plain, both = self.plain.compress, self.both.compress
        return np.array([len(plain(w)) - len(both(w)) for w in windows_of(text)], np.float64)


def features(saved: np.ndarray, threshold: int) -> list[float]:
    if not len(saved):
        return [0.0] * 6
    n = len(saved)
    over = (saved >= threshold).mean()
    return [saved.max(), saved.mean(), over, saved.sum() / n**0.5, over * n**0.5, np.log(n)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curve = x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + ridge * np.eye(len(weights))
        weights += np.linalg.solve(curve, x.T @ (y - p) - ridge * weights)
    return weights


def train(rows: list[tuple[str | None, int, bool]]) -> dict:
    """The model from (text, toxic, for calibration) rows."""
    share = float(np.mean([y for _, y, _ in rows])) if rows else 0.0
    texts = {kind: [t or "" for t, y, late in rows if y == kind and not late] for kind in (0, 1)}
    late = [(t, y) for t, y, late in rows if late]
    if not texts[0] or not texts[1] or len({y for _, y in late}) < 2:
        return {"share": share}
    ordinary, toxic = train_dictionaries(texts[0], texts[1])
    distance = Distance(ordinary, toxic)
    saved = [distance.of(t) for t, _ in late]
    y = np.array([y for _, y in late], np.float64)

    def apart(threshold: int) -> float:
        over = np.array([(s >= threshold).mean() if len(s) else 0.0 for s in saved])
        return (over[y == 1].mean() - over[y == 0].mean()) / (over.std() + 1e-9)

    threshold = max(THRESHOLDS, key=apart)
    x = np.array([features(s, threshold) for s in saved])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = fit_logistic(np.c_[np.ones(len(x)), (x - mean) / scale], y)
    return {
        "ordinary": ordinary,
        "toxic": toxic,
        "threshold": threshold,
        "mean": mean,
        "scale": scale,
        "weights": weights,
    }


def learning_rows(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``text``, ``label`` and ``late`` of the bounded sample, from (``id``, ``label``) rows."""
    order = F.xxhash64(F.lit("learn"), F.col("id"))
    kinds = [
        labels.filter(F.col("label") == kind).orderBy(order, "id").limit(most)
        for kind, most in ((0, LEARN_ORDINARY), (1, LEARN_TOXIC))
    ]
    # At most LEARN_ORDINARY + LEARN_TOXIC rows of two numbers.
    sample = F.broadcast(kinds[0].unionByName(kinds[1]))
    late = F.pmod(F.xxhash64(F.lit("late"), F.col("id")), F.lit(CALIBRATION)) == 0
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return (
        rows.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= LEARN_BYTES)
        .join(sample, "id")
        .select("text", F.col("label").cast("int").alias("label"), late.alias("late"))
    )


def fitted_model(rows: DataFrame) -> dict:
    """Trains in one task on the bounded sample; only the model comes to the driver."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [
            row
            for batch in batches
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        ]
        found.sort(key=lambda row: (row[0] or "", row[1]))
        model = pickle.dumps(train(found))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    models = rows.repartition(1).mapInArrow(lean(fit), "model binary").collect()
    return pickle.loads(bytes(models[0].model)) if models else {"share": 0.0}


def score_texts(docs: DataFrame, model: dict, text_column: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of the documents with ``score``."""
    keep = [c for c in keep if c != "score"]
    carried = list(dict.fromkeys([*keep, text_column]))
    schema = StructType([docs.schema[c] for c in keep] + [StructField("score", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model["ordinary"], model["toxic"]) if "weights" in model else None
        for batch in batches:
            names = batch.schema.names
            if distance is None:
                scores = np.full(batch.num_rows, model["share"])
            else:
                texts = batch.column(names.index(text_column))
                x = np.array([features(distance.of(t.as_py()), model["threshold"]) for t in texts])
                x = (x.reshape(-1, 6) - model["mean"]) / model["scale"]
                level = np.c_[np.ones(len(x)), x] @ model["weights"]
                scores = 1 / (1 + np.exp(-np.clip(level, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(names.index(c)) for c in keep], pa.array(scores, pa.float64())],
                names=[*keep, "score"],
            )

    return docs.select(*carried).mapInArrow(lean(score), schema)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL ids get NULL."""
    return F.crc32(key.cast("string")) % folds


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    folds: int = 4,
    held_out: int = 2,
    keep: list[str] | None = None,
) -> DataFrame:
    """The documents with ``held_out``, ``score`` (0 to 1) and ``predicted``.

    ``labels`` has the same id column; rows of the fold ``held_out`` are never learnt from.
    """
    known = labels.filter(
        F.col(label_column).isNotNull() & (fold(F.col(id_column), folds) != held_out)
    ).select(F.col(id_column).alias("id"), F.col(label_column).alias("label"))
    model = fitted_model(learning_rows(docs, known, id_column, text_column))
    keep = [c for c in keep or docs.columns if c not in ("held_out", "score", "predicted")]
    return score_texts(docs, model, text_column, list(dict.fromkeys([id_column, *keep]))).withColumns(
        {
            "held_out": F.coalesce(fold(F.col(id_column), folds) == held_out, F.lit(False)),
            "predicted": (F.col("score") >= TOXIC_SCORE).cast("int"),
        }
    )

"""Quality scores by random Fourier features, ridge regression and isotonic calibration.

Statistics of each whole text are mapped to random Fourier features, which approximate a
Gaussian kernel. Each partition sums its part of the normal equations of the labelled rows;
their sum, of a size fixed by the number of features, is solved on the driver. Scores of
labelled rows kept from the fit are counted in ``BINS`` bins, whose isotonic fit turns a score
into a probability.

Defined cases: NULL and empty texts have all statistics 0. Labels that are NULL teach nothing;
repeated labels count again. Without labels of both kinds every score is the share of labels 1
(0 without any). NULL ids are not held out and not learnt from. An empty table gives no rows.
Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.llm.common import shuffle_partitions, stored
from sparktally.llm.toxicity import fold

FEATURES = 384
WIDTH = 3.0
RIDGE = 1e-3
BINS = 2_000
# One in so many learning rows is kept from the fit, for calibration.
CALIBRATION = 5
# Partial normal equations that are summed, at most.
PARTS = 200
GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\r\n", b".,;:", b"!?", b"#$%&*@^~", b"|/\\<>[]{}()=+_-", b"'\""]
BYTE_GROUPS = np.zeros((len(GROUPS) + 1, 256))
for _row, _bytes in enumerate(GROUPS):
    BYTE_GROUPS[_row, list(_bytes)] = 1
BYTE_GROUPS[-1, 128:] = 1
STATISTICS = len(BYTE_GROUPS) + 11


def statistics(text: str | None) -> list[float]:
    """Shares of kinds of bytes, and how long, varied and repetitive words and lines are."""
    if not text:
        return [0.0] * STATISTICS
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = counts / len(data)
    present = shares[shares > 0]
    words = data.split()
    n = max(1, len(words))
    different = set(words)
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    letters = sum(map(bytes.isalpha, words))
    upper = sum(map(bytes.isupper, words))
    lines = data.split(b"\n")
    return [
        *(BYTE_GROUPS @ shares).tolist(),
        float(np.log1p(len(data))),
        float(np.log1p(n)),
        len(data) / n,
        float(-(present * np.log(present)).sum()),
        len(different) / n,
        sum(map(len, different)) / max(1, len(different)),
        repeated / n,
        letters / n,
        upper / n,
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
    ]


def text_statistics(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id`` and ``x``, the statistics of every document."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"]
            )

    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("t"))
    return rows.mapInArrow(each, "id long, x array<double>")


class Features:
    """Random Fourier features of standardised statistics, with a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, count: int, width: float, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.directions = rng.normal(0, 1 / width, (len(mean), count))
        self.phases = rng.uniform(0, 2 * np.pi, count)

    def of(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.c_[np.ones(len(x)), waves]


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)


def normal_equations(rows: DataFrame, features: Features) -> np.ndarray:
    """The sum of z (z, y) over all rows of ``x`` and ``y``, as one matrix."""
    size = len(features.phases) + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = features.of(matrix(batch.column(0)))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            total += z.T @ np.c_[z, y]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
            names=["place", "sums"],
        )

    def add(group: pa.Table) -> pa.Table:
        sums = group["sums"].combine_chunks().flatten().to_numpy().reshape(-1, size + 1).sum(axis=0)
        return pa.table(
            {"place": group["place"][:1], "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))}
        )

    schema = "place int, sums array<double>"
    parts = min(PARTS, shuffle_partitions(rows.sparkSession))
    partial = rows.select("x", "y").repartition(parts).mapInArrow(part, schema)
    summed = partial.groupBy("place").applyInArrow(add, schema).collect()
    return np.array([row.sums for row in sorted(summed, key=lambda row: row.place)])


def isotonic(bins: np.ndarray, ones: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rising share of ones by bin, by pooling adjacent violators; between bins linear."""
    blocks: list[list[float]] = []  # ones, rows, number of bins
    for one, count in zip(ones, counts, strict=True):
        blocks.append([one, count, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    values = np.concatenate([np.full(int(k), one / rows) for one, rows, k in blocks])
    return np.interp(np.arange(BINS + 1), bins, values)


def score_bin(raw: np.ndarray) -> np.ndarray:
    """Scores from -0.5 to 1.5 in ``BINS`` steps."""
    return np.clip(np.rint((raw + 0.5) / 2 * BINS), 0, BINS).astype(np.int64)


def scored(rows: DataFrame, columns: list[str], features: Features, weights: np.ndarray, curve=None) -> DataFrame:
    """``columns`` of the rows with ``score``: the calibrated one if there is a curve, else its bin."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = score_bin(features.of(matrix(batch.column(len(columns)))) @ weights)
            result = bins.astype(np.float64) if curve is None else curve[bins]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(result, pa.float64())],
                names=[*columns, "score"],
            )

    types = dict(rows.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in columns) + ", score double"
    return rows.select(*columns, "x").mapInArrow(score, schema)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    folds: int = 3,
    held_out: int = 1,
    seed: int = 13,
) -> DataFrame:
    """``id``, ``held_out``, ``score`` and ``predicted`` of every document.

    ``labels`` has the same id column; rows of the fold ``held_out`` are never learnt from.
    """
    rows = stored(text_statistics(docs, id_column, text_column), "statistics")
    known = labels.filter(
        F.col(label_column).isNotNull() & (fold(F.col(id_column), folds) != held_out)
    ).select(F.col(id_column).cast("bigint").alias("id"), F.col(label_column).cast("double").alias("y"))
    late = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(CALIBRATION)) == 0
    learn = stored(rows.join(known, "id").select("x", "y", late.alias("late")), "learning")
    fit, calibrate = learn.filter(~F.col("late")), learn.filter("late")

    numbers = [F.get("x", i) for i in range(STATISTICS)]
    moments = fit.agg(
        F.count("*"),
        F.coalesce(F.avg("y"), F.lit(0.0)),
        *[F.avg(n) for n in numbers],
        *[F.stddev_pop(n) for n in numbers],
    ).first()
    held = F.coalesce(fold(F.col("id"), folds) == held_out, F.lit(False))
    share = moments[1]
    if share in (0.0, 1.0):
        result = rows.select("id", F.lit(share).alias("score"))
    else:
        mean = np.array(moments[2 : 2 + STATISTICS])
        scale = np.array(moments[2 + STATISTICS :]) + 1e-6
        features = Features(mean, scale, FEATURES, WIDTH, seed)
        sums = normal_equations(fit, features)
        penalty = RIDGE * moments[0] / FEATURES * np.eye(len(sums))
        penalty[0, 0] = 0
        weights = np.linalg.solve(sums[:, :-1] + penalty, sums[:, -1])
        # One row per bin, at most BINS + 1.
        counted = scored(calibrate, ["y"], features, weights).groupBy("score").agg(
            F.sum("y"), F.count("*")
        )
        bins = np.array(sorted(tuple(r) for r in counted.collect()), np.float64).reshape(-1, 3)
        if len(bins):
            curve = isotonic(bins[:, 0], bins[:, 1], bins[:, 2])
        else:
            curve = np.clip(np.arange(BINS + 1) * 2 / BINS - 0.5, 0, 1)
        result = scored(rows, ["id"], features, weights, curve)
    return result.select(
        "id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )

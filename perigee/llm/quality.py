"""Quality scores: random Fourier features, ridge by partition-summed normal equations, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import arrow_rows, materialize

#: Partial sums of the normal equations meet in this many rows before the driver adds them up.
SUM_ROWS = 16

#: Raw scores are counted in this many bins for calibration.
BINS = 256

CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\r\n", b"!?", b"|", b"#$%&*@^~", b".,;:")


def _class_of_byte() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.intp)
    table[128:] = len(CLASSES) + 1
    for number, letters in enumerate(CLASSES):
        table[list(letters)] = number
    return table


CLASS_OF_BYTE = _class_of_byte()
N_STATS = len(CLASSES) + 2 + 9


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a whole text: kinds of bytes, lengths, and how often words and lines come again."""
    if not text:
        return [0.0] * N_STATS
    data = np.frombuffer(text, np.uint8)
    kinds = np.add.reduceat(np.bincount(data, minlength=256)[ORDER], STARTS) / len(data)
    words, lines = text.split(), text.split(b"\n")
    n = len(words)
    if not n:
        return [*np.sqrt(kinds), np.log1p(len(data)), *[0.0] * 8]
    counts = Counter(words)
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    return [
        *np.sqrt(kinds),
        np.log1p(len(data)),
        np.log1p(n),
        np.sqrt(sum(map(len, counts)) / len(counts)),
        len(data) / n / 10,
        np.log1p(len(counts)) / np.log1p(n),
        np.sqrt(repeats / n),
        np.sqrt(max(counts.values()) / n),
        np.log1p(len(data) / len(lines)),
        1 - len(set(lines)) / len(lines),
    ]


ORDER = np.argsort(CLASS_OF_BYTE, kind="stable")
STARTS = np.searchsorted(CLASS_OF_BYTE[ORDER], np.arange(len(CLASSES) + 2))


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (a hash of the text) and stats of every row; nothing is shuffled. Empty texts have zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(text) for text in batch["text"].to_pylist()]
            arrays = [batch["doc_id"], batch["text_key"], pa.array(stats, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "stats"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("text"))
    return texts.mapInArrow(run, f"doc_id {df.schema[id_col].dataType.simpleString()}, text_key long, stats array<double>")


@dataclass
class Model:
    """Maps statistics to a calibrated score. Weights are None if there was nothing to learn from."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features, whose products approximate a Gaussian kernel, and a constant."""
        z = np.cos((stats - self.mean) / self.scale @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        """The ridge score."""
        return self.features(stats) @ self.weights if self.weights is not None else np.zeros(len(stats))

    def score(self, stats: np.ndarray) -> np.ndarray:
        """The calibrated score, 0 to 1."""
        if self.values is None:
            return np.clip(self.raw(stats) if self.weights is not None else np.full(len(stats), 0.5), 0, 1)
        return np.interp(self.raw(stats), self.knots, self.values)


def stack(batch: pa.RecordBatch) -> np.ndarray:
    """The stats column of a batch as a matrix."""
    return batch["stats"].flatten().to_numpy().reshape(-1, N_STATS)


def pool_adjacent(good: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The non-decreasing shares nearest to good / rows, weighed by rows."""
    blocks: list[list[float]] = []
    for g, n in zip(good, rows, strict=True):
        blocks.append([g, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g2, n2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g2, blocks[-1][1] + n2, blocks[-1][2] + k2]
    return np.concatenate([[g / n] * k for g, n, k in blocks])


def fit(labelled: DataFrame, features: int, ridge: float, width: float, seed: int) -> Model:
    """Learn from rows of (doc_id, stats, label, calibrate).

    Rows to learn from give each partition's normal equations, which are added up in SUM_ROWS groups and then on the
    driver; the matrix has (features + 1) squared numbers however many rows there are. The other rows calibrate:
    their raw scores are counted in BINS bins, which pooling makes monotonic.
    """
    train, test = labelled.filter("not calibrate"), labelled.filter("calibrate")
    each = [f(F.col("stats")[i]).alias(f"{name}{i}") for i in range(N_STATS) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = train.agg(F.count("*").alias("n"), *each).first()
    rng = np.random.default_rng(seed)
    scale = [row[f"s{i}"] if row["n"] and row[f"s{i}"] > 1e-9 else 1.0 for i in range(N_STATS)]
    model = Model(
        np.array([row[f"m{i}"] or 0.0 for i in range(N_STATS)]),
        np.array(scale),
        rng.normal(size=(N_STATS, features)) / width,
        rng.uniform(0, 2 * np.pi, features),
    )
    if not row["n"]:
        return model
    size = features + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, group = np.zeros((size, size + 1)), None
        for batch in batches:
            if batch.num_rows:
                z = model.features(stack(batch))
                total += z.T @ np.hstack([z, batch["label"].to_numpy()[:, None]])
                group = batch["part"][0].as_py() if group is None else group
        if group is not None:
            arrays = [pa.array([group % SUM_ROWS], pa.int32()), pa.array([group], pa.int32()), pa.array([total.tobytes()])]
            yield pa.RecordBatch.from_arrays(arrays, ["slot", "part", "sums"])

    def add(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("part")
        total = sum(np.frombuffer(x.as_buffer()) for x in parts["sums"])
        return pa.table({"sums": pa.array([total.tobytes()])})

    sums = (
        train.sortWithinPartitions("doc_id", "label", "stats")
        .select("stats", F.col("label").cast("double").alias("label"), F.spark_partition_id().alias("part"))
        .mapInArrow(partial, "slot int, part int, sums binary")
        .groupBy("slot")
        .applyInArrow(add, "sums binary")
        .collect()  # SUM_ROWS rows at most
    )
    total = sum(np.frombuffer(bytes(r["sums"])).reshape(size, size + 1) for r in sums)
    penalty = ridge * row["n"] * np.eye(size)
    penalty[-1, -1] = 0
    model.weights = np.linalg.solve(total[:, :size] + penalty + 1e-9 * np.eye(size), total[:, size])

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(stack(batch)) if batch.num_rows else np.zeros(0)
            at = np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch["label"]], ["bin", "label"])

    counted = test.select("stats", F.col("label").cast("long").alias("label")).mapInArrow(bins, "bin int, label long")
    counted = counted.groupBy("bin").agg(F.count("*").alias("rows"), F.sum("label").alias("good")).collect()  # BINS rows
    if counted:
        counted.sort(key=lambda r: r["bin"])
        good, rows = (np.array([r[c] for r in counted], float) for c in ("good", "rows"))
        model.values = np.clip(pool_adjacent(good, rows), 0, 1)
        model.knots = (np.array([r["bin"] for r in counted]) + 0.5) / BINS * 2 - 0.5
    return model


def score_quality(
    df: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    calibrates: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    features: int = 256,
    ridge: float = 1e-5,
    width: float = 4.0,
    seed: int = 11,
    threshold: float = 0.3,
) -> DataFrame:
    """Score every whole text, 0 to 1, higher where label 1 is likelier.

    may_learn and calibrates are conditions on doc_id. Labels come from `labels` (id_col, label_col of 0 or 1) by id;
    null ids and labels are left out, and an id with several labels counts once, with the largest. All labelled rows
    are learned from. The statistics of each text are computed once and kept in the shared folder.

    Null and empty texts are scored as the empty text. Without labelled rows every score is 0.5. Repeated rows are
    scored each; an empty table gives an empty result; other columns of df are not looked at.

    Returns doc_id, text_key (a hash of the text), score, predicted (1 if score >= threshold, else 0).
    """
    with arrow_rows(df.sparkSession, 512):  # whole texts
        stats = materialize(document_statistics(df, id_col, text_col), "quality-stats")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    labelled = stats.filter(may_learn).join(known, "doc_id").withColumn("calibrate", calibrates)
    labelled = materialize(labelled, "quality-labelled")
    model = fit(labelled, features, ridge, width, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(stack(batch)) if batch.num_rows else np.zeros(0)
            arrays = [batch["doc_id"], batch["text_key"], pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    scored = stats.mapInArrow(run, f"doc_id {kind}, text_key long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

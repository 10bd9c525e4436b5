"""Logistic regression over hashed features, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonlake.llm.common import staged

#: Features of a text: places in the weight vector (distinct) and values.
Features = Callable[[bytes], tuple[np.ndarray, np.ndarray]]


class Ftrl:
    """Per-coordinate FTRL-proximal with L1 and L2 penalties; the last weight is the bias."""

    def __init__(self, size: int, alpha: float, l1: float, l2: float, beta: float = 1.0):
        self.size, self.alpha, self.beta, self.l1, self.l2 = size, alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """One update from one example."""
        at, x = np.append(at, self.size), np.append(x, 1.0)
        w = self.weights(at)
        gradient = (sigmoid(float(w @ x)) - label) * x
        n = self.n[at]
        squared = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(squared) - np.sqrt(n)) / self.alpha * w
        self.n[at] = squared


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, allowed, bound: int) -> DataFrame:
    """(order, text, label, tie) for at most ``bound`` labelled documents, an even draw by hash of the id.

    ``allowed`` is a condition on the id. The ids drawn, at most ``bound``, are broadcast; texts are not shuffled.
    Where an id has several labels, the greatest counts; where several documents have it, all count, in the order of their hashes.
    """
    label_id = F.col(id_col)
    drawn = (
        labels.where(label_id.isNotNull() & F.col(label_col).isNotNull())
        .groupBy(label_id.alias("__id"))
        .agg(F.max(label_col).cast("int").alias("label"))
        .where(allowed(F.col("__id")))
        .withColumn("order", F.xxhash64("__id"))
        .orderBy("order", "__id")
        .limit(bound)
    )
    picked = docs.select(F.col(id_col).alias("__doc"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return picked.join(F.broadcast(staged(drawn, "drawn")), F.col("__doc") == F.col("__id")).select("order", "text", "label", F.xxhash64("text").alias("tie"))


def train(sample: DataFrame, features: Features, size: int, epochs: int, alpha: float, l1: float, l2: float) -> np.ndarray:
    """The weights and the bias. One task makes the updates in turn over the bounded sample; the features are made in parallel."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(1).to_pylist()]
            at = pa.array([a.astype(np.int32) for a, _ in found], pa.list_(pa.int32()))
            x = pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), at, x, batch.column(3)], names=["order", "label", "at", "x", "tie"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rows = Ftrl(size, alpha, l1, l2), []
        for batch in batches:
            label = batch.column(1).to_pylist()
            for k in range(batch.num_rows):
                rows.append((batch.column(2)[k].values.to_numpy(), batch.column(3)[k].values.to_numpy().astype(float), label[k]))
        for _ in range(epochs):
            for at, x, label in rows:
                model.learn(at, x, label)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights(slice(None)).astype("<f4").tobytes()], pa.binary())], names=["weights"])

    made = staged(sample.mapInArrow(extract, "order long, label int, at array<int>, x array<float>, tie long"), "features")
    row = made.repartition(1).sortWithinPartitions("order", "tie").mapInArrow(learn, "weights binary").first()
    return np.frombuffer(row.weights, "<f4") if row else np.zeros(size + 1, "<f4")


def scored(docs: DataFrame, id_col: str, text_col: str, features: Features, weights: np.ndarray) -> DataFrame:
    """``id_col`` and score for every row, by a sparse dot product where the text lies. The broadcast model has a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                at, x = features(text)
                out.append(sigmoid(float(w[at] @ x) + float(w[-1])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["id", "score"])

    return texts.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)

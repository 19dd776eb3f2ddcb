"""Text quality: a small convolutional network over bytes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import freeing, hash_sample, text_slices, texts_of

PAD = 256


@dataclass
class ByteNet:
    """Filters over chunks of 2 * step bytes, one chunk every step bytes, so chunks overlap and cover the text.

    Bytes are embedded, a filter is a linear map of a chunk with a rectifier; each filter keeps its maximum
    over all chunks of a text (and its mean), and a logistic unit turns those into a probability.
    """

    embedding: np.ndarray  # (257, e)
    left: np.ndarray  # (step * e, filters)
    right: np.ndarray
    bias: np.ndarray
    out: np.ndarray  # (2 * filters,)
    out_bias: float
    step: int

    @staticmethod
    def new(step: int = 4, embedding: int = 8, filters: int = 24, seed: int = 7) -> "ByteNet":
        rng = np.random.default_rng(seed)
        scale = 1.5 / np.sqrt(2 * step * embedding)
        weights = [rng.normal(0, s, shape).astype(np.float32) for s, shape in (
            (1.0, (257, embedding)),
            (scale, (step * embedding, filters)),
            (scale, (step * embedding, filters)),
            (0.1, (2 * filters,)),
        )]
        return ByteNet(weights[0], weights[1], weights[2], np.zeros(filters, np.float32), weights[3], 0.0, step)

    def layout(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts padded to whole steps and one step more, first chunk of each text).

        A text of n bytes has max(1, ceil(n / step)) chunks; an empty one is a chunk of padding.
        """
        chunks = np.array([max(1, -(-len(t) // self.step)) + 1 for t in texts])
        starts = np.concatenate(([0], np.cumsum(chunks)))
        codes = np.full(int(starts[-1]) * self.step, PAD, np.int16)
        for t, s in zip(texts, starts[:-1], strict=True):
            codes[s * self.step : s * self.step + len(t)] = np.frombuffer(t, np.uint8)
        return codes, starts

    def activations(self, codes: np.ndarray) -> np.ndarray:
        """(chunks, filters); the chunk at each text's last step is the pad between texts and must not be pooled."""
        blocks = self.embedding[codes].reshape(-1, self.step * self.embedding.shape[1])
        act = blocks @ self.left
        act[:-1] += (blocks @ self.right)[1:]
        return np.maximum(act + self.bias, 0, out=act)

    def pooled(self, act: np.ndarray, starts: np.ndarray) -> np.ndarray:
        act[starts[1:] - 1] = 0
        counts = (np.diff(starts) - 1).astype(np.float32)
        return np.hstack([np.maximum.reduceat(act, starts[:-1]), np.add.reduceat(act, starts[:-1]) / counts[:, None]])

    def scores(self, texts: list[bytes], slice_chunks: int = 100_000) -> np.ndarray:
        """Probability per text. A text longer than a slice is read in overlapping slices, whose pools combine."""
        codes, starts = self.layout(texts)
        if starts[-1] <= slice_chunks or len(texts) > 1:
            pooled = self.pooled(self.activations(codes), starts)
        else:
            n, filters = int(starts[-1]) - 1, len(self.bias)
            most, total = np.zeros(filters, np.float32), np.zeros(filters, np.float64)
            for at in range(0, n, slice_chunks):
                end = min(n, at + slice_chunks)
                act = self.activations(codes[at * self.step : (end + 1) * self.step])[:-1]
                most, total = np.maximum(most, act.max(0)), total + act.sum(0)
            pooled = np.concatenate([most, total / n])[None].astype(np.float32)
        # rounded, as sums in another order differ in their last digits
        return np.round(1 / (1 + np.exp(-np.clip(pooled @ self.out + self.out_bias, -30, 30).astype(np.float64))), 5)

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = 14, batch_bytes: int = 120_000, rate: float = 0.01, seed: int = 3) -> "ByteNet":
        """Adam on the log loss, classes weighted to be equal; gradients flow through each filter's best chunk and its mean."""
        rng = np.random.default_rng(seed)
        names = ["embedding", "left", "right", "bias", "out"]
        moments = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in names}
        bias_moment, step_no = [0.0, 0.0], 0
        share = max(1e-3, min(1 - 1e-3, float(labels.mean())))
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        e, f = self.embedding.shape[1], len(self.bias)
        total = epochs * max(1, sum(map(len, texts)) // batch_bytes)
        for _ in range(epochs):
            order, groups, size = rng.permutation(len(texts)), [[]], 0
            for i in order:
                if groups[-1] and (size + len(texts[i]) > batch_bytes or len(groups[-1]) >= 48):
                    groups.append([])
                    size = 0
                groups[-1].append(int(i))
                size += len(texts[i])
            for group in groups:
                codes, starts = self.layout([texts[i] for i in group])
                act = self.activations(codes)
                pooled = self.pooled(act, starts)
                y, w = labels[group].astype(np.float32), weight[group]
                p = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.out_bias, -30, 30)))
                d = (p - y) * w / len(group)
                grads = {"out": pooled.T @ d + 1e-4 * self.out}
                d_pool = d[:, None] * self.out[None]
                counts = np.diff(starts)
                d_act = np.repeat(d_pool[:, f:] / (counts - 1)[:, None], counts, axis=0) * (act > 0)
                # the best chunk of each filter and text
                best = np.maximum.reduceat(act, starts[:-1])
                for i in range(len(group)):
                    a = act[starts[i] : starts[i + 1]]
                    d_act[starts[i] + a.argmax(0), np.arange(f)] += d_pool[i, :f] * (best[i] > 0)
                d_act[starts[1:] - 1] = 0
                blocks = self.embedding[codes].reshape(-1, self.step * e)
                grads["left"] = blocks.T @ d_act
                grads["right"] = blocks[1:].T @ d_act[:-1]
                grads["bias"] = d_act.sum(0)
                d_blocks = d_act @ self.left.T
                d_blocks[1:] += d_act[:-1] @ self.right.T
                flat = d_blocks.reshape(-1, e)
                grads["embedding"] = np.stack([np.bincount(codes, flat[:, j], 257) for j in range(e)], 1).astype(np.float32)
                step_no += 1
                lr = rate * max(0.1, 1 - step_no / total)
                correct = np.sqrt(1 - 0.999**step_no) / (1 - 0.9**step_no)
                for n in names:
                    m, v = moments[n]
                    m += 0.1 * (grads[n] - m)
                    v += 0.001 * (grads[n] ** 2 - v)
                    getattr(self, n)[...] -= (lr * correct * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
                g = float(d.sum())
                bias_moment[0] += 0.1 * (g - bias_moment[0])
                bias_moment[1] += 0.001 * (g * g - bias_moment[1])
                self.out_bias -= lr * correct * bias_moment[0] / (np.sqrt(bias_moment[1]) + 1e-8)
        return self


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> tuple[list[bytes], np.ndarray]:
    """Whole texts and labels of about ``max_rows`` labelled documents that are not held out, drawn by a hash of doc_id."""
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    found = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(hash_sample(usable, max_rows)), "doc_id")
        .orderBy("doc_id", "text")
        .select("text", "quality")
        .toArrow()
    )
    texts = [t.encode() for t in found.column("text").to_pylist()]
    return texts, np.array(found.column("quality").to_pylist(), np.int64)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 2_500) -> ByteNet:
    """A network fitted on about ``max_rows`` labelled rows (the only bound here; scoring reads every byte).

    Without both labels among them there is nothing to tell apart: every text then scores the share of label
    1, or 1 without any labelled row.
    """
    texts, marks = training_rows(docs, labels, max_rows)
    net = ByteNet.new()
    if len(set(marks.tolist())) < 2:
        net.out[:] = 0
        net.out_bias = -30.0 if len(marks) and marks[0] == 0 else 30.0
        return net
    return net.fit(texts, marks)


def quality_scores(docs: DataFrame, net: ByteNet, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``, from its whole text only.

    Null and empty texts score as a chunk of padding; repeated rows score alike; a null identifier is not held
    out. No rows give no rows; other columns are ignored.
    """
    scored = with_scores(texts_of(docs, id_col, text_col).select("doc_id", "text"), net)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def with_scores(docs: DataFrame, net: ByteNet) -> DataFrame:
    """(doc_id, score) of ``docs`` (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    @freeing
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, last, texts in text_slices(batch, "text", 400_000):
                values = net.scores(texts)
                yield pa.RecordBatch.from_arrays([ids.slice(first, last - first), pa.array(values)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")


def quality_filter(docs: DataFrame, net: ByteNet, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    schema = docs.schema

    @freeing
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.zeros(batch.num_rows, bool)
            for first, last, texts in text_slices(batch, "text", 400_000):
                marks[first:last] = net.scores(texts) >= threshold
            yield batch.filter(pa.array(marks))

    return docs.mapInArrow(keep, schema)



"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all its bytes. Learned filters slide
over a chunk; each keeps its largest response. A document is the mean and the largest of
its chunks' responses, and a logistic unit makes one probability of them. The embedding
of a byte and the weights of a filter at one offset are one table, so a response is a
sum of table rows.

The network is fitted on at most ``TRAIN_ROWS`` labelled documents of each class, chosen
by hash of the id, over their whole texts; everything else covers all rows. An id and
label that occur more than once count once, with their smallest text, and rows without
an id are not learned from. Which rows may be used is the caller's choice. Scores come from the text's bytes alone.

Null and empty texts are one chunk of padding and get a score like any other. Repeated
rows are scored one by one. With labels of one class only, or none, the score is the
smoothed share of that class. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorgauge.llm.common import checksum_fold, text_of

WIDTH, FILTERS = 6, 24
CHUNK, STEP = 512, 448
TRAIN_ROWS = 1500
EPOCHS, RATE, BATCH = 8, 0.02, 32
CUT = 0.3
#: Bytes whose responses are held at once.
HELD = 1 << 16


@dataclass
class Network:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray  # FILTERS
    weights: np.ndarray  # 2 * FILTERS: mean, largest
    offset: float

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses at every place where a filter fits."""
        n = data.size - WIDTH + 1
        total = self.tables[0].take(data[:n], axis=0)
        for j in range(1, WIDTH):
            total += self.tables[j].take(data[j : n + j], axis=0)
        return total

    def pooled(self, data: np.ndarray) -> np.ndarray:
        """Largest responses by chunk, above zero after the bias; ``data`` is padded.

        Chunks start every ``STEP`` bytes. Maxima of the stretches between all chunk
        borders are taken once, and a chunk is the maximum of its stretches.
        """
        n = data.size - WIDTH + 1
        starts = chunk_starts(data.size)
        borders = np.unique(np.concatenate([starts, np.minimum(starts + CHUNK - WIDTH + 1, n)]))
        borders = borders[borders < n]
        parts = np.empty((borders.size, FILTERS), np.float32)
        at = 0
        while at < borders.size:  # some stretches at a time, so memory is bounded
            to = max(at + 1, int(np.searchsorted(borders, borders[at] + HELD)))
            lo, hi = borders[at], borders[to] if to < borders.size else n
            found = self.responses(data[lo : hi + WIDTH - 1])
            parts[at:to] = np.maximum.reduceat(found, borders[at:to] - lo, axis=0)
            at = to
        first = np.searchsorted(borders, starts)
        last = np.searchsorted(borders, np.minimum(starts + CHUNK - WIDTH + 1, n))
        spans = np.maximum.reduceat(
            np.vstack([parts, parts[-1:]]), np.stack([first, last], axis=1).ravel(), axis=0
        )[::2]
        return np.maximum(spans + self.bias, 0)

    def score(self, text: bytes) -> float:
        chunks = self.pooled(padded(text))
        return self.probability(np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)]))

    def probability(self, features: np.ndarray) -> float:
        z = float(features @ self.weights) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def padded(text: bytes) -> np.ndarray:
    """Bytes with zeros so that filters reach over both ends."""
    data = np.zeros(len(text) + 2 * (WIDTH - 1), np.uint8)
    data[WIDTH - 1 : WIDTH - 1 + len(text)] = np.frombuffer(text, np.uint8)
    return data


def chunk_starts(size: int) -> np.ndarray:
    """Starts of the chunks that cover ``size`` bytes."""
    return np.arange(0, max(1, size - (CHUNK - STEP)), STEP)


def fit(documents: list[tuple[list[bytes], int]], seed: int = 7) -> Network:
    """Network from chunks and labels, by gradient steps with per-weight rates."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS),
        0.0,
    )
    labels = np.array([y for _, y in documents], float)
    good = labels.sum()
    net.offset = float(np.log((good + 1) / (labels.size - good + 1)))
    if not 0 < good < labels.size:
        net.weights[:] = 0
        return net
    data = [[padded(c) for c in chunks or [b""]] for chunks, _ in documents]
    weight = np.where(labels == 1, labels.size / (2 * good), labels.size / (2 * (labels.size - good)))
    held = [np.zeros_like(net.tables), np.zeros_like(net.bias), np.zeros_like(net.weights), np.zeros(1)]

    def step(k: int, value: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        held[k] = 0.95 * held[k] + 0.05 * gradient**2
        return (value - RATE * gradient / (np.sqrt(held[k]) + 1e-4)).astype(value.dtype)

    for _ in range(EPOCHS):
        order = rng.permutation(labels.size)
        for a in range(0, labels.size, BATCH):
            d_tables, d_bias = np.zeros_like(net.tables), np.zeros_like(net.bias)
            d_weights, d_offset = np.zeros_like(net.weights), np.zeros(1)
            for i in order[a : a + BATCH]:
                found = [net.responses(c) for c in data[i]]
                best = np.array([r.argmax(axis=0) for r in found])
                top = np.array([r.max(axis=0) for r in found]) + net.bias
                chunks = np.maximum(top, 0)
                features = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)])
                error = (net.probability(features) - labels[i]) * weight[i] / BATCH
                d_weights += error * features
                d_offset += error
                back = error * net.weights[:FILTERS] / len(found) * np.ones((len(found), 1))
                back[chunks.argmax(axis=0), np.arange(FILTERS)] += error * net.weights[FILTERS:]
                back *= top > 0
                d_bias += back.sum(axis=0)
                for c, places, b in zip(data[i], best, back, strict=True):
                    for j in range(WIDTH):
                        np.add.at(d_tables[j], (c[places + j], np.arange(FILTERS)), b)
            net.tables, net.bias = step(0, net.tables, d_tables), step(1, net.bias, d_bias)
            net.weights = step(2, net.weights, d_weights)
            net.offset = float(step(3, np.array([net.offset]), d_offset)[0])
    # Undo the class weights: the score is a probability at the labels' own shares.
    net.offset += float(np.log(good / (labels.size - good)))
    return net


# ---------------------------------------------------------------- on Spark


def training_chunks(docs: DataFrame, known: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple[list[bytes], int]]:
    """All chunks and the label of at most ``rows`` of ``docs`` of each class.

    ``known`` has ``labelled`` (an id) and ``label``. Ids are chosen first, from the id
    columns alone, so no text is shuffled to find them; then the chosen ids, at most
    ``2 * rows``, are broadcast to fetch their texts.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id").join(known, F.col("doc_id") == F.col("labelled")).select("labelled", "label").distinct()
    order = F.xxhash64(F.col("labelled").cast("string"))
    chosen = [
        (r["labelled"], label)
        for label in (0, 1)
        for r in ids.where(F.col("label") == label).orderBy(order, "labelled").limit(rows).collect()
    ]
    wanted = F.broadcast(spark.createDataFrame(chosen, "labelled long, label int"))
    texts = docs.select("doc_id", text_of().alias("text")).join(wanted, F.col("doc_id") == F.col("labelled"))
    found = {(r["labelled"], r["label"]): r["text"].encode() for r in texts.groupBy("labelled", "label").agg(F.min("text").alias("text")).collect()}
    return [([text[s : s + CHUNK] for s in chunk_starts(len(text)).tolist()], key[1]) for key in chosen if (text := found.get(key)) is not None]


SCORES = "doc_id long, held_out boolean, score double, predicted int"
_SCORES = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
)


def score_documents(docs: DataFrame, net: Network, held_out: Column) -> DataFrame:
    """``SCORES`` of every row by the broadcast network of fixed size."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            scores = [net.score(t.as_buffer().to_pybytes()) for t in batch.column(2).cast(pa.binary())]
            predicted = [int(s >= CUT) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array(predicted, pa.int32())], schema=_SCORES
            )

    slim = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), text_of().alias("text"))
    return slim.mapInArrow(run, SCORES)


def classify_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Learn ``labels.quality`` outside fold 0 of five, score all documents."""
    fold = F.coalesce(checksum_fold(F.col("doc_id")), F.lit(1))
    known = labels.select(F.col("doc_id").cast("long").alias("labelled"), F.col("quality").cast("int").alias("label"))
    net = fit(training_chunks(docs.where(fold != 0), known.where("label in (0, 1)"), rows))
    return score_documents(docs, net, fold == 0)

"""Language identification by string kernels.

A text is the set of its byte n-grams of one to ``LONGEST`` bytes, lower-cased, over its
whole length. The kernel of two texts is the number of n-grams they share over the root
of the product of their set sizes. ``LANDMARKS`` training texts, equally many of each
language, span the kernel (Nyström); one ridge regression a language, with targets 1 and
-1, is solved in that span. Scores of a batch are one sparse matrix product: the batch's
presence rows times the landmarks' presence matrix, which is multiplied by the
coefficients once beforehand, since the product is associative.

The regression is fitted on at most ``TRAIN_ROWS`` training texts in all, equally many of
each language, chosen by hash of the id. Everything else covers all rows. The driver
holds kernel rows of that sample and the n-grams of the landmarks; the number of learned
languages must fit a list there.

Texts that are null or have no letter are ``und`` with score 0 and are not learned from;
so is everything where no row can be learned from. Rows without an id are scored and not
learned from, and so are those without a language. Rows that repeat an id and language
count once in the sample, with their smallest text. Equal scores go to the first
language in code point order. Long texts are read piece by piece. Other columns may have
any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.llm.common import checksum_fold, text_of
from sectorgauge.sources.stages import stage

LONGEST = 4
LANDMARKS, TRAIN_ROWS = 96, 4096
RIDGE = 1e-4
UNKNOWN = "und"
#: Bytes of a long text whose n-grams are gathered at once; n-grams of one matrix product.
PIECE, HELD = 1 << 20, 1 << 19

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"
_PREDICTED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
)


# ---------------------------------------------------------------- kernel


def spectrum(text: bytes, longest: int = LONGEST) -> np.ndarray:
    """Ascending keys of the distinct n-grams: length in the high, bytes in the low half."""
    data = np.frombuffer(b" " + text + b" ", np.uint8)
    parts: list[list[np.ndarray]] = [[] for _ in range(longest)]
    for at in range(0, data.size, PIECE):
        piece = data[at : at + PIECE + longest - 1].astype(np.uint32)
        gram = piece
        for n in range(longest):
            if n:
                gram = (gram[:-1] << np.uint32(8)) | piece[n:]
            parts[n].append(np.unique(gram[:PIECE]))
    found = [p[0] if len(p) == 1 else np.unique(np.concatenate(p)) for p in parts]
    return np.concatenate([f.astype(np.uint64) + np.uint64((n + 1) << 32) for n, f in enumerate(found)])


def products(rows: list[np.ndarray], keys: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Presence rows (as keys) times ``matrix``, whose rows belong to ascending ``keys``.

    Rows are taken in batches of ``HELD`` n-grams.
    """
    out = np.zeros((len(rows), matrix.shape[1]), np.float64)
    at = 0
    while at < len(rows):
        to, held = at + 1, rows[at].size
        while to < len(rows) and held + rows[to].size <= HELD:
            held, to = held + rows[to].size, to + 1
        flat = np.concatenate(rows[at:to])
        place = np.searchsorted(keys, flat)
        place[place == keys.size] = 0
        known = keys[place] == flat
        owner = np.repeat(np.arange(at, to), [r.size for r in rows[at:to]])[known]
        if owner.size:
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[first]] = np.add.reduceat(matrix[place[known]], first, axis=0, dtype=np.float64)
        at = to
    return out


@dataclass
class KernelModel:
    languages: list[str]
    keys: np.ndarray  # n-grams of the landmarks, ascending
    weights: np.ndarray  # n-gram x language

    def predict(self, rows: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
        """Language and score of each spectrum."""
        raw = products(rows, self.keys, self.weights) / np.sqrt([r.size for r in rows])[:, None]
        best = raw.argmax(axis=1)
        return [self.languages[b] for b in best], np.clip((raw[np.arange(best.size), best] + 1) / 2, 0, 1)


def landmark_matrix(landmarks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys of all landmarks, and their normalised presence by landmark."""
    keys = np.unique(np.concatenate(landmarks))
    matrix = np.zeros((keys.size, len(landmarks)), np.float32)
    for j, own in enumerate(landmarks):
        matrix[np.searchsorted(keys, own), j] = 1 / np.sqrt(own.size)
    return keys, matrix


def solve(kernel: np.ndarray, between: np.ndarray, targets: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Landmark coefficients of ridge regressions in the span of the landmarks.

    ``kernel`` is training rows x landmarks, ``between`` landmarks x landmarks. With
    ``K`` that square and ``F`` the rows times ``K ** -0.5``, this is ``K ** -0.5`` times
    the solution of ``(F'F + ridge * rows) w = F' targets``.
    """
    size, turn = np.linalg.eigh(between)
    used = size > size.max() * 1e-9  # copies among the landmarks span nothing new
    root = turn[:, used] / np.sqrt(size[used])
    features = kernel @ root
    square = features.T @ features + ridge * len(kernel) * np.eye(root.shape[1])
    return root @ np.linalg.solve(square, features.T @ targets)


# ---------------------------------------------------------------- on Spark


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def training_sample(docs: DataFrame, usable: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """``lang, place, text`` of the sample, stored; ``place`` counts from 1 in each language.

    Ids are chosen first, from the columns of ids and languages alone: all below a hash
    that lets about twice the wanted number of a language through, and of those the
    smallest hashes. So no language's ids meet in one task. Only chosen texts move.
    """
    known = docs.where(usable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    ids = known.select("doc_id", F.col("lang").alias("of")).groupBy("of", "doc_id").count()
    sizes = {r["of"]: r["n"] for r in ids.groupBy("of").agg(F.count("*").alias("n")).collect()}
    each = max(1, rows // max(1, len(sizes)))
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, 2.0 * each / n))) if sizes else None
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    if share is not None:
        # 52 bits of the hash, as a share of all
        ids = ids.where(F.shiftrightunsigned(hashed, 12) / float(1 << 52) < F.try_element_at(share, F.col("of")))
    ranked = ids.withColumn("place", F.row_number().over(Window.partitionBy("of").orderBy(hashed, "doc_id")))
    chosen = stage(ranked.where(F.col("place") <= each).select("of", F.col("doc_id").alias("id"), "place"), "chosen")
    texts = known.select("doc_id", "lang", "text").join(
        F.broadcast(chosen), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("of"))
    )  # at most ``rows`` ids
    return stage(texts.groupBy("lang", "place").agg(F.min("text").alias("text")), "sample")


def _spectra(sample: DataFrame, per_language: int) -> list[np.ndarray]:
    """Spectra of the landmarks in order of language and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [spectrum(t.as_buffer().to_pybytes()).tobytes() for t in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["lang", "place", "keys"])

    picked = sample.where(F.col("place") <= per_language).select("lang", "place", F.lower("text"))
    found = picked.mapInArrow(run, "lang string, place int, keys binary").orderBy("lang", "place").collect()
    return [np.frombuffer(r["keys"], np.uint64) for r in found]


def fit(docs: DataFrame, usable: Column, rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS) -> KernelModel | None:
    """Model of the languages of the ``usable`` rows; None without any."""
    sample = training_sample(docs, usable & has_letter(), rows)
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not languages:
        return None
    spanning = _spectra(sample, max(1, landmarks // len(languages)))
    keys, matrix = landmark_matrix(spanning)
    sent = docs.sparkSession.sparkContext.broadcast((keys, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, matrix = sent.value
        for batch in batches:
            rows = [spectrum(t.as_buffer().to_pybytes()) for t in batch.column(1).cast(pa.binary())]
            kernel = products(rows, keys, matrix) / np.sqrt([r.size for r in rows])[:, None]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(kernel))], ["lang", "kernel"])

    # Few rows, each with some work: dealt out, so that more than one task has them.
    dealt = sample.select("lang", F.lower("text").alias("text"), "place").repartition("lang", "place").select("lang", "text")
    found = dealt.mapInArrow(run, "lang string, kernel array<double>").collect()
    found.sort(key=lambda r: (r["lang"], r["kernel"]))  # the same sums in every run
    kernel = np.array([r["kernel"] for r in found])
    targets = np.array([[1.0 if r["lang"] == lang else -1.0 for lang in languages] for r in found])
    between = products(spanning, keys, matrix) / np.sqrt([s.size for s in spanning])[:, None]
    coefficients = solve(kernel, (between + between.T) / 2, targets)
    return KernelModel(languages, keys, (matrix @ coefficients).astype(np.float32))


def predict(docs: DataFrame, model: KernelModel | None, held_out: Column) -> DataFrame:
    """``PREDICTED`` of every row."""
    slim = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), F.when(has_letter(), F.lower(text_of())).alias("text"))
    if model is None:
        return slim.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            langs, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            texts = batch.column(2).cast(pa.binary())
            where = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False)).tolist()
            for a in range(0, len(where), 256):
                part = where[a : a + 256]
                found, scores[part] = model.predict([spectrum(texts[i].as_buffer().to_pybytes()) for i in part])
                for i, lang in zip(part, found, strict=True):
                    langs[i] = lang
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores)], schema=_PREDICTED
            )

    return slim.mapInArrow(run, PREDICTED)


def identify_languages(docs: DataFrame, rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS) -> DataFrame:
    """Learn ``lang`` outside fold 0 of five, predict all documents."""
    held_out = F.coalesce(checksum_fold(F.col("doc_id")) == 0, F.lit(False))
    return predict(docs, fit(docs, ~held_out, rows, landmarks), held_out)

"""Centroid clustering over subvector dictionaries, in whole numbers.

Vectors are scaled to integers and stored once, cut into segments of at most
``SEGMENT`` vectors. A segment keeps, for each block of ``BLOCK`` dimensions, a
dictionary of its distinct subvectors and one code a vector, so nothing is lost. A
round computes the squared distance of every dictionary entry to every centroid once,
and a vector's distance to a centroid is the sum of its codes' partial distances. New
centroids come from the number of vectors by cluster and code, so a round reads codes
and dictionaries alone and sends one row a cluster and segment to the shuffle. Dictionaries
belong to segments: none grows with the table, and none is broadcast.

Vectors of another length, and those with a null or non-finite component, are left
out. Integers beyond ``LIMIT`` (components from a million on) count as ``LIMIT``, so that
distances fit 64 bits; an inertia that does not fit them fails. Repeated rows are
vectors like any other, and may be several starting centroids. A null id is kept and
is the last choice as a start; equal ids are ordered by their components. With fewer
vectors than clusters, each is a centroid; without any, the result is empty. Other
columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectorgauge.sources.stages import stage

DIMENSIONS, SCALE = 64, 64
CLUSTERS, ROUNDS = 16, 3
#: Dimensions of a dictionary; vectors of a segment.
BLOCK, SEGMENT = 2, 1 << 15
LIMIT = 1 << 26

_ENCODED = pa.schema(
    [
        ("ids", pa.list_(pa.int64())),
        ("codes", pa.binary()),  # blocks x vectors, two bytes each
        ("sizes", pa.list_(pa.int32())),  # entries of each dictionary
        ("entries", pa.binary()),  # all dictionaries, four bytes a component
    ]
)
ENCODED = "ids array<long>, codes binary, sizes array<int>, entries binary"
ASSIGNED = "vec_id long, cluster int, distance long"
_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])
TOTALS = "cluster int, members long, sums array<long>"
_TOTALS = pa.schema([("cluster", pa.int32()), ("members", pa.int64()), ("sums", pa.list_(pa.int64()))])


def scaled(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` within the limits."""
    return np.clip(np.floor(values.astype(np.float64) * scale), -LIMIT, LIMIT).astype(np.int32)


def encode_segment(vectors: np.ndarray, block: int = BLOCK) -> tuple[bytes, list[int], bytes]:
    """Codes, sizes and entries of the dictionaries of ``vectors`` (rows of integers)."""
    codes, sizes, entries = [], [], []
    for d in range(0, vectors.shape[1], block):
        part = np.ascontiguousarray(vectors[:, d : d + block])
        if part.shape[1] == 2:  # two integers of four bytes are one key of eight
            found, code = np.unique(part.view(np.int64).ravel(), return_inverse=True)
            found = found.view(np.int32)
        else:
            found, code = np.unique(part, axis=0, return_inverse=True)
        codes.append(code.ravel().astype("<u2"))
        sizes.append(found.size // part.shape[1])
        entries.append(found.astype("<i4").ravel())
    return np.concatenate(codes).tobytes(), sizes, np.concatenate(entries).tobytes()


class Segment:
    """A stored segment: dictionaries and codes by block."""

    def __init__(self, n: int, codes: bytes, sizes: list[int], entries: bytes, dimensions: int, block: int):
        self.n = n
        self.codes = np.frombuffer(codes, "<u2").reshape(-1, n)
        flat, self.books, at = np.frombuffer(entries, "<i4").astype(np.int64), [], 0
        for d, size in zip(range(0, dimensions, block), sizes, strict=True):
            width = min(block, dimensions - d)
            self.books.append(flat[at : at + size * width].reshape(size, width))
            at += size * width

    def nearest(self, centroids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance of each vector; ties go to the smaller number."""
        total = np.zeros((self.n, len(centroids)), np.int64)
        for k, book in enumerate(self.books):
            apart = book[:, None, :] - centroids[None, :, k * block : (k + 1) * block]
            total += np.einsum("ecd,ecd->ec", apart, apart).take(self.codes[k], axis=0)
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(self.n), cluster]

    def totals(self, cluster: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
        """Members and component sums of each cluster."""
        sums = []
        for code, book in zip(self.codes, self.books, strict=True):
            used = np.bincount(cluster * len(book) + code, minlength=clusters * len(book))
            sums.append(used.reshape(clusters, len(book)) @ book)
        return np.bincount(cluster, minlength=clusters), np.hstack(sums)


# ---------------------------------------------------------------- on Spark


def usable(vectors: DataFrame, vec_id: str, embedding: str, dimensions: int) -> DataFrame:
    """``vec_id, embedding`` of the rows that can be clustered."""
    finite = F.forall(embedding, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    kept = vectors.where((F.size(embedding) == dimensions) & finite)
    return kept.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))


def encode(kept: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """Stored segments of ``vec_id, embedding``."""

    def row(ids: list[pa.Array], parts: list[np.ndarray]) -> pa.RecordBatch:
        codes, sizes, entries = encode_segment(np.concatenate(parts), block)
        flat = pa.concat_arrays(ids)
        listed = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
        return pa.RecordBatch.from_arrays(
            [listed, pa.array([codes], pa.binary()), pa.array([sizes], pa.list_(pa.int32())), pa.array([entries], pa.binary())],
            schema=_ENCODED,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, SEGMENT - held)
                ids.append(piece.column(0))
                parts.append(scaled(piece.column(1).flatten().to_numpy(zero_copy_only=False), scale).reshape(-1, dimensions))
                at, held = at + piece.num_rows, held + piece.num_rows
                if held == SEGMENT:
                    yield row(ids, parts)
                    ids, parts, held = [], [], 0
        if held:
            yield row(ids, parts)

    return stage(kept.mapInArrow(run, ENCODED), "segments")


def _each(batches: Iterator[pa.RecordBatch], dimensions: int, block: int) -> Iterator[tuple[pa.Array, Segment]]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = batch.column(0)[i].values
            codes, sizes, entries = (batch.column(c)[i].as_py() for c in (1, 2, 3))
            yield ids, Segment(len(ids), codes, sizes, entries, dimensions, block)


def _assign(batches, centroids: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
    for ids, segment in _each(batches, centroids.shape[1], block):
        cluster, distance = segment.nearest(centroids, block)
        yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], schema=_ASSIGNED)


def _total(batches, centroids: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
    members, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    for _, segment in _each(batches, centroids.shape[1], block):
        cluster, _ = segment.nearest(centroids, block)
        more, summed = segment.totals(cluster, len(centroids))
        members, sums = members + more, sums + summed
    used = np.flatnonzero(members)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(members[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], schema=_TOTALS
    )


def starting_centroids(kept: DataFrame, clusters: int = CLUSTERS, scale: int = SCALE, seed: str = "1") -> np.ndarray:
    """The vectors with the smallest hash of ``seed:id``; a row each, at most ``clusters``."""
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(by_hash.asc_nulls_last(), "embedding").limit(clusters).collect()
    return scaled(np.array([r["embedding"] for r in first], np.float64), scale).astype(np.int64)


def next_centroids(segments: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Floor of the mean of each cluster's vectors; the driver gets one row a cluster."""
    parts = segments.mapInArrow(partial(_total, centroids=centroids, block=block), TOTALS)
    sums = F.array(*(F.sum(F.col("sums")[d]) for d in range(centroids.shape[1])))
    moved = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("members").alias("members"), sums.alias("sums")).collect():
        moved[r["cluster"]] = [s // r["members"] for s in r["sums"]]
    return moved


def assign(segments: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> DataFrame:
    """``ASSIGNED``: nearest centroid of every stored vector."""
    return segments.mapInArrow(partial(_assign, centroids=centroids, block=block), ASSIGNED)


def cluster_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``ASSIGNED`` of every usable vector, stored, and the final centroids."""
    kept = usable(vectors, vec_id, embedding, dimensions)
    centroids = starting_centroids(kept, clusters).reshape(-1, dimensions)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], ASSIGNED), centroids
    segments = encode(kept, dimensions)
    for _ in range(rounds):
        centroids = next_centroids(segments, centroids)
    return stage(assign(segments, centroids), "assigned"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the distance sums of its cluster and of all, and the centroid's digest.

    Clusters are few, so their sums come to the driver and go back as a literal.
    """
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    by_cluster = F.array(
        *(F.struct(F.lit(sums.get(k, 0)).cast("long").alias("s"), F.lit(x).alias("x")) for k, x in enumerate(digests))
    )
    own = F.get(by_cluster, F.col("cluster")) if digests else F.lit(None).cast("struct<s:long,x:string>")
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        own["s"].alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        own["x"].alias("centroid_sha256"),
    )

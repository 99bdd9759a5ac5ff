"""N-gram Jaccard join: T-occurrence search with DivideSkip over candidate groups.

1. Texts become sets of hashed shingles of some words; documents with the same set are
   one class, and everything below is about classes.
2. Two sets of the wanted similarity differ in few shingles for their size. The shingles
   of a set are split by hash into more segments than two such sets can differ in, so some
   segments of both are equal. There are spare segments, so each set leaves out its most
   frequent ones, such as empty ones and those of a common line; an equal segment among
   the others makes a candidate link.
3. Candidate links fall into groups, by connected components. A group is cut into chunks
   of at most ``CHUNK`` classes and every pair of chunks is searched, so a group of any
   size is searched whole and no task holds more than two chunks.
4. In a pair of chunks, one is an inverted index and the other asks: the short lists of a
   set's shingles are heap-merged, the long ones probed by binary search, and a class
   that reaches the overlap is a link. Classes that are already linked are not asked
   about again: components need one link, not all.
5. Components of the links give each document its smallest partner.

Shingles are 64-bit hashes, sets are told apart by 64-bit hashes too.

Null and empty texts have no set and no partner. Rows with equal texts are one class;
a row with a null id gets the component of its class and gives it no id. An empty table
gives an empty result. Only ``doc_id`` and ``text`` are read, so other columns may have
any name.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from hashlib import blake2b
from heapq import merge
from itertools import groupby
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.llm.common import text_of
from sectorgauge.llm.components import connected_components
from sectorgauge.sources.stages import free_shuffles, stage

#: Words of a shingle and least similarity in percent, of the query.
WORDS, PERCENT = 3, 90
#: Most words of a shingle.
MAX_WORDS = 16
#: Bytes that are hashed at once.
PIECE = 1 << 20
#: Classes of a group that are searched at once.
CHUNK = 1024
#: Ids that may be broadcast; more are joined by shuffle.
BROADCAST_IDS = 2_000_000
#: Parts of all segments, counted one after another so that less is on disk at once.
PARTS = 4
#: Classes whose bands a task remembers to have handed on.
CLASSES_HELD = 1 << 20
#: Weight of the longest list in the choice of long lists.
MU = 0.0085

_U = np.uint64
_RANDOM = np.random.default_rng(20).integers(0, 1 << 63, 256 + MAX_WORDS, dtype=np.uint64) * _U(2) + _U(1)
_BYTE = _RANDOM[:256].copy()
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_PLACE = _RANDOM[256:]
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_BASE = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> np.ndarray:
    return np.concatenate([[_U(1)], np.cumprod(np.full(size - 1, _BASE))])


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data`` and where they start."""
    space = _SPACE[data]
    solid = np.flatnonzero(~space)
    if not solid.size:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    begins = np.flatnonzero(np.concatenate([[True], np.diff(solid) > 1]))
    lengths = np.diff(np.append(begins, solid.size))
    inside = np.arange(solid.size) - np.repeat(begins, lengths)
    powers = _powers(1 << max(6, int(lengths.max()).bit_length()))
    return mix(np.add.reduceat(_BYTE[data[solid]] * powers[inside], begins)), solid[begins]


def shingle_sets(texts: Iterable[bytes], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    Short texts are hashed together, long ones in pieces cut at white space.
    """
    held, size = [], 0
    for text in texts:
        if len(text) > PIECE:
            yield from _sets_of(held, width)
            held, size = [], 0
            yield _set_of(np.concatenate([_hash_words(p)[0] for p in _pieces(text)]), width)
            continue
        held.append(text)
        size += len(text)
        if size >= PIECE:
            yield from _sets_of(held, width)
            held, size = [], 0
    yield from _sets_of(held, width)


def _pieces(text: bytes) -> Iterator[np.ndarray]:
    data, at = np.frombuffer(text, np.uint8), 0
    while at < data.size:
        end = at + PIECE
        while end < data.size and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def _sets_of(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    if not texts:
        return
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    words, starts = _hash_words(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.searchsorted(starts, ends)
    yield from (_set_of(words[a:z], width) for a, z in zip([0, *cuts[:-1]], cuts, strict=True))


def _set_of(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingles of a text's words; of fewer than ``width``, the whole as one."""
    width = min(width, words.size)
    if not width:
        return words
    n = words.size - width + 1
    total = np.full(n, _U(width))
    for j in range(width):
        total += words[j : j + n] * _PLACE[j]
    return np.unique(mix(total))


def class_of(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


# ---------------------------------------------------------------- candidate segments


@lru_cache(maxsize=1)
def _band_ends(limit: int = 1 << 40) -> list[int]:
    ends = [1]
    while ends[-1] < limit:
        ends.append(max(ends[-1] + 1, ends[-1] * 3 // 2))
    return ends


def segments(shingles: np.ndarray, percent: int) -> list[tuple[int, np.ndarray]]:
    """``spare, hashes`` of the set's segments, for its band of sizes and the next if it can matter.

    Two linked sets lie in one band or in neighbours, and take the band of the larger.
    With sizes up to ``u`` they differ in at most ``d`` shingles, ``2u / 19`` for 90
    percent. Of ``d + 1 + spare`` segments ``spare + 1`` are equal, so each set can leave
    out any ``spare`` of them by one order of all segments, and one equal segment stays
    in both. ``spare`` is below 0 in the next band, to tell the two apart.
    """
    n, ends = shingles.size, _band_ends()
    band = bisect_left(ends, n)
    found = []
    for k in (band, band + 1):
        if k > band and n * 100 < percent * (ends[band] + 1):
            break
        differ = (200 - 2 * percent) * ends[k] // (100 + percent)
        if differ == 0:
            continue  # only equal sets can be linked
        spare = 1 + differ // 2
        m = differ + 1 + spare
        segment = ((shingles >> _U(32)) % _U(m)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        filled, first = np.unique(segment[order], return_index=True)
        sums = np.zeros(m, _U)
        sums[filled] = np.add.reduceat(mix(shingles[order] ^ _BASE), first)
        found.append((spare if k == band else -spare, mix(sums + mix(np.arange(m, dtype=_U) + _U(k << 40)))))
    return found


CLASSES = "doc_id long, n_shingles long, class long, bands array<struct<part:int,spare:int,segments:array<long>>>"
_BAND = pa.struct([("part", pa.int32()), ("spare", pa.int32()), ("segments", pa.list_(pa.int64()))])
_CLASSES = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("class", pa.int64()), ("bands", pa.list_(_BAND))]
)


def _bands(lists: list[list[tuple[int, np.ndarray]]]) -> pa.Array:
    bands = [(p, spare, x[p::PARTS]) for found in lists for spare, x in found for p in range(PARTS)]
    flat = np.concatenate([np.zeros(0, _U), *(x for _, _, x in bands)]).view(np.int64)
    ends = np.cumsum([0, *(x.size for _, _, x in bands)])
    inner = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
    numbers = [pa.array([b[j] for b in bands], pa.int32()) for j in (0, 1)]
    both = pa.StructArray.from_arrays([*numbers, inner], fields=list(_BAND))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(PARTS * len(x) for x in lists)]), pa.int32()), both)


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (t.as_buffer().to_pybytes() for t in column.cast(pa.binary()))


def document_classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``CLASSES`` of every row, stored; the class of an empty set is null.

    Bands belong to a class: of its rows in a task the first one has them, the others none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handed_on: set[int] = set()
        for batch in batches:
            sizes, classes, lists = [], [], []
            for s in shingle_sets(_texts(batch.column(1)), width):
                sizes.append(s.size)
                classes.append(class_of(s) if s.size else None)
                lists.append([] if classes[-1] in handed_on else segments(s, percent))
                if len(handed_on) >= CLASSES_HELD:
                    handed_on.clear()
                if s.size:
                    handed_on.add(classes[-1])
            if sizes:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(classes, pa.int64()),
                        _bands(lists),
                    ],
                    schema=_CLASSES,
                )

    slim = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return stage(slim.mapInArrow(run, CLASSES), "classes")


def shared_segments(classes: DataFrame, part: int) -> DataFrame:
    """``class, spare, segment, n`` of the segments of a part that two classes have, stored.

    Segments move once: the window's least and largest class tell which of them are shared.
    """
    sets = classes.select("class", F.explode("bands").alias("band")).where(F.col("band.part") == part)
    pairs = sets.select("class", "band.spare", F.explode("band.segments").alias("segment"))
    same = Window.partitionBy("segment")
    ends = (f("class").over(same).alias(name) for f, name in ((F.min, "low"), (F.max, "high"), (F.count, "n")))
    held = pairs.select("*", *ends).where("low <> high").select("class", "spare", "segment", "n").distinct()
    held = stage(held, "shared")
    del sets, pairs
    free_shuffles(classes.sparkSession)
    return held


def candidate_groups(classes: DataFrame) -> DataFrame:
    """``class, grp`` of the classes with a candidate link.

    Every class leaves out its most frequent segments, as many as are spare. Each other
    segment links all its classes to its smallest. Smallest and largest are combined
    before the shuffle; segments of one class go before the classes come back.
    """
    held = reduce(DataFrame.union, [shared_segments(classes, p) for p in range(PARTS)])
    often = Window.partitionBy("class", "spare").orderBy(F.desc("n"), "segment")
    rare = held.withColumn("place", F.row_number().over(often)).where(F.col("place") > F.abs("spare"))
    rare = stage(rare.select("class", "segment"), "segments")
    least = rare.groupBy("segment").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    least = least.where("low <> high").select(F.col("segment").alias("s"), "low")
    edges = rare.join(least, F.col("segment") == F.col("s")).select("class", "low").distinct()
    found = connected_components(edges, "class", "low")
    heads = found.select(F.col("component").alias("vertex"), "component").distinct()
    return stage(
        found.union(heads).select(F.col("vertex").alias("class"), F.col("component").alias("grp")), "groups"
    )


# ---------------------------------------------------------------- T-occurrence search


def linked(a: int, b: int, common: int, percent: int) -> bool:
    """Whether sets of sizes ``a`` and ``b`` with ``common`` shingles are linked."""
    return 100 * common >= percent * (a + b - common)


class InvertedIndex:
    """Lists of set numbers by shingle, ascending."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = [s.size for s in sets]
        shingles = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(shingles, kind="stable")
        self.shingles, first = np.unique(shingles[order], return_index=True)
        self.first = np.append(first, shingles.size)
        self.owners = owner[order].tolist()

    def search(self, query: np.ndarray, before: int, skip) -> Iterator[int]:
        """Numbers below ``before`` of the sets linked to ``query``, by DivideSkip.

        ``skip(number)`` tells sets that need no look. Lists are ranges of the joint
        list; of the longest ``T / (MU log(longest) + 1)`` only probes are made.
        """
        at = np.minimum(np.searchsorted(self.shingles, query), self.shingles.size - 1)
        at = at[self.shingles[at] == query]
        ranges = sorted(
            ((a, z) for a, z in zip(self.first[at].tolist(), self.first[at + 1].tolist(), strict=True)),
            key=lambda r: r[1] - r[0],
        )
        least = ceil(self.percent * query.size / 100)
        if len(ranges) < least:
            return
        n_long = min(len(ranges), least - 1, int(least / (MU * log2(ranges[-1][1] - ranges[-1][0] + 1) + 1)))
        short, long_ = ranges[: len(ranges) - n_long], ranges[len(ranges) - n_long :]
        owners = self.owners
        lists = [owners[a : bisect_left(owners, before, a, z)] for a, z in short]
        for number, times in groupby(merge(*(x for x in lists if x))):
            common = sum(1 for _ in times)
            if common < least - n_long or skip(number):
                continue
            size = self.sizes[number]
            needed = ceil(self.percent * (query.size + size) / (100 + self.percent))
            for k, (a, z) in enumerate(long_):
                if common + n_long - k < needed:
                    break
                place = bisect_left(owners, number, a, z)
                common += place < z and owners[place] == number
            if linked(query.size, size, common, self.percent):
                yield number


class Union:
    """Sets of numbers that can be joined."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def links_between(index: list[np.ndarray], asking: list[np.ndarray] | None, percent: int) -> Iterator[tuple[int, int]]:
    """Links that connect what is connected: of ``index`` in itself, or to ``asking``.

    Numbers of ``asking`` start after those of ``index``.
    """
    lists, own = InvertedIndex(index, percent), asking is None
    queries = index if own else asking
    union = Union(len(index) + (0 if own else len(queries)))
    for q, query in enumerate(queries):
        me = q if own else len(index) + q
        for number in lists.search(query, q if own else len(index), lambda x, me=me: union.find(x) == union.find(me)):
            if union.join(number, me):
                yield number, me


LINKS = "a long, b long"


def search_plan(groups: DataFrame, members: DataFrame) -> DataFrame:
    """``least, class, grp, chunk, pairs`` of every class in a group, stored.

    ``least`` is the id whose text stands for the class; ``pairs`` are the pairs of
    chunks that its own chunk takes part in.
    """
    sizes = groups.groupBy("grp").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    placed = groups.join(sizes, "grp").withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda x: F.struct(F.least(x, F.col("chunk")).alias("i"), F.greatest(x, F.col("chunk")).alias("j")),
    )
    known = members.where("least is not null")
    return stage(placed.join(known, "class").select("least", "class", "grp", "chunk", pairs.alias("pairs")), "search")


def group_links(docs: DataFrame, plan: DataFrame, width: int, percent: int) -> DataFrame:
    """``LINKS`` between classes of the same group, by the texts of ``docs``."""
    if plan.count() <= BROADCAST_IDS:
        plan = F.broadcast(plan)
    texts = docs.select(F.col("doc_id").cast("long").alias("least"), text_of().alias("text")).join(plan, "least")
    rows = texts.select("grp", F.explode("pairs").alias("pair"), "chunk", "class", "text")
    rows = rows.select("grp", "pair.i", "pair.j", "chunk", "class", "text")
    dealt = rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "chunk", "class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stored() -> Iterator[tuple]:
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns[:5]]
                yield from zip(*columns, shingle_sets(_texts(batch.column(5)), width), strict=True)

        for (_, i, j), rows in groupby(stored(), key=lambda r: r[:3]):
            names, sets = ([], []), ([], [])
            for _, _, _, chunk, name, shingles in rows:
                if class_of(shingles) == name:  # a row may share the id and have another text
                    names[chunk != i].append(name)
                    sets[chunk != i].append(shingles)
            both = names[0] + names[1]
            if not sets[0] or (i != j and not sets[1]):
                continue
            found = [(both[a], both[b]) for a, b in links_between(sets[0], None if i == j else sets[1], percent)]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, LINKS)


def jaccard_components(docs: DataFrame, width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Shingles have ``width`` words, and a similarity of ``percent`` makes a link.
    """
    if not 1 <= width <= MAX_WORDS or not 0 < percent <= 100:
        raise ValueError("width from 1 to %d and percent from 1 to 100 are needed" % MAX_WORDS)
    classes = document_classes(docs, width, percent)
    groups = candidate_groups(classes.where("class is not null"))
    members = classes.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    links = group_links(docs, search_plan(groups, members), width, percent)
    found = connected_components(links, "a", "b").withColumnRenamed("vertex", "class")
    named = members.join(found, "class", "left").select(
        "class", "least", F.coalesce("component", "class").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = named.select("class", "component").join(smallest, "component").select("class", "component_id")
    return classes.join(of_class, "class", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )

"""Benchmark decontamination: BM25 retrieval of test items with block-max WAND.

Test items are the indexed documents; every training passage is a query. A passage is a
window of words twice as long as the longest item, starting at every half window, so any
item copied into a text lies whole in some passage. Scores are BM25 sums as a share of
the item's score against itself, so one threshold fits items of any length. Lists are
cut into blocks with their largest score; cursors skip what can't reach the threshold.
A passage whose terms could not reach it together is never searched. What is retrieved
is verified: the item's question and its answer must both be in the passage, word
triple by word triple.

Items are taken in blocks of ``ITEMS_PER_INDEX``, so an index sent to the executors is
bounded whatever the number of items; every block meets all documents. Term weights and
the passage length come from all items, so scores don't depend on the blocks.

Null and empty texts, in documents or items, match nothing. Repeated rows give repeated
results. Only ids and texts are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sectorgauge.llm.common import text_of
from sectorgauge.sources.stages import stage

K1, B = 1.2, 0.75
THRESHOLD = 0.7
MIN_OVERLAP = 0.8
BLOCK = 32
RANGE = 4
ASIDE = 0.6
ITEMS_PER_INDEX = 20_000
MIN_PASSAGE = 64
#: Characters of a text that are cut into words at once.
PIECE = 1 << 20

#: ASCII white space, punctuation and control characters end a word; the rest is one.
_BREAKS = bytes.maketrans(
    bytes(c for c in range(128) if not chr(c).isalnum()), b" " * sum(not chr(c).isalnum() for c in range(128))
)
_SENTENCE_END = re.compile(r"[.!?]\s+|\n+")


def words_of(text: str) -> list[bytes]:
    """Lower-case words as UTF-8."""
    return text.lower().encode().translate(_BREAKS).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence is the answer; of a single sentence, the last quarter."""
    ends = [m.end() for m in _SENTENCE_END.finditer(text.rstrip())]
    if ends and words_of(text[: ends[-1]]) and words_of(text[ends[-1] :]):
        return words_of(text[: ends[-1]]), words_of(text[ends[-1] :])
    words = words_of(text)
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def _triples(words: list[bytes]) -> set[tuple[bytes, ...]]:
    width = min(3, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    """Share of the part's word triples (or its whole, if shorter) in the passage."""
    wanted = _triples(part)
    if not wanted:
        return 1.0
    width = len(next(iter(wanted)))
    return len(wanted & {tuple(passage[i : i + width]) for i in range(len(passage) - width + 1)}) / len(wanted)


@dataclass
class PostingList:
    items: list[int]
    scores: list[float]
    block_max: list[float]
    most: float


@dataclass
class ItemStatistics:
    """What BM25 needs of all items; ``found`` has the items that hold each word."""

    n_items: int
    n_words: int
    longest: int
    found: dict[bytes, int]

    @classmethod
    def of(cls, words: list[list[bytes]]) -> ItemStatistics:
        lengths = [len(w) for w in words]
        return cls(len(words), sum(lengths), max(lengths, default=0), Counter(t for w in words for t in set(w)))


class ItemIndex:
    """Inverted index of test items with normalised BM25 scores.

    The weights are those of all items (``whole``), of which the index may hold a part.
    """

    def __init__(self, items: list[tuple[int, str]], whole: ItemStatistics | None = None):
        self.ids = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        words = [words_of(t) for _, t in items]
        whole = whole or ItemStatistics.of(words)
        lengths, found = [len(w) for w in words], whole.found
        self.passage = max(MIN_PASSAGE, 2 * whole.longest)
        mean = whole.n_words / max(1, whole.n_items) or 1.0
        counts = [Counter(w) for w in words]
        self.terms = {t: k for k, t in enumerate(sorted({t for c in counts for t in c}))}
        weights: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for i, c in enumerate(counts):
            scores = {
                t: log(1 + (whole.n_items - found[t] + 0.5) / (found[t] + 0.5)) * n * (K1 + 1)
                / (n + K1 * (1 - B + B * lengths[i] / mean))
                for t, n in c.items()
            }
            own = sum(scores.values())
            for t, s in scores.items():
                weights[self.terms[t]].append((i, s / own))
        self.lists = [
            PostingList(
                [i for i, _ in w],
                [s for _, s in w],
                [max(s for _, s in w[a : a + BLOCK]) for a in range(0, len(w), BLOCK)],
                max(s for _, s in w),
            )
            for w in weights
        ]
        self._bound_by_range(weights, len(items))

    def _bound_by_range(self, weights: list[list[tuple[int, float]]], n_items: int) -> None:
        """Largest scores by term and range of ``RANGE`` items, for terms worth counting.

        The most frequent terms are set aside as long as no item gets more than ``ASIDE``
        of the threshold from them; what a range can get from them is a constant. A passage that
        reaches the threshold must get the rest from the other, rare terms.
        """
        common = np.zeros(n_items)
        aside: set[int] = set()
        for t in sorted(range(len(weights)), key=lambda t: (-len(weights[t]), t)):
            items, scores = zip(*weights[t], strict=True)
            grown = common.copy()
            grown[list(items)] += scores
            if grown.max() > ASIDE * THRESHOLD:
                break
            common, aside = grown, aside | {t}
        self.ranges = -(-n_items // RANGE)
        self.wanted = THRESHOLD - 1e-9 - np.maximum.reduceat(common, np.arange(0, n_items, RANGE)) if n_items else common
        self.rare = {w: t for w, t in self.terms.items() if t not in aside}
        starts, ranges, most = [0], [], []
        for own in weights:
            best: dict[int, float] = {}
            for i, s in own:
                best[i // RANGE] = max(best.get(i // RANGE, 0.0), s)
            ranges += best.keys()
            most += best.values()
            starts.append(len(ranges))
        self.starts, self.range_ids, self.range_most = np.array(starts), np.array(ranges, np.int64), np.array(most)

    def search(self, terms: Iterable[int], threshold: float = THRESHOLD) -> dict[int, float]:
        """All items whose score reaches the threshold, by block-max WAND."""
        cursors = [[0, self.lists[t]] for t in terms]
        found: dict[int, float] = {}
        slack = threshold - 1e-9
        while True:
            cursors = [c for c in cursors if c[0] < len(c[1].items)]
            cursors.sort(key=lambda c: c[1].items[c[0]])
            bound, pivot = 0.0, -1
            for k, (_, postings) in enumerate(cursors):
                bound += postings.most
                if bound >= slack:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][1].items[cursors[pivot][0]]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][1].items[cursors[pivot + 1][0]] == item:
                pivot += 1
            shallow, until = 0.0, None
            for at, postings in cursors[: pivot + 1]:
                block = self._block_of(postings, at, item)
                if block is not None:
                    shallow += postings.block_max[block]
                    last = postings.items[min((block + 1) * BLOCK, len(postings.items)) - 1]
                    until = last if until is None else min(until, last)
            if shallow < slack:  # nothing up to the end of the shortest block can reach it
                following = cursors[pivot + 1][1].items[cursors[pivot + 1][0]] if pivot + 1 < len(cursors) else None
                beyond = (until if until is not None else item) + 1
                self._advance(cursors[: pivot + 1], max(item + 1, min(beyond, following or beyond)))
                continue
            if cursors[0][1].items[cursors[0][0]] == item:
                score = sum(p.scores[at] for at, p in cursors[: pivot + 1])
                if score >= slack:
                    found[item] = score
                self._advance(cursors[: pivot + 1], item + 1)
            else:
                self._advance(cursors[:pivot], item)

    @staticmethod
    def _block_of(postings: PostingList, at: int, item: int) -> int | None:
        """Block that holds the first posting at or after ``item``, by the blocks' ends."""
        block, blocks = at // BLOCK, len(postings.block_max)
        while block < blocks and postings.items[min((block + 1) * BLOCK, len(postings.items)) - 1] < item:
            block += 1
        return block if block < blocks else None

    @staticmethod
    def _advance(cursors: list, item: int) -> None:
        for c in cursors:
            c[0] = bisect_left(c[1].items, item, lo=c[0])

    # ------------------------------------------------------------ documents

    def matches(self, text: str) -> dict[int, tuple[int, float, float, float]]:
        """Verified items of a text: passages, best score, question and answer overlap."""
        best: dict[int, tuple[int, float, float, float]] = {}
        for words in self._segments(text):
            for a, terms in self._promising(words):
                passage = words[a : a + self.passage]
                for item, score in self.search(terms).items():
                    question, answer = (overlap(p, passage) for p in self.parts[item])
                    if question >= MIN_OVERLAP and answer >= MIN_OVERLAP:
                        n, s, q, r = best.get(item, (0, 0.0, 0.0, 0.0))
                        best[item] = (n + 1, max(s, score), max(q, question), max(r, answer))
        return best

    def _segments(self, text: str) -> Iterator[list[bytes]]:
        """Words of a text, piece by piece; each segment starts where a passage does."""
        words: list[bytes] = []
        half, at = self.passage // 2, 0
        while at < len(text):
            end = at + PIECE
            while end < len(text) and not text[end].isspace():
                end += 1
            words += words_of(text[at:end])
            at = end
            if at < len(text) and len(words) > self.passage:
                starts = (len(words) - self.passage) // half
                yield words[: starts * half + half]
                words = words[starts * half :]
        if words:
            yield words

    def _promising(self, words: list[bytes]) -> list[tuple[int, list[int]]]:
        """Starts and terms of the passages that could reach the threshold in some range."""
        half, rare, terms = self.passage // 2, self.rare, self.terms
        at = [i for i, w in enumerate(words) if w in rare]
        if not at:
            return []
        term = np.array([rare[words[i]] for i in at])
        part, term = np.divmod(np.unique(np.array(at) // half * len(terms) + term), len(terms))
        counts = self.starts[term + 1] - self.starts[term]
        place = np.repeat(self.starts[term] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        cell = np.repeat(part, counts) * self.ranges + self.range_ids[place]
        parts = -(-len(words) // half) + 1
        halves = np.bincount(cell, self.range_most[place], minlength=parts * self.ranges).reshape(parts, -1)
        bound = halves[:-1] + halves[1:]
        likely = np.flatnonzero((bound >= self.wanted).any(axis=1))
        return [
            (p * half, sorted({terms[w] for w in words[p * half : p * half + self.passage] if w in terms}))
            for p in likely.tolist()
        ]


LEAKS = "doc_id long, item_id long, n_passages int, score double, question_overlap double, answer_overlap double"
_LEAKS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("n_passages", pa.int32()),
        ("score", pa.float64()),
        ("question_overlap", pa.float64()),
        ("answer_overlap", pa.float64()),
    ]
)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block, number of words and distinct words of each item."""
    for batch in batches:
        words = [words_of(t.as_py()) for t in batch.column(1)]
        sizes, distinct = [len(w) for w in words], [sorted(set(w)) for w in words]
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(distinct, pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "n_words", "words"])


def item_indexes(items: DataFrame, per_index: int = ITEMS_PER_INDEX) -> Iterator[ItemIndex]:
    """Indexes of at most about ``per_index`` items each, one after the other.

    Weights and passage length are those of all items, counted in Spark, so a pair's
    score does not depend on the blocks; a block gets the counts of its own words.
    """
    rows = items.select(F.col("item_id").cast("long"), text_of().alias("text")).where(F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    blocks = -(-rows.count() // per_index)
    if not blocks:
        return
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    words = rows.select("block", "text").mapInArrow(_item_words, "block long, n_words long, words array<binary>")
    words = stage(words, "item-words")
    totals = words.agg(F.count("*").alias("n_items"), F.sum("n_words").alias("n_words"), F.max("n_words").alias("longest")).first()
    each = words.select("block", F.explode("words").alias("word"))
    found = stage(each.groupBy("word").agg(F.count("*").alias("n")), "item-counts")
    for k in range(blocks):
        own = rows.where(F.col("block") == k).collect()
        counts = found.join(each.where(F.col("block") == k), "word", "left_semi").collect()
        whole = ItemStatistics(**totals.asDict(), found={bytes(r["word"]): r["n"] for r in counts})
        yield ItemIndex(sorted(((r["item_id"], r["text"]) for r in own), key=lambda x: (x[0] is not None, x)), whole)


def find_leaks(docs: DataFrame, items: DataFrame, per_index: int = ITEMS_PER_INDEX) -> DataFrame:
    """Verified pairs of documents and test items, ``LEAKS``; clean documents have no row."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    # Rows given by Python, even none, would start a second set of Python workers.
    result = spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(LEAKS)))
    for index in item_indexes(items, per_index):
        sent = spark.sparkContext.broadcast(index)

        def search(batches, sent=sent):
            index = sent.value
            for batch in batches:
                out = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    for item, values in index.matches(text.as_py()).items():
                        out.append((doc_id, index.ids[item], *values))
                if out:
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, _LEAKS, strict=True)], schema=_LEAKS
                    )

        result = result.union(slim.mapInArrow(search, LEAKS))
    return result

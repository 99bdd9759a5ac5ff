"""Phrase collocation mining by sorted occurrence relations, one phrase length at a time.

Texts become occurrence relations: blocks of pieces of one language, each an array of
codes in the order of piece and position, with an empty slot between pieces. Phrases of
the next length come from a merge join of a relation with itself at the next position:
two codes in neighbouring slots. A block counts its own groups first and hands them on in
packed lists, dealt by hash; the lists of all blocks with the same hash are then summed,
and the codes of groups found often enough are sent back to their blocks, where the
semi-join with the relation is stored as the next relation. Every part of a frequent
phrase is frequent, so later lengths extend frequent occurrences alone and counts stay
exact.

A phrase in every text arrives at the sum once a block, and the number of lists a block
makes grows with the number of blocks, so a sum holds no more in a larger table. No table of words or
phrases is broadcast or collected. Whole texts are read; a text longer than a block is
cut between pieces, and a piece is never cut.

Null texts are empty; null languages are ``und``, together with a written ``und``. Texts
without a word give nothing; an empty table gives an empty result. Repeated rows count
each time. Ids are not read, and other columns may have any name. Equal scores are
ordered by count and then by the bytes of the phrase, so results do not depend on blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.llm.common import LOWER, UPPER, packed, text_of, unpacked
from sectorgauge.sources.stages import free_shuffles, removed_after, stage

LEAST, LONGEST, TOP = 30, 4, 2000
#: A longer candidate with this share of the occurrences replaces a shorter one.
COVERED_PERCENT = 80
SCALE = 2_000_000
#: Bytes of text that a task gathers before the language with most of them becomes a
#: block, and bits for a code within a block.
BLOCK = 12 << 20
CODE_BITS = 28
#: Blocks whose groups a sum holds about, and least number of sums.
BLOCKS_SUMMED, LEAST_SUMS = 4, 16
ENDS = b".,;:!?\n\x0b\x0c\r"

_PLAIN = bytes.maketrans(UPPER.encode() + b"\t" + ENDS, LOWER.encode() + b" " + b"\n" * len(ENDS))
_LEFT_OUT = np.int32(-1)

#: A row is a block's relation (``slots``) or a group of it (``place`` is block and code).
PIECES = "block long, slots binary, place long, lang string, word string, n long"
_PIECES = pa.schema(
    [
        ("block", pa.int64()),
        ("slots", pa.binary()),
        ("place", pa.int64()),
        ("lang", pa.string()),
        ("word", pa.string()),
        ("n", pa.int64()),
    ]
)
#: Codes in slots, and the word ids of each code.
RELATION = "block long, slots binary, grams binary"
_RELATION = pa.schema([("block", pa.int64()), ("slots", pa.binary()), ("grams", pa.binary())])
#: Groups of a block by hash: their codes (ascending, as steps), word ids column by column, and counts.
LISTS = "part int, block long, codes binary, words binary, n binary"
_LISTS = pa.schema([("part", pa.int32()), ("block", pa.int64())] + [(x, pa.binary()) for x in ("codes", "words", "n")])
#: A row is a block's frequent codes (as steps) or a frequent phrase.
FREQUENT = "block long, codes binary, gram array<long>, f long"
_FREQUENT = pa.schema([("block", pa.int64()), ("codes", pa.binary()), ("gram", pa.list_(pa.int64())), ("f", pa.int64())])


# ---------------------------------------------------------------- one block


def cut_text(text: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """A text of plain bytes in parts of about ``size``, cut between pieces."""
    at = 0
    while len(text) - at > size:
        to = text.rfind(b"\n", at, at + size)
        to = to if to > at else text.find(b"\n", at + size)
        if to < 0:
            break
        yield text[at:to]
        at = to
    yield text[at:]


def word_relation(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes in slots, the distinct words by code, and their counts; texts are plain bytes."""
    raw = b"\n".join(texts)
    data = np.frombuffer(raw, np.uint8)
    ends = data == 10
    inside = np.zeros(data.size + 2, np.int8)
    inside[1:-1] = ~(ends | (data == 32))
    edges = np.flatnonzero(np.diff(inside)).astype(np.int32)
    n = edges.size // 2
    if not n:
        return np.zeros(0, np.int32), pa.array([], pa.string()), np.zeros(0, np.int64)
    # Words and the gaps between them lie side by side; every other one is a word.
    parts = pa.Array.from_buffers(pa.binary(), 2 * n - 1, [None, pa.py_buffer(edges), pa.py_buffer(raw)])
    coded = parts.take(pa.array(np.arange(0, 2 * n - 1, 2))).dictionary_encode()
    codes = coded.indices.to_numpy()
    piece = np.cumsum(ends, dtype=np.int32)[edges[::2]]
    new = np.concatenate([[0], np.cumsum(piece[1:] != piece[:-1])])
    slots = np.full(n + int(new[-1]), _LEFT_OUT)
    slots[np.arange(n) + new] = codes
    return slots, coded.dictionary.cast(pa.string()), np.bincount(codes)


def joined(slots: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge join with the next position: places, code of the group there, groups, counts.

    A group is ``left code * codes + right code``; groups are ascending.
    """
    at = np.flatnonzero((slots[:-1] >= 0) & (slots[1:] >= 0))
    pairs = slots[at].astype(np.int64) * codes + slots[at + 1]
    groups, code, n = np.unique(pairs, return_inverse=True, return_counts=True)
    return at, code, groups, n


def longer(groups: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Word ids of joined groups: those of the left gram and the last of the right."""
    return np.hstack([grams[groups // len(grams)], grams[groups % len(grams)][:, -1:]])


# ---------------------------------------------------------------- occurrence relations


def _read_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    block = TaskContext.get().partitionId() << 15

    def flush(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal block
        sizes.pop(lang)
        slots, words, counts = word_relation(held.pop(lang))
        if slots.size:
            yield pa.RecordBatch.from_pylist([{"block": block, "slots": packed(slots)}], _PIECES)
            m = len(words)
            places = (block << CODE_BITS) + np.arange(m)
            none, langs = pa.nulls(m, pa.binary()), pa.repeat(pa.scalar(lang, pa.string()), m)
            columns = [pa.nulls(m, pa.int64()), none, pa.array(places), langs, words, pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=_PIECES)
            block += 1

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            for part in cut_text(text.as_buffer().to_pybytes().translate(_PLAIN)):
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                if sum(sizes.values()) >= BLOCK:
                    yield from flush(max(sizes, key=sizes.__getitem__))
    for lang in list(held):
        yield from flush(lang)


def _grams_of(row: dict, length: int) -> tuple[np.ndarray, np.ndarray]:
    return unpacked(row["slots"]), np.frombuffer(row["grams"], np.int64).reshape(-1, length)


def _hashed(words: np.ndarray, parts: int) -> np.ndarray:
    """Part of each row of word ids."""
    x = np.zeros(len(words), np.uint64)
    for column in words.T:
        x = (x ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
    return (x % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.int64)


def _steps(codes: np.ndarray) -> bytes:
    return packed(np.diff(codes, prepend=0).astype(np.int32))


def _of_steps(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.int64)


def _count_groups(batches: Iterator[pa.RecordBatch], length: int, parts: int) -> Iterator[pa.RecordBatch]:
    """``LISTS`` of groups of ``length + 1`` words of each block."""
    for batch in batches:
        for row in batch.to_pylist():
            slots, grams = _grams_of(row, length)
            _, _, groups, n = joined(slots, len(grams))
            if not groups.size:
                continue
            words = longer(groups, grams)
            part = _hashed(words, parts)
            codes = np.argsort(part, kind="stable")
            part = part[codes]
            cuts, out = [*np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist(), part.size], []
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                own = codes[a:z]
                columns = words[own].T.copy()
                columns[0] = np.diff(columns[0], prepend=0)  # ids of first words ascend with the codes
                out.append((int(part[a]), row["block"], _steps(own), packed(columns.ravel()), packed(n[own].astype(np.int32))))
            yield pa.RecordBatch.from_pylist([dict(zip(_LISTS.names, x, strict=True)) for x in out], _LISTS)


def _sum_groups(lists: pa.Table, length: int, least: int) -> pa.Table:
    """``FREQUENT`` of all lists of a part."""
    blocks, codes, words, n = (lists[c].to_pylist() for c in _LISTS.names[1:])
    codes = [_of_steps(x) for x in codes]
    columns = [unpacked(x, "<i8").reshape(length, -1) for x in words]
    words = np.concatenate([np.vstack([np.cumsum(c[:1], axis=1), c[1:]]) for c in columns], axis=1)
    del columns
    n = np.concatenate([unpacked(x) for x in n]).astype(np.int64)
    order = np.lexsort(words[::-1])
    words = words[:, order]
    first = np.flatnonzero(np.append(True, (words[:, 1:] != words[:, :-1]).any(axis=0)))
    f = np.add.reduceat(n[order], first)
    often = f >= least
    kept = np.zeros(n.size, bool)
    kept[order] = np.repeat(often, np.diff(np.append(first, n.size)))
    grams = words[:, first[often]].T
    out = [{"gram": g, "f": x} for g, x in zip(grams.tolist(), f[often].tolist(), strict=True)]
    at = 0
    for block, own in zip(blocks, codes, strict=True):
        frequent = own[kept[at : at + own.size]]
        at += own.size
        if frequent.size:
            out.append({"block": block, "codes": _steps(frequent)})
    return pa.Table.from_pylist(out, _FREQUENT)


def _words_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Relations of single words from blocks of words and their kept places, which bring the word ids.

    A block's kept places come first, then its words. Codes follow the order of the ids, so
    that groups of any length ascend by the ids of their words.
    """
    mask = (1 << CODE_BITS) - 1
    kept: list[np.ndarray] = []
    ids: list[np.ndarray] = []
    for batch in batches:
        blocks = batch.column("slots").is_valid().to_numpy(zero_copy_only=False)
        places = batch.column("place").fill_null(0).to_numpy()
        word_ids = batch.column("id").fill_null(0).to_numpy()
        start = 0
        for at in np.flatnonzero(blocks).tolist():
            kept.append(places[start:at] & mask)
            ids.append(word_ids[start:at])
            start = at + 1
            codes, grams = np.concatenate(kept), np.concatenate(ids)
            order = np.argsort(grams)
            row = batch.slice(at, 1).to_pylist()[0]
            kept, ids = [], []
            if codes.size:
                new = _renumbered(unpacked(row["slots"]), codes[order])
                out = {"block": row["block"], "slots": packed(new), "grams": grams[order].tobytes()}
                yield pa.RecordBatch.from_pylist([out], _RELATION)
        kept.append(places[start:] & mask)
        ids.append(word_ids[start:])


def _semi_join(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Relations of ``length`` words from those a word shorter and the kept codes.

    A block's lists of kept codes come first, then its relation.
    """
    kept: list[np.ndarray] = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["slots"] is None:
                kept.append(_of_steps(row["codes"]))
                continue
            codes, kept = np.sort(np.concatenate([np.zeros(0, np.int64), *kept])), []
            if codes.size:
                slots, shorter = _grams_of(row, length - 1)
                found, code, groups, _ = joined(slots, len(shorter))
                new = np.full(slots.size, _LEFT_OUT)
                new[found] = _renumbered(code.astype(np.int32), codes)
                grams = np.ascontiguousarray(longer(groups[codes], shorter))
                yield pa.RecordBatch.from_pylist([{"block": row["block"], "slots": packed(new), "grams": grams.tobytes()}], _RELATION)


def _renumbered(codes: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Place of each code among the kept ones; the others are left out."""
    table = np.full(max(int(codes.max(initial=-1)), int(kept.max(initial=-1))) + 2, _LEFT_OUT)
    table[kept] = np.arange(kept.size)
    return table[codes]  # an empty slot is -1, the last entry of the table


def _kept_words(pieces: DataFrame, kept: DataFrame) -> DataFrame:
    """Stored relations of the blocks of words with the kept places."""
    blocks = pieces.select("block", "slots", F.lit(None).cast("long").alias("place"), F.lit(0).cast("long").alias("id"))
    places = kept.select(F.shiftright("place", CODE_BITS).alias("block"), F.lit(None).cast("binary").alias("slots"), "place", "id")
    together = blocks.union(places).repartition("block").sortWithinPartitions("block", F.col("place").asc_nulls_last())
    return stage(together.mapInArrow(_words_left, RELATION), "relation1")


def _kept_relation(relations: DataFrame, kept: DataFrame, length: int) -> DataFrame:
    """Stored semi-join of the blocks with the kept codes of their groups."""
    none = F.lit(None).cast("binary")
    blocks = relations.select("block", "slots", "grams", none.alias("codes"))
    codes = kept.where("block is not null").select("block", none.alias("slots"), none.alias("grams"), "codes")
    together = blocks.union(codes).repartition("block").sortWithinPartitions("block", F.col("slots").isNotNull())
    return stage(together.mapInArrow(partial(_semi_join, length=length), RELATION), f"relation{length}")


# ---------------------------------------------------------------- frequent phrases


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored ``gram, f`` of all frequent phrases, ``id, lang, word`` and ``lang, n``.

    ``gram`` is an array of word ids; ids belong to a language. ``n`` counts all words.
    """
    spark = docs.sparkSession
    slim = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")), text_of())
    with removed_after(spark) as spent:
        pieces = stage(slim.mapInArrow(_read_texts, PIECES), "pieces")
        groups = pieces.where("place is not null")
        totals = stage(groups.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
        kept = stage(_frequent_words(groups, least), "kept")
        words = stage(kept.where("f is not null").select("id", "lang", "word", "f"), "words")
        free_shuffles(spark)
        relation = _kept_words(pieces.where("slots is not null"), kept)
        _stay(spent, "totals", "words", "relation")
    phrases = words.select(F.array("id").alias("gram"), "f")
    for length in range(2, longest + 1):
        with removed_after(spark) as spent:
            free_shuffles(spark)
            kept = stage(_frequent_groups(relation, length, least), "kept")
            phrases = phrases.union(stage(kept.where("f is not null").select("gram", "f"), "found"))
            if length < longest:
                relation = _kept_relation(relation, kept, length)
            _stay(spent, "found", "relation")
    return stage(phrases, "phrases"), words.select("id", "lang", "word"), totals


def _stay(spent: list[str], *names: str) -> None:
    """Take the stages of these names from the list of those to remove."""
    spent[:] = [path for path in spent if not path.rpartition("/")[2].startswith(names)]


def _frequent_words(groups: DataFrame, least: int) -> DataFrame:
    """``place, id`` of every frequent word in its blocks; one row of a word has it and ``f``.

    The id of a word is its least place.
    """
    same = Window.partitionBy("lang", "word")
    summed = groups.select("place", "lang", "word", F.sum("n").over(same).alias("f"), F.min("place").over(same).alias("id"))
    once = F.col("place") == F.col("id")
    named = (F.when(once, F.col(c)).alias(c) for c in ("lang", "word", "f"))
    return summed.where(F.col("f") >= least).select("place", "id", *named)


def _frequent_groups(relation: DataFrame, length: int, least: int) -> DataFrame:
    """``FREQUENT`` phrases of ``length`` words, and their codes in the blocks."""
    parts = max(LEAST_SUMS, relation.count() // BLOCKS_SUMMED)
    lists = relation.mapInArrow(partial(_count_groups, length=length - 1, parts=parts), LISTS)

    def run(table: pa.Table) -> pa.Table:
        return _sum_groups(table, length, least)

    return lists.groupBy("part").applyInArrow(run, FREQUENT)


# ---------------------------------------------------------------- scores


def _cut_scores(phrases: DataFrame) -> DataFrame:
    """``gram, a, cut`` of phrases of two words or more; ``cut`` is the lowest-scoring one."""
    part = lambda name, f: phrases.select(F.col("gram").alias(name), F.col("f").alias(f))
    size = F.size("gram")
    cuts = phrases.where(size > 1).select("gram", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("gram", 1, F.col("k")).alias("first"), F.slice("gram", F.col("k") + 1, size - F.col("k")).alias("rest"))
    both = cuts.join(part("first", "l"), "first").join(part("rest", "r"), "rest")
    score = F.expr(f"(cast(a as decimal(28,0)) * {SCALE}) div (cast(l as decimal(28,0)) + r)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return both.groupBy("gram", "a").agg(best.alias("cut"))


def _covered(phrases: DataFrame) -> DataFrame:
    """``gram, longer``: the most occurrences of a phrase one word longer around it.

    A phrase two words longer that holds it has one of these inside, at least as frequent.
    """
    size = F.size("gram")
    inner = F.array(F.slice("gram", 1, size - 1), F.slice("gram", 2, size - 1))
    return phrases.where(size > 2).select(F.explode(inner).alias("gram"), "f").groupBy("gram").agg(F.max("f").alias("longer"))


def _spelled(scored: DataFrame, words: DataFrame) -> DataFrame:
    """``scored`` with ``lang`` and ``phrase``."""
    place = scored.select("gram", F.posexplode("gram").alias("at", "id"))
    found = place.join(words, "id").groupBy("gram").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled")
    )
    return scored.join(found.select("gram", "lang", F.concat_ws(" ", "spelled.word").alias("phrase")), "gram")


def first_of_each(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language; parts of a language are ranked before the whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = 1 + isqrt(scored.count() // top)
    salted = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    ranked = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    return ranked(ranked(salted, "lang", "part").drop("rank", "part"), "lang")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``top`` phrases."""
    phrases, words, totals = frequent_phrases(docs, least, longest)
    scored = _cut_scores(phrases).join(_covered(phrases), "gram", "left")
    scored = scored.where((100 * F.coalesce("longer", F.lit(0)).cast("decimal(28,0)")) < COVERED_PERCENT * F.col("a").cast("decimal(28,0)"))
    spelled = stage(_spelled(scored.select("gram", "a", "cut.*"), words), "scored")
    named = totals.select(F.col("lang").alias("of"), "n")
    ranked = first_of_each(spelled, top).join(named, F.col("lang") == F.col("of"))
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Language-model scores by prediction with partial matching over bytes.

A text is its token sequence: words lower-cased in A-Z, one space between, a line feed
as the end. Every byte is predicted from the longest context of up to ``ORDER`` bytes
that training rows have. A symbol unseen there costs an escape, estimated from the number
of different symbols seen (method C), and the next shorter context decides, without the
symbols that the longer one already excluded. Last comes a uniform choice among the bytes
never seen. The code lengths of all bytes, and so the probabilities of all token
sequences, sum to one.

The price of a byte depends on the ``ORDER + 1``-gram that ends in it alone. Tasks count
these and Spark adds them up, none is dropped. Grams that agree in the ``NEAR`` bytes
before the last one are priced together: they hold all longer contexts that end in these
bytes, and shorter ones need only the counts of pairs of bytes. A context's symbols are
symbols of every shorter one too, so they can be excluded by one subtraction.

Grams with at least ``1 / MAX_NODES`` of all bytes, at most that many, travel to the
executors with their prices. The others of a text are asked for: a task hands on packed
lists of them by block of grams, the blocks add prices up by row, and rows get the sums.
Texts of a task share its lists, so a gram goes once for all of them.

The base score counts words exactly. Words with at least ``1 / TOP_WORDS`` of the
training tokens, at most that many, travel to the executors; all others are joined, a
word of a list once with the rows that it is in.

Null and empty texts have the end token only. Repeated rows are scored one by one. With
no training rows every byte costs the uniform choice. Other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from math import log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorgauge.llm.common import packed, text_of, unpacked
from sectorgauge.sources.stages import free_shuffles, stage

ORDER = 5
MAX_NODES = 1 << 19
TOP_WORDS = 1 << 17
END = b"\n"
#: Bytes that are worked on at once.
HELD = 1 << 17
#: Bytes before the last one by which grams are priced together; a table of 256 to this plus one.
NEAR = 2
#: Rows that are scored before they are handed on.
SCORED_ROWS = 1 << 10
#: Blocks of grams that prices are asked from; grams and rows that wait before they are asked for.
BLOCKS = 64
ASKED, ASKED_ROWS = 1 << 21, 1 << 16
#: Grams that a task collects before it counts them; counts and words that it holds.
GRAMS_NEW, GRAMS_HELD, WORDS_HELD = 1 << 20, 1 << 22, 1 << 19


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased."""
    return text.lower().split()


def coded(words: list[bytes], order: int = ORDER) -> np.ndarray:
    """The byte sequence of a text after the context of its start, ``order`` line feeds."""
    return np.frombuffer(END * order + b" ".join(words) + END, np.uint8)


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """Grams of up to eight bytes as numbers, the last byte lowest."""
    n = data.size - length + 1
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out = (out << np.uint64(8)) | data[j : j + n]
    return out


# ---------------------------------------------------------------- prices of grams


def _log(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


def _sums(place: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(place, n, minlength=size).astype(float)


def prices(gram: np.ndarray, n: np.ndarray, pairs: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log10 probability of the last byte of each gram, given the ``order`` bytes before.

    ``gram, n``: all grams that share the ``NEAR`` bytes before the last one, with their
    training counts, which may be 0. ``pairs[a, b]``: count of the byte b after a.
    """
    price = np.zeros(gram.size)
    last = (gram & np.uint64(255)).astype(np.int64)
    before = ((gram >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
    settled = np.zeros(gram.size, bool)
    longer_d = longer_shared = None  # of the next longer context, once one is usable
    for k in range(order, -1, -1):
        if k < NEAR:
            table = pairs if k else pairs.sum(axis=0)[None]
            context = before if k else np.zeros_like(before)
            symbol_n = table[context, last].astype(float)
            context_n, context_d = table.sum(axis=1).astype(float)[context], (table > 0).sum(axis=1).astype(float)[context]
            shorter = pairs.sum(axis=0)[None]
            shared = np.where(table > 0, shorter, 0).sum(axis=1).astype(float)[context] if k else np.zeros(gram.size)
        else:
            own = gram & np.uint64((1 << (8 * (k + 1))) - 1)
            names, place = np.unique(own, return_inverse=True)
            counts = _sums(place, n, names.size)
            contexts, parent = np.unique(names >> np.uint64(8), return_inverse=True)
            short = names & np.uint64((1 << (8 * k)) - 1)
            if k == NEAR:
                at = short.astype(np.int64)
                short_n = (pairs[at >> 8, at & 255]).astype(float)
            else:
                all_short, short_place = np.unique(gram & np.uint64((1 << (8 * k)) - 1), return_inverse=True)
                short_n = _sums(short_place, n, all_short.size)[np.searchsorted(all_short, short)]
            seen = counts > 0
            symbol_n = counts[place]
            context_n = _sums(parent, counts, contexts.size)[parent][place]
            context_d = _sums(parent, seen, contexts.size)[parent][place]
            shared = _sums(parent, np.where(seen, short_n, 0), contexts.size)[parent][place]
        # Counts and number of the symbols that the longer contexts don't exclude.
        if longer_d is None:
            longer_d, longer_shared = np.zeros(gram.size), np.zeros(gram.size)
        rest, others = context_n - longer_shared, context_d - longer_d
        hit = ~settled & (symbol_n > 0)
        price += np.where(hit, _log(symbol_n) - _log(np.maximum(rest + others, 1)), 0)
        settled |= hit
        price += np.where(~settled & (rest > 0), _log(others) - _log(rest + others), 0)
        longer_d, longer_shared = context_d, shared
    return price - np.where(settled, 0, np.log10(np.maximum(1, 256 - longer_d)))


def _block(gram: np.ndarray) -> np.ndarray:
    """Block of each gram: the high bits of a product that mixes all of its bytes."""
    return (gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(BLOCKS)


# ---------------------------------------------------------------- counting on Spark

COUNTS = "gram long, word binary, n long, times long"
_COUNTS = pa.schema([("gram", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("times", pa.int64())])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64)


def count_all(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """``COUNTS``: longest grams (word null) and tokens (gram null), stored.

    ``n``: occurrences in training rows; ``times``: in all rows. Tokens are those of
    training rows, grams those of all rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        held: tuple[list[np.ndarray], list[np.ndarray]] = [], []  # training, held out
        known, size = np.zeros((3, 0), np.int64), 0

        def merged() -> np.ndarray:
            grams_, counts = [known[0]], [known[1:]]
            for out, lists in enumerate(held):
                if lists:
                    new, n = np.unique(np.concatenate(lists), return_counts=True)
                    grams_.append(_signed(new))
                    counts.append(np.stack([n * (1 - out), n]))
            both, place = np.unique(np.concatenate(grams_), return_inverse=True)
            n = np.concatenate(counts, axis=1)
            return np.stack([both, *(np.bincount(place, x, both.size).astype(np.int64) for x in n)])

        def gram_rows(x: np.ndarray) -> pa.RecordBatch:
            none = pa.nulls(x.shape[1], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x[0]), none, pa.array(x[1]), pa.array(x[2])], schema=_COUNTS)

        def word_rows() -> pa.RecordBatch:
            n = pa.array(words.values(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int64()), pa.array(words, pa.binary()), n, n], schema=_COUNTS)

        for batch in batches:
            for text, out in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
                tokens = tokens_of(text.as_buffer().to_pybytes())
                data = coded(tokens, order)
                if not out:
                    words.update(tokens)
                    words[END] += 1
                held[bool(out)].append(grams(data, order + 1))
                size += data.size - order
                if size >= GRAMS_NEW:
                    known, held, size = merged(), ([], []), 0
                    if known.shape[1] >= GRAMS_HELD:
                        yield gram_rows(known)
                        known = np.zeros((3, 0), np.int64)
                if len(words) >= WORDS_HELD:
                    yield word_rows()
                    words.clear()
        known = merged()
        for a in range(0, known.shape[1], WORDS_HELD):
            yield gram_rows(known[:, a : a + WORDS_HELD])
        if words:
            yield word_rows()

    partial = docs.select(text_of().alias("text"), held_out.alias("held_out")).mapInArrow(run, COUNTS)
    return stage(partial.groupBy("gram", "word").agg(F.sum("n").alias("n"), F.sum("times").alias("times")), "counts")


PRICED = "block int, chunk long, grams binary, each binary, slots binary"
_PRICED = pa.schema([("block", pa.int32()), ("chunk", pa.int64())] + [(x, pa.binary()) for x in ("grams", "each", "slots")])


def _packed(block: int, chunk: int | None, *arrays: np.ndarray | None) -> dict:
    """A row of ``PRICED``; sorted grams are stored as steps, which take less room."""
    grams_, *others = arrays
    steps = np.diff(grams_, prepend=np.uint64(0))
    return dict(zip(_PRICED.names, (block, chunk, *(None if x is None else packed(x) for x in (steps, *others))), strict=True))


def _unpacked(grams_: bytes) -> np.ndarray:
    return np.cumsum(unpacked(grams_, "<u8"), dtype=np.uint64)


def price_grams(counts: DataFrame, order: int = ORDER, max_nodes: int = MAX_NODES) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``PRICED`` (chunk null) of all grams by block, stored, and the frequent ones with their prices."""
    longest = counts.where("gram is not null").select("gram", "n", "times")
    total = longest.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    least = max(1, -(-total // max_nodes))
    pairs = np.zeros((256, 256), np.int64)
    by_pair = longest.groupBy(F.col("gram").bitwiseAND(F.lit(65535)).alias("pair")).agg(F.sum("n").alias("n"))
    for r in by_pair.collect():
        pairs[r["pair"] >> 8, r["pair"] & 255] = r["n"]

    def run(table: pa.Table) -> pa.Table:
        gram, n, times = (table[c].to_numpy() for c in ("gram", "n", "times"))
        at = np.argsort(gram)
        gram, n, often = gram[at].astype(np.uint64), n[at], times[at] >= least
        price, block = prices(gram, n, pairs, order), _block(gram)
        rows = []
        for b, chosen in [(-1, often), *((x, (block == x) & ~often) for x in np.unique(block).tolist())]:
            if chosen.any():
                rows.append(_packed(b, None, gram[chosen], price[chosen], None))
        return pa.Table.from_pylist(rows, schema=_PRICED)

    near = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << (8 * NEAR)) - 1))
    priced = stage(longest.withColumn("near", near).groupBy("near").applyInArrow(run, PRICED), "prices")
    rows = priced.where("block = -1").select("grams", "each").collect()
    gram = np.concatenate([np.zeros(0, np.uint64), *(_unpacked(r["grams"]) for r in rows)])
    price = np.concatenate([np.zeros(0), *(unpacked(r["each"], "<f8") for r in rows)])
    at = np.argsort(gram)
    return priced.where("block >= 0"), gram[at], price[at]


# ---------------------------------------------------------------- scoring on Spark

SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_top long, top_sum double, score double, word binary, " + PRICED
)
_SCORED = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
        ("n_top", pa.int64()), ("top_sum", pa.float64()), ("score", pa.float64()),
        ("word", pa.binary()), *_PRICED,
    ]
)


def _asked(chunk: int, gram: np.ndarray, slot: np.ndarray) -> list[dict]:
    """Packed lists by block: the different grams, how often each comes, and the rows they are in."""
    if gram.max() < 1 << 48:  # a gram and its row in one number are sorted fastest
        both = np.sort(gram << np.uint64(16) | slot)
        gram, slot = both >> np.uint64(16), both.astype(np.uint16)
    else:
        order = np.argsort(gram, kind="stable")
        gram, slot = gram[order], slot[order]
    first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
    names, each = gram[first], np.diff(np.append(first, gram.size))
    block = _block(names).astype(np.uint16)
    order = np.argsort(block, kind="stable")
    block, names, each = block[order], names[order], each[order]
    ends = np.cumsum(each)
    slot = slot[np.repeat(first[order] - ends + each, each) + np.arange(slot.size)]
    cuts, out = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), block.size), []
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        own = slot[ends[a] - each[a] : ends[z - 1]]
        out.append(_packed(int(block[a]), chunk, names[a:z], each[a:z].astype(np.uint32), own))
    return out


def _asked_words(chunk: int, words: list[pa.Array], slot: np.ndarray) -> pa.RecordBatch:
    """A row for every different word, with the rows that it is in."""
    coded = pa.concat_arrays(words).dictionary_encode()
    codes, n = coded.indices.to_numpy(), len(coded.dictionary)
    ends = np.cumsum(np.append(0, np.bincount(codes, minlength=n)), dtype=np.int32) * np.int32(slot.itemsize)
    slots = slot[np.argsort(codes, kind="stable")].tobytes()
    own = {
        "word": coded.dictionary,
        "chunk": pa.repeat(pa.scalar(chunk, pa.int64()), n),
        "slots": pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(slots)]),
    }
    return pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(n, f.type)) for f in _SCORED], schema=_SCORED)


def score_texts(
    docs: DataFrame, gram: np.ndarray, price: np.ndarray, top: dict[bytes, float], held_out: Column, order: int = ORDER
) -> DataFrame:
    """``SCORED``, stored: of every row what frequent grams and top words say, and what is asked for.

    That is ``PRICED`` lists of the other grams, and the other words (``word, chunk, slots``).
    Texts are worked on about ``HELD`` bytes or words at once. Lists have grams and words of up
    to ``ASKED_ROWS`` rows from number ``chunk`` on; those of a long text may be in several lists.
    """
    sent = docs.sparkSession.sparkContext.broadcast((gram, price, top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, price, top = sent.value
        row = chunk = TaskContext.get().partitionId() << 33
        open_: list[tuple[int, np.ndarray]] = []
        open_words: list[tuple[int, list[bytes]]] = []
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        words_waiting: list[tuple[pa.Array, np.ndarray]] = []
        n_open = n_open_words = n_waiting = 0

        def asked() -> Iterator[pa.RecordBatch]:
            nonlocal waiting, words_waiting, n_waiting
            if waiting:
                lists = _asked(chunk, *(np.concatenate(x) for x in zip(*waiting, strict=True)))
                yield pa.RecordBatch.from_pylist(lists, schema=_SCORED)
            if words_waiting:
                words, slots = zip(*words_waiting, strict=True)
                yield _asked_words(chunk, list(words), np.concatenate(slots))
            waiting, words_waiting, n_waiting = [], [], 0

        def look_up(first: int, rows: int) -> np.ndarray:
            """Sums of known prices from row ``first`` on; the other grams wait with their rows."""
            nonlocal open_, n_open, n_waiting
            if not open_:
                return np.zeros(rows)
            whole = np.concatenate([g for _, g in open_])
            of = np.repeat([r for r, _ in open_], [g.size for _, g in open_])
            names, place = np.unique(whole, return_inverse=True)
            value, has = np.zeros(names.size), np.zeros(names.size, bool)
            if known.size:
                at = np.minimum(np.searchsorted(known, names), known.size - 1)
                has = known[at] == names
                value = np.where(has, price[at], 0)
            missing = ~has[place]
            if missing.any():
                waiting.append((whole[missing], (of[missing] - chunk).astype(np.uint16)))
                n_waiting += waiting[-1][0].size
            open_, n_open = [], 0
            return np.bincount(of - first, value[place], rows)

        def look_up_words(first: int, rows: int) -> np.ndarray:
            """Numbers and sums of top words from row ``first`` on; the other words wait with their rows."""
            nonlocal open_words, n_open_words, n_waiting
            if not open_words:
                return np.zeros((2, rows))
            of = np.repeat([r for r, _ in open_words], [len(w) for _, w in open_words])
            coded = pa.array([w for _, own in open_words for w in own], pa.binary()).dictionary_encode()
            codes = coded.indices.to_numpy()
            value = np.array([top.get(w, np.nan) for w in coded.dictionary.to_pylist()])[codes]
            has = ~np.isnan(value)
            if not has.all():
                words_waiting.append((coded.dictionary.take(pa.array(codes[~has])), (of[~has] - chunk).astype(np.uint16)))
                n_waiting += words_waiting[-1][1].size
            open_words, n_open_words = [], 0
            return np.stack([np.bincount(of - first, w, rows) for w in (has, np.where(has, value, 0))])

        for batch in (b.slice(a, SCORED_ROWS) for b in batches for a in range(0, b.num_rows, SCORED_ROWS)):
            first, n = row, batch.num_rows
            sums, of_words, n_tokens = np.zeros(n), np.zeros((2, n)), []
            for text in batch.column(2).cast(pa.binary()):
                tokens = tokens_of(text.as_buffer().to_pybytes())
                own = grams(coded(tokens, order), order + 1)
                tokens.append(END)
                n_tokens.append(len(tokens))
                full = row - chunk >= ASKED_ROWS - 1
                for a in range(0, own.size, HELD):
                    open_.append((row, own[a : a + HELD]))
                    n_open += open_[-1][1].size
                    if n_open >= HELD:
                        sums += look_up(first, n)
                    if n_waiting >= ASKED or full:
                        sums += look_up(first, n)
                        of_words += look_up_words(first, n)
                        yield from asked()
                        chunk = row
                        full = False
                for a in range(0, len(tokens), HELD):
                    open_words.append((row, tokens[a : a + HELD]))
                    n_open_words += len(open_words[-1][1])
                    if n_open_words >= HELD:
                        of_words += look_up_words(first, n)
                row += 1
            sums += look_up(first, n)
            of_words += look_up_words(first, n)
            if n_tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(first, row), pa.int64()), batch.column(0), batch.column(1),
                        pa.array(n_tokens, pa.int64()), pa.array(of_words[0].astype(np.int64)), pa.array(of_words[1]),
                        pa.array(sums), pa.nulls(n, pa.binary()), *(pa.nulls(n, f.type) for f in _PRICED),
                    ],
                    schema=_SCORED,
                )
        yield from asked()

    slim = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), text_of().alias("text"))
    return stage(slim.mapInArrow(run, SCORED), "scored")


def sums_of_asked(priced: DataFrame, asked: DataFrame) -> DataFrame:
    """``row, asked``: sums of the prices of the grams in packed lists, for every list of a row.

    A block's prices come first in its task, then its lists one by one.
    """
    answer = pa.schema([("chunk", pa.int64()), ("slots", pa.binary()), ("sums", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, parts, known = None, [], None
        for batch in batches:
            for block, chunk, *lists in zip(*(batch.column(x).to_pylist() for x in _PRICED.names), strict=True):
                names = _unpacked(lists[0])
                if block != of:
                    of, parts, known = block, [], None
                if chunk is None:
                    parts.append((names, unpacked(lists[1], "<f8")))
                    continue
                if known is None:
                    gram, price = (np.concatenate(x) for x in zip(*parts, strict=True))
                    at = np.argsort(gram)
                    known, price, parts = gram[at], price[at], []
                each, slots = unpacked(lists[1], "<u4"), unpacked(lists[2], "<u2")
                value = np.repeat(price[np.searchsorted(known, names)], each)
                rows = np.flatnonzero(np.bincount(slots)).astype(np.uint16)
                sums = np.bincount(slots, value)[rows]
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "slots": rows.tobytes(), "sums": sums.tobytes()}], schema=answer)

    def add(table: pa.Table) -> pa.Table:
        slots = np.concatenate([np.frombuffer(x, np.uint16) for x in table["slots"].to_pylist()])
        sums = np.concatenate([np.frombuffer(x) for x in table["sums"].to_pylist()])
        rows = np.unique(slots)
        return pa.table({"row": table["chunk"][0].as_py() + rows.astype(np.int64), "asked": np.bincount(slots, sums)[rows]})

    lists = priced.unionByName(asked).repartition(BLOCKS, "block").sortWithinPartitions("block", F.col("chunk").isNotNull())
    found = lists.mapInArrow(run, "chunk long, slots binary, sums binary")
    return found.groupBy("chunk").applyInArrow(add, "row long, asked double")


def sums_of_words(asked: DataFrame, words: DataFrame) -> DataFrame:
    """``row, n_rare, rare_sum``: known words and sums of log10(n + 0.5) of asked words, for every list of a row.

    ``asked``: ``word, chunk, slots``; ``words``: ``word, n``.
    """

    def add(table: pa.Table) -> pa.Table:
        slots, n = (table[c].to_pylist() for c in ("slots", "n"))
        of = np.frombuffer(b"".join(slots), np.uint16)
        n = np.repeat(np.array(n, np.int64), [len(x) // 2 for x in slots])
        rows = np.unique(of)
        known, sums = (np.bincount(of, x)[rows] for x in (n > 0, np.log10(n + 0.5)))
        return pa.table({"row": table["chunk"][0].as_py() + rows.astype(np.int64), "n_rare": known.astype(np.int64), "rare_sum": sums})

    found = asked.join(words, "word", "left").select("chunk", "slots", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return found.groupBy("chunk").applyInArrow(add, "row long, n_rare long, rare_sum double")


def score_documents(docs: DataFrame, held_out: Column, order: int = ORDER, max_nodes: int = MAX_NODES, top_words: int = TOP_WORDS) -> DataFrame:
    """Scores of all rows by a model of those that aren't held out.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    """
    counts = count_all(docs, held_out, order)
    words = counts.where("word is not null").select("word", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    log_all = log10(total + 0.5 * (distinct + 1))
    often = words.where(F.col("n") * top_words >= total)
    top = {bytes(r["word"]): log10(r["n"] + 0.5) for r in often.collect()}
    priced, gram, price = price_grams(counts, order, max_nodes)
    both = score_texts(docs, gram, price, top, held_out, order)
    scored = both.where("row is not null").drop("word", *priced.columns)
    asked = stage(sums_of_asked(priced, both.where("block is not null").select(*priced.columns)), "asked")
    free_shuffles(docs.sparkSession)
    of_words = sums_of_words(both.where("word is not null").select("word", "chunk", "slots"), words)
    of_words = of_words.select("*", F.lit(0.0).alias("asked"))
    of_grams = asked.select("row", F.lit(0).cast("long").alias("n_rare"), F.lit(0.0).alias("rare_sum"), "asked")
    per_row = of_words.union(of_grams).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n_rare", "rare_sum", "asked")))
    none = F.lit(0)
    return scored.join(per_row, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_top") + F.coalesce("n_rare", none)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("top_sum") + F.coalesce("rare_sum", none) - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        (F.col("score") + F.coalesce("asked", none)).alias("score"),
    )

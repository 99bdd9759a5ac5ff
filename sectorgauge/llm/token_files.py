"""Token ids in fixed-width bit-packed files.

Documents are dealt to tasks by ranges of their id, sorted, encoded, and written as
blocks. A block holds its ids in the minimum bits of the vocabulary, little-endian bit
order, with the offset of its first id in its file and the place of each document;
``file`` and ``files`` give the first id of each file. So any id is found from offsets
alone and unpacked by numpy without reading what is before it. A block is closed by the
document that brings it to ``limit`` ids; one that would bring it beyond twice as many
goes on in the next block, where its entry says how many of its ids came before.

The container is a Parquet table with one row per block: Spark commits whole files, a
lost executor costs its unfinished blocks, and any store that Spark reaches will do.

Null texts are empty and get the end id only. Rows are ordered by id (null first), text
hash and text, so repeated ids have one order. An empty table gives an empty result.
Only ``doc_id`` and ``text`` are read, so other columns may have any name. A very long
text is encoded in parts and spread over blocks; only its checksum is put together.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sectorgauge.llm.common import text_of
from sectorgauge.sources.stages import stage

BLOCK_IDS = 1 << 16
#: Bytes of text that are encoded at once.
GATHER = 2 << 20
#: Words whose ids a worker remembers from one lot of texts to the next, about so many.
WORDS_KEPT = 1 << 18
#: Words that are encoded at once.
LEARNED = 1 << 12
#: Words of letters that the tokenizer gets as one text.
TOGETHER = 64

BLOCKS = (
    "file int, block int, first long, n_ids int, bits int, payload binary, "
    "docs array<struct<doc_id:long,start:int,n_ids:int,before:long,ends:boolean>>"
)
_ENTRY = pa.struct(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int32()),
        ("n_ids", pa.int32()),
        ("before", pa.int64()),
        ("ends", pa.bool_()),
    ]
)
_BLOCKS = pa.schema(
    [
        ("file", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int32()),
        ("bits", pa.int32()),
        ("payload", pa.binary()),
        ("docs", pa.list_(_ENTRY)),
    ]
)

# ---------------------------------------------------------------- bits


def bits_for(vocabulary: int) -> int:
    """Bits that tell all ids of a vocabulary apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits`` each, lowest bit first."""
    ids = np.ascontiguousarray(ids, "<u4")
    if ids.size and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):  # the same bytes, without a look at single bits
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(each[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from place ``start``; reads only the bytes they lie in."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count, start * bits // 8).astype("<u4")
    first = start * bits
    lead = first % 8
    raw = np.frombuffer(payload, np.uint8)[first // 8 : (first + count * bits + 7) // 8]
    flat = np.unpackbits(raw, bitorder="little", count=lead + count * bits)[lead:]
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = flat.reshape(count, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


# ---------------------------------------------------------------- tokenizer


class WordEncoder:
    """Encodes texts word by word with a tokenizer that lower-cases and drops white space.

    Such a tokenizer never joins text across white space, so a text's ids are its words'
    ids in a row. Texts are cut into words and dictionary-encoded together; each word is
    encoded once and remembered. Where the tokenizer also keeps a closing comma or full
    stop apart from a letter or digit before it, so does this, and words are fewer.

    Words of letters are encoded some dozens as one text if the vocabulary marks the ends
    of words on bytes: each has one marked id at least, so when a text has as many as it
    has words, every word ends at its own. Other texts and words are encoded word by word.

    Words are remembered in two halves. When the newer one is full it becomes the older
    and the older is forgotten; a word that is met again moves to the newer, so frequent
    words stay and a worker's memory is bounded.
    """

    #: Kinds of bytes, for ``bytes.translate``.
    _SPACE, _CLOSING, _BEFORE = 1, 2, 3
    _KINDS = bytes(
        1 if b in b" \t\n\x0b\x0c\r" else 2 if b in b",." else 3 if b in b"abcdefghijklmnopqrstuvwxyz0123456789" else 0
        for b in range(256)
    )

    def __init__(self, path: str, kept: int = WORDS_KEPT):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.type = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.kept = kept
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        if ids("Ab") != ids("ab") or ids("ab cd") != ids("ab") + ids(" cd "):
            raise ValueError("this tokenizer doesn't drop case and white space")
        self.apart = all(ids(f"{a}{b}") == ids(a) + ids(b) for a in ("ab", "7", "x7") for b in ",.")
        self.last = self._last_of_words()

    def _last_of_words(self) -> np.ndarray | None:
        """Whether an id ends a word, if every byte has such an id and so no word goes without."""
        from tokenizers import pre_tokenizers

        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        signs = pre_tokenizers.ByteLevel.alphabet()
        if not mark or "ByteLevel" not in repr(self.tokenizer.pre_tokenizer) or any(s + mark not in vocabulary for s in signs):
            return None
        last = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        last[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        return last

    def _learn(self, words: list[bytes]) -> None:
        for at in range(0, len(words), LEARNED):
            single: list[str] = []
            plain: list[str] = []
            for word in words[at : at + LEARNED]:
                text = word.decode()
                (plain if self.last is not None and text.isalpha() else single).append(text)
            parts = [plain[k : k + TOGETHER] for k in range(0, len(plain), TOGETHER)]
            texts = [" ".join(part) for part in parts]
            for part, coded in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(coded.ids, self.type)
                ends = np.flatnonzero(self.last[ids]) + 1
                if ends.size == len(part):
                    self._remember(part, ids, ends)
                else:
                    single += part
            if single:
                coded = self.tokenizer.encode(single, is_pretokenized=True, add_special_tokens=False)
                ends = np.searchsorted(np.array(coded.word_ids, np.int64), np.arange(len(single)), "right")
                self._remember(single, np.array(coded.ids, self.type), ends)

    def _remember(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Words, their ids in a row, and where each word's end."""
        raw, at = ids.tobytes(), 0
        for word, to in zip(words, (ends * ids.itemsize).tolist(), strict=True):
            self.known[word.encode()] = raw[at:to]
            at = to

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.known) > self.kept // 2:
            self.older, self.known = self.known, {}
        found = list(map(self.known.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if missing:
            older = self.older
            absent = [words[k] for k in missing]
            self.known.update((w, older[w]) for w in absent if w in older)
            self._learn([w for w in absent if w not in self.known])
            for k, word in zip(missing, absent, strict=True):
                found[k] = self.known[word]
        return found

    def parts(self, text: bytes, size: int = GATHER) -> Iterator[bytes]:
        """The text cut after white space into parts of about ``size`` bytes."""
        at = 0
        while len(text) - at > size:
            to = at + size
            more = np.frombuffer(text[to:].translate(self._KINDS), np.uint8) == self._SPACE
            hit = int(more.argmax())
            if not more[hit]:
                break
            yield text[at : to + hit + 1]
            at = to + hit + 1
        yield text[at:]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        # Lower case could make a special token of a word.
        plain = [t if b"<|" in t else t.lower() for t in texts]
        raw = b"\n".join(plain) + b"\n"
        kind = np.frombuffer(raw.translate(self._KINDS), np.uint8)
        space = kind == self._SPACE
        cut = np.empty(kind.size, bool)
        cut[0] = True
        np.not_equal(space[1:], space[:-1], out=cut[1:])
        if self.apart:
            cut[1:-1] |= (kind[1:-1] == self._CLOSING) & (kind[:-2] == self._BEFORE) & space[2:]
        at = np.flatnonzero(cut)
        edges = np.append(at, kind.size).astype(np.int32)
        segments = pa.Array.from_buffers(pa.binary(), at.size, [None, pa.py_buffer(edges), pa.py_buffer(raw)])
        word = np.flatnonzero(~space[at])
        coded = segments.take(pa.array(word)).dictionary_encode()
        codes = coded.indices.to_numpy()
        known = self._ids_of(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(known), self.type).astype("<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // np.dtype(self.type).itemsize
        starts = np.cumsum(sizes) - sizes
        each = sizes[codes]
        ends = np.cumsum(each)
        ids = flat[np.repeat(starts[codes] - ends + each, each) + np.arange(each.sum())]
        # Texts end at their line ends; so many words, and so many ids, lie before.
        lengths = np.fromiter(map(len, plain), np.int64, len(plain)) + 1
        words = np.searchsorted(at[word], np.cumsum(lengths)[:-1])
        return np.split(ids, np.concatenate([[0], ends])[words])


class TextEncoder:
    """Encodes whole texts with any tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()

    def parts(self, text: bytes, size: int = GATHER) -> Iterator[bytes]:
        """The whole text, since a tokenizer may join its parts."""
        yield text

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(f.ids, "<u4") for f in found]


@lru_cache(maxsize=2)
def encoder(path: str, by_word: bool, kept: int = WORDS_KEPT) -> WordEncoder | TextEncoder:
    """One per Python worker, kept between tasks."""
    return WordEncoder(path, kept) if by_word else TextEncoder(path)


# ---------------------------------------------------------------- writing


Piece = tuple[int | None, np.ndarray, bool]


def _pieces(texts: Iterable[tuple[int | None, bytes]], coder: WordEncoder | TextEncoder, end: int, gather: int = GATHER) -> Iterator[Piece]:
    """``doc_id``, ids and whether they are the document's last, in order."""
    held: list[tuple[int | None, bytes, bool]] = []
    size = 0

    def encoded() -> Iterator[Piece]:
        for (doc_id, _, last), ids in zip(held, coder.encode([t for _, t, _ in held]), strict=True):
            yield doc_id, np.append(ids, np.uint32(end)) if last else ids, last

    for doc_id, text in texts:
        parts = list(coder.parts(text, gather))
        for k, part in enumerate(parts, 1):
            held.append((doc_id, part, k == len(parts)))
            size += len(part) + 1
            if size >= gather:
                yield from encoded()
                held, size = [], 0
    if held:
        yield from encoded()


def _blocks(pieces: Iterable[Piece], bits: int, file: int, limit: int) -> Iterator[dict]:
    """Blocks of ``limit`` to twice ``limit`` ids, the last one of a file of fewer."""
    ids: list[np.ndarray] = []
    docs: list[dict] = []
    size = first = block = before = 0

    def row() -> dict:
        payload = pack(np.concatenate(ids), bits)
        return dict(file=file, block=block, first=first, n_ids=size, bits=bits, payload=payload, docs=docs)

    for doc_id, own, last in pieces:
        while own.size:
            now, own = own[: 2 * limit - size], own[2 * limit - size :]
            ends = last and not own.size
            if docs and not docs[-1]["ends"]:  # another part of the same document
                docs[-1] |= {"n_ids": docs[-1]["n_ids"] + now.size, "ends": ends}
            else:
                docs.append({"doc_id": doc_id, "start": size, "n_ids": now.size, "before": before, "ends": ends})
            ids.append(now)
            size += now.size
            before = 0 if ends else before + now.size
            if size == 2 * limit or (ends and size >= limit):
                yield row()
                ids, docs, size, first, block = [], [], 0, first + size, block + 1
    if docs:
        yield row()


def _bytes_of(texts: pa.Array) -> Iterator[bytes]:
    """Texts as bytes one by one; null is empty."""
    for text in texts.cast(pa.binary()):
        yield text.as_py() or b""


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int, by_word: bool = False, limit: int = BLOCK_IDS, kept: int = WORDS_KEPT, gather: int = GATHER) -> None:
    """Encode every text and write the blocks to ``path``, file by ascending id.

    ``by_word`` is for tokenizers that drop white space and saves most of the time; a worker
    then remembers about ``kept`` words and encodes ``gather`` bytes of text at once.
    """

    def encoded(batches):
        coder, file = encoder(tokenizer, by_word, kept), TaskContext.get().partitionId()
        rows = ((i, t) for b in batches for i, t in zip(b.column(0).to_pylist(), _bytes_of(b.column(1)), strict=True))
        for block in _blocks(_pieces(rows, coder, end, gather), bits_for(max(coder.vocabulary, end + 1)), file, limit):
            yield pa.RecordBatch.from_pylist([block], _BLOCKS)
        pa.default_memory_pool().release_unused()

    slim = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"), F.xxhash64("text").alias("h"))
    dealt = slim.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    blocks = dealt.select("doc_id", "text").mapInArrow(encoded, BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    written = docs.sparkSession.read.schema(BLOCKS).parquet(f"{path}/blocks")
    sizes = written.groupBy("file").agg(F.sum(F.col("n_ids").cast("long")).alias("n_ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("file", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first_id")).write.parquet(
        f"{path}/files"
    )


# ---------------------------------------------------------------- reading


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``first`` counted over all files; the list of files has a row per task."""
    files = spark.read.parquet(f"{path}/files").select(F.col("file").alias("f"), "first_id")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return blocks.join(files, F.col("file") == F.col("f")).withColumn("first", F.col("first") + F.col("first_id"))


def read_range(spark: SparkSession, path: str, start: int, count: int) -> np.ndarray:
    """Ids from place ``start`` on: only blocks that hold them are opened."""
    stop = start + count
    hit = read_blocks(spark, path).where((F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start))
    found = []
    for b in hit.select("first", "n_ids", "bits", "payload").orderBy("first").collect():
        a, z = max(start, b["first"]), min(stop, b["first"] + b["n_ids"])
        found.append(unpack(b["payload"], b["bits"], a - b["first"], z - a))
    return np.concatenate(found) if found else np.zeros(0, "<u4")


DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
_PARTS = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "before", "n_tokens", "ids_crc32")] + [("whole", pa.bool_())])


@lru_cache(maxsize=1)
def _crc32_shifts() -> list[np.ndarray]:
    """What 1, 2, 4, ... further zero bytes make of each bit of a crc32."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    step = np.concatenate([[np.uint32(0xEDB88320)], bits[:-1]]).astype(np.uint32)  # one zero bit
    for _ in range(3):
        step = _through(step, step)
    shifts = [step]
    for _ in range(62):
        shifts.append(_through(shifts[-1], shifts[-1]))
    return shifts


def _through(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Each value as the sum, without carries, of the matrix rows of its bits."""
    chosen = (np.asarray(values, np.uint32)[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
    return np.bitwise_xor.reduce(np.where(chosen, matrix, np.uint32(0)), axis=1)


def joined_crc32(parts: Iterable[tuple[int, int]]) -> int:
    """Checksum of bytes from the checksum and length of each of their parts."""
    shifts, crc = _crc32_shifts(), np.zeros(1, np.uint32)
    for own, length in parts:
        for k in range(length.bit_length()):
            if length >> k & 1:
                crc = _through(shifts[k], crc)
        crc ^= np.uint32(own)
    return int(crc[0])


def _document_parts(blocks: DataFrame) -> DataFrame:
    """Place, number and checksum of each document's ids in each block."""

    def read(batches):
        for batch in batches:
            out = []
            for first, n_ids, bits, payload, docs in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                ids = unpack(payload, bits, 0, n_ids)
                for d in docs:
                    own = ids[d["start"] : d["start"] + d["n_ids"]]
                    start, whole = first + d["start"] - d["before"], d["ends"] and not d["before"]
                    out.append((d["doc_id"], start, d["before"], own.size, zlib.crc32(own.tobytes()), whole))
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARTS, strict=True)], schema=_PARTS)

    schema = "doc_id long, start long, before long, n_tokens long, ids_crc32 long, whole boolean"
    return blocks.select("first", "n_ids", "bits", "payload", "docs").mapInArrow(read, schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``DOCUMENTS`` from the files: place, number and checksum of each document's ids.

    Documents of several blocks are put together from a row a block, which holds no ids.
    """
    parts = stage(_document_parts(read_blocks(spark, path)), "parts")

    def together(rows):
        rows = rows.sort_values("before")
        crc = joined_crc32((int(c), 4 * int(n)) for c, n in zip(rows["ids_crc32"], rows["n_tokens"], strict=True))
        return rows.iloc[:1].assign(n_tokens=rows["n_tokens"].sum(), ids_crc32=crc)[["doc_id", "start", "n_tokens", "ids_crc32"]]

    columns = ("doc_id", "start", "n_tokens", "ids_crc32")
    spread = parts.where(~F.col("whole")).groupBy("start").applyInPandas(together, DOCUMENTS)
    return parts.where("whole").select(*columns).union(spread.select(*columns))

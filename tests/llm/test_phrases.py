"""Collocations against counting every phrase."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from sectorgauge.llm import phrases


def _brute(rows, least, longest, top):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in count.items():
        found = [p for p, n in f.items() if len(p) > 1 and n >= least]
        held = set()
        for p in found:
            for k in range(2, len(p)):
                held |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * f[p] >= 80 * f[p[i : i + k]]}
        scored = []
        for p in set(found) - held:
            s, k = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def _rows(spark, rows, least=5, longest=4, top=40):
    frame = spark.createDataFrame(
        [(i, lang, text, 1, "x", 2, 3) for i, (lang, text) in enumerate(rows)],
        "doc_id long, lang string, text string, n int, word string, place int, gram int",
    )
    return sorted(tuple(r) for r in phrases.collocations(frame, least, longest, top).collect())


def _texts(rng, number):
    words = ["a", "B", "b", "cat", "Cat", "é", "É", "x-y", "--", "1", "a b"]
    ends = [". ", ",", ";\n", " ! ", "\r\n", "\x0b", "\t", " ", "  ", " "]
    for _ in range(number):
        size = int(rng.integers(0, 60))
        yield "".join(str(rng.choice(words)) + str(rng.choice(ends)) for _ in range(size))


@pytest.mark.parametrize("block", [phrases.BLOCK, 400])
def test_phrases_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(phrases, "BLOCK", block)
    monkeypatch.setattr(phrases.cut_text, "__defaults__", (block,))
    rng = np.random.default_rng(6)
    langs = ["en", "en", "en", "de", None, "und"]
    rows = [(langs[i % 6], t) for i, t in enumerate(_texts(rng, 240))]
    rows += [("en", "the same words again and again. " * 30)] * 20  # repeated rows, ties
    rows += [("fr", None), ("fr", ""), ("fr", " .\n;"), ("xx", "only once here"), ("yy", "one two " * 2000)]
    want = _brute(rows, 5, 4, 40)
    assert len({r[0] for r in want}) >= 4
    assert _rows(spark, rows) == want


def test_other_lengths_and_no_documents(spark):
    rng = np.random.default_rng(7)
    rows = [("en", t) for t in _texts(rng, 60)]
    for longest in (2, 3, 5):
        assert _rows(spark, rows, 3, longest, 10) == _brute(rows, 3, longest, 10)
    assert _rows(spark, []) == [] and _rows(spark, [("en", "a b")]) == []


def test_texts_are_cut_between_pieces():
    text = b"a b\nccc ddd eee\n\nf" + b" g" * 50 + b"\nh i"
    for size in (1, 4, 9, 30, 500):
        parts = list(phrases.cut_text(text, size))
        assert b"".join(parts) == text
        assert all(p.startswith(b"\n") for p in parts[1:])


def test_all_documents_against_brute_force(spark, documents):
    rows = [(r["lang"], r["text"]) for r in documents.collect()]
    got = sorted(tuple(r) for r in phrases.collocations(documents, 6).collect())
    assert got == _brute(rows, 6, 4, 2000) and len(got) > 200


def test_slots_are_packed_without_loss():
    for slots in ([], [-1], [0, -1, 5, 70_000, 2**31 - 1, -1]):
        assert phrases.unpacked(phrases.packed(np.array(slots, np.int32))).tolist() == slots


def test_groups_are_handed_on_in_lists():
    """A row for each block and part, whatever the number of groups in it."""
    rng = np.random.default_rng(8)
    rows, want = [], Counter()
    for block in range(6):
        ids = np.sort(rng.choice(1 << 40, 300, replace=False))
        slots = rng.integers(-1, 300, 20_000).astype(np.int32)
        rows.append({"block": block, "slots": phrases.packed(slots), "grams": ids.tobytes()})
        pairs = [(a, b) for a, b in zip(slots, slots[1:], strict=False) if a >= 0 and b >= 0]
        want.update((int(ids[a]), int(ids[b])) for a, b in pairs)
    batches = list(phrases._count_groups(iter([pa.RecordBatch.from_pylist(rows, phrases._RELATION)]), 1, 5))
    lists = pa.Table.from_batches(batches)
    assert lists.num_rows == 6 * 5
    got = Counter()
    for part in range(5):
        found = phrases._sum_groups(lists.filter(pc.equal(lists["part"], part)), 2, 1).to_pylist()
        got.update({tuple(r["gram"]): r["f"] for r in found if r["f"]})
    assert got == want

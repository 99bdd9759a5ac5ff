"""Decontamination, repeats, Jaccard join, language model and classifier."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectorgauge.llm import byte_cnn, decontaminate, ppm, shingles, suffixes


def test_wand_finds_all_that_scoring_finds(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(3, 30)))) for i in range(150)]
    index = decontaminate.ItemIndex(items)
    for _ in range(60):
        terms = sorted({index.terms[w.encode()] for w in rng.choice(vocabulary, 40) if w.encode() in index.terms})
        scores = defaultdict(float)
        for t in terms:
            for i, s in zip(index.lists[t].items, index.lists[t].scores, strict=True):
                scores[i] += s
        for threshold in (0.3, 0.7):
            want = {i: s for i, s in scores.items() if s >= threshold}
            assert index.search(terms, threshold) == pytest.approx(want)


def test_leaks_are_found_wherever_they_lie(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 700)
    items = spark.createDataFrame(
        [(1, "What is the tallest hill of Rovia? It is Mount Eldra, near Pell.", 0), (2, "Plum quince fig. Answer: olive", 0), (3, None, 0), (4, "", 0)],
        "item_id long, text string, doc_id int",
    )
    filler = " ".join(f"word{i}" for i in range(500))
    docs = spark.createDataFrame(
        [(10, f"{filler} WHAT is the tallest hill of Rovia? it is Mount Eldra near Pell {filler}"), (11, filler), (12, None), (13, ""),
         (14, "What is the tallest hill of Rovia? Nobody knows."), (15, "plum quince fig.\nanswer: olive"), (15, "plum quince fig.\nanswer: olive"),
         (None, "plum, quince; fig - answer olive")],
        "doc_id long, text string",
    )
    for per_index in (20_000, 1):
        got = sorted((r["doc_id"] or 0, r["item_id"]) for r in decontaminate.find_leaks(docs, items, per_index).collect())
        assert got == [(0, 2), (10, 1), (15, 2), (15, 2)]
    assert decontaminate.find_leaks(docs, items.where("item_id > 2")).count() == 0
    assert decontaminate.find_leaks(docs.where("doc_id > 99"), items).count() == 0


def _leaks_by_scoring_everything(docs, items):
    """Every passage against every item, with BM25 as it is written in books."""
    words = {i: t.split() for i, t in items}
    found = Counter(w for own in words.values() for w in set(own))
    mean = sum(map(len, words.values())) / len(words)
    passage = max(64, 2 * max(map(len, words.values())))

    def weight(w, own):
        n = own.count(w)
        idf = math.log(1 + (len(words) - found[w] + 0.5) / (found[w] + 0.5))
        return idf * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(own) / mean))

    weights = {i: {w: weight(w, own) for w in set(own)} for i, own in words.items()}
    parts = {i: decontaminate.question_and_answer(t) for i, t in items}
    out = {}
    for doc_id, text in docs:
        own = text.split()
        for a in range(0, len(own), passage // 2):
            window = own[a : a + passage]
            held, coded = set(window), [w.encode() for w in window]
            for i, each in weights.items():
                score = sum(s for w, s in each.items() if w in held) / sum(each.values())
                shares = [decontaminate.overlap(p, coded) for p in parts[i]]
                if score >= 0.7 - 1e-9 and min(shares) >= 0.8:
                    n, *best = out.get((doc_id, i), (0, 0.0, 0.0, 0.0))
                    out[doc_id, i] = (n + 1, *map(max, best, (score, *shares)))
    return out


def test_leaks_equal_scoring_everything_whatever_the_blocks(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(400)]
    share = 1 / np.arange(1, 401)
    draw = lambda n: rng.choice(vocabulary, n, p=share / share.sum())
    items = [(i, " ".join(draw(rng.integers(6, 40)))) for i in range(200)]
    docs = []
    for k in range(80):
        copied = items[rng.integers(200)][1].split()
        for at in rng.integers(0, len(copied), k % 4):  # up to three words replaced
            copied[at] = "other"
        docs.append((k, " ".join([*draw(rng.integers(0, 150)), *copied, *draw(rng.integers(0, 150))])))
    want = _leaks_by_scoring_everything(docs, items)
    assert 20 < len(want)
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, block string")
    for per_index in (20_000, 40):
        got = {(r[0], r[1]): tuple(r)[2:] for r in decontaminate.find_leaks(docs, items, per_index).collect()}
        assert got.keys() == want.keys()
        assert all(got[key] == pytest.approx(want[key]) for key in want)


def _without_repeats(rows, length=suffixes.LENGTH):
    """Kept bytes and spans of distinct rows in order."""
    seen, out = set(), []
    for row in rows:
        data = (row[1] or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if (g := data[s : s + length]) in seen:
                covered[s : s + length] = b"\1" * length
            seen.add(g)
        kept = bytes(c for c, m in zip(data, covered, strict=True) if not m)
        spans = sum(1 for k, m in enumerate(covered) if m and (k == 0 or not covered[k - 1]))
        out.append((row[0], len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _repeats(docs):
    return Counter(
        (r["doc_id"], r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
        for r in suffixes.remove_repeats(docs).collect()
    )


@pytest.mark.parametrize("group", [suffixes.GROUP, 0])
def test_repeats_against_brute_force(spark, documents, monkeypatch, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    monkeypatch.setattr(suffixes, "PIECE", 5000)
    monkeypatch.setattr(suffixes, "SORTED", 3000)
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("ab "), 400))
    made = [(100_000 + i, base[: 150 + i] + str(i) + base[i : i + 130] + "z" * (3 * i)) for i in range(60)]
    made += [(200_000, "a" * 1500), (200_001, base[1:99]), (200_002, None), (200_003, "")]
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string"))
    want = _without_repeats(sorted(docs.collect(), key=lambda r: r["doc_id"]))
    assert _repeats(docs) == Counter(want)


def test_repeats_of_odd_documents(odd_documents, no_documents):
    got = _repeats(odd_documents)
    assert sum(got.values()) == odd_documents.count()
    assert max(n for (doc_id, *_), n in got.items() if doc_id == 1) == 2  # equal rows, equal results
    assert not _repeats(no_documents)


def test_suffix_sort_is_stable_and_right():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    data[1000:1500] = data[200:700]
    order = suffixes.SuffixOrder(data)
    places = np.sort(rng.permutation(2800)[:900])
    n = places.size
    got = order.sort(places, np.zeros(n, np.int64), np.full(n, n))
    assert got.tolist() == sorted(places.tolist(), key=lambda p: (data[p : p + 100].tobytes(), p))


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _components(rows):
    sets = {}
    for i, text in rows:
        w = _words(text)
        sets[i] = {tuple(w[a : a + 3]) for a in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= 90 * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("chunk", [shingles.CHUNK, 3])
def test_jaccard_components_against_brute_force(spark, documents, monkeypatch, chunk):
    monkeypatch.setattr(shingles, "CHUNK", chunk)
    monkeypatch.setattr(shingles, "PIECE", 4000)
    rng = np.random.default_rng(9)
    made = []
    for size in (4, 12, 25, 60, 150):
        base = [f"v{x}" for x in rng.integers(0, 10_000, size)]
        for k in range(12):  # a chain of changes: not all pairs are linked
            base = list(base)
            base[int(rng.integers(0, size))] = f"n{k}{size}"
            made.append((1000 * size + k, " ".join(base)))
    made += [(7, "Only Two"), (8, "only\ttwo"), (9, None), (10, " \n"), (11, "one"), (12, "ONE")]
    docs = documents.where("doc_id > 20").select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string"))
    want = _components([tuple(r) for r in docs.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shingles.jaccard_components(docs).collect()}
    assert got == want


def test_jaccard_components_of_odd_documents(odd_documents, no_documents):
    got = shingles.jaccard_components(odd_documents).collect()
    assert len(got) == odd_documents.count()
    assert {r["component_id"] for r in got if r["doc_id"] == 1 and r["n_shingles"] > 5} == {1}
    assert shingles.jaccard_components(no_documents).count() == 0


def _ppm_brute(train, texts, order):
    """The same model by dictionaries, contexts and exclusion sets."""
    table = defaultdict(Counter)
    for text in train:
        data = bytes(ppm.coded(ppm.tokens_of(text), order))
        for i in range(order, len(data)):
            for k in range(order + 1):
                table[data[i - k : i]][data[i]] += 1
    out = []
    for text in texts:
        data, total = bytes(ppm.coded(ppm.tokens_of(text), order)), 0.0
        for i in range(order, len(data)):
            known = [data[i - k : i] for k in range(order, -1, -1) if data[i - k : i] in table]
            # Start contexts of more than one line feed are no grams of any text.
            known = [c for c in known if not c.startswith(b"\n\n")]
            excluded: set[int] = set()
            for c in known:
                left = {s: n for s, n in table[c].items() if s not in excluded}
                n, d = sum(left.values()), len(left)
                if data[i] in left:
                    total += math.log10(left[data[i]] / (n + d))
                    break
                if n:
                    total += math.log10(d / (n + d))
                excluded |= set(left)
            else:
                total += math.log10(1 / max(1, 256 - len(excluded)))
        out.append(total)
    return out


def test_ppm_against_brute_force(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join("".join(rng.choice(list("abcDé"), rng.integers(1, 5))) for _ in range(rng.integers(1, 30))) for _ in range(40)]
    texts += ["", None, " \n", "zzz qq"]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n int")
    held_out = F.col("doc_id") % 4 == 1
    got = {r["doc_id"]: r for r in ppm.score_documents(docs, held_out, order=2, top_words=4).collect()}
    train = [(t or "").encode() for i, t in enumerate(texts) if i % 4 != 1]
    want = _ppm_brute(train, [(t or "").encode() for t in texts], 2)
    count = Counter(w for t in train for w in [*ppm.tokens_of(t), ppm.END])
    n, v = sum(count.values()), len(count)
    for i, t in enumerate(texts):
        tokens = [*ppm.tokens_of((t or "").encode()), ppm.END]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(count[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(want[i])


def test_ppm_keeps_all_grams_whatever_is_frequent(spark, monkeypatch):
    """Rare grams of order 5 count too, and rows that make them rarer still don't change that."""
    rng = np.random.default_rng(7)
    texts = [" ".join("".join(rng.choice(list("abcDé"), rng.integers(1, 6))) for _ in range(rng.integers(1, 60))) for _ in range(60)]
    texts += ["", None, "x", "zzzz qqqq", "ab " * 60_000, "ab " * 60_000, "é" * 300]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    train = [(t or "").encode() for i, t in enumerate(texts) if i % 4 != 1]
    want = _ppm_brute(train, [(t or "").encode() for t in texts], 5)
    # Lists of a few grams and rows, so that texts and tasks have several of them.
    monkeypatch.setattr(ppm, "ASKED", 500)
    monkeypatch.setattr(ppm, "ASKED_ROWS", 4)
    for max_nodes in (1 << 19, 8, 1 << 60):
        got = ppm.score_documents(docs, F.col("doc_id") % 4 == 1, max_nodes=max_nodes).collect()
        assert len(got) == len(texts)
        assert all(r["score"] == pytest.approx(want[r["doc_id"]]) for r in got)


def test_ppm_asks_for_a_word_once_for_all_rows_of_a_list(spark):
    docs = spark.createDataFrame([(i, f"same words here w{i} w{i}") for i in range(50)], "doc_id long, text string").coalesce(1)
    asked = ppm.score_texts(docs, np.zeros(0, np.uint64), np.zeros(0), {b"here": 0.5}, F.lit(False)).where("word is not null").collect()
    rows = {bytes(r["word"]): np.frombuffer(r["slots"], np.uint16).tolist() for r in asked}
    assert len(asked) == len(rows) == 53
    assert rows[b"same"] == rows[ppm.END] == list(range(50)) and rows[b"w7"] == [7, 7]


@pytest.mark.parametrize("least", [0, 1 << 50])
def test_asked_lists_hold_all_grams(least):
    rng = np.random.default_rng(12)
    gram = rng.integers(0, 900, 5000).astype(np.uint64) * np.uint64(977) + np.uint64(least)
    slot = rng.integers(0, 1 << 16, 5000).astype(np.uint16)
    got = Counter()
    for r in ppm._asked(7, gram, slot):
        names, each, slots = ppm._unpacked(r["grams"]), ppm.unpacked(r["each"], "<u4"), ppm.unpacked(r["slots"], "<u2")
        assert (ppm._block(names) == r["block"]).all()
        got.update(zip(np.repeat(names, each).tolist(), slots.tolist(), strict=True))
    assert got == Counter(zip(gram.tolist(), slot.tolist(), strict=True))


def test_ppm_without_training_rows(spark, odd_documents, no_documents):
    got = ppm.score_documents(odd_documents, F.lit(True), order=2).collect()
    assert len(got) == odd_documents.count() and {r["n_known"] for r in got} == {0}
    assert all(r["score"] < 0 for r in got)
    assert ppm.score_documents(no_documents, F.lit(False), order=2).count() == 0


def test_chunks_cover_all_bytes_and_pool_their_maxima():
    rng = np.random.default_rng(4)
    net = byte_cnn.fit([([b"a"], 1), ([b"b"], 1)])
    net.tables = rng.normal(size=net.tables.shape).astype(np.float32)
    for size in (0, 1, 500, 511, 512, 513, 2000, 300_000):
        data = byte_cnn.padded(rng.integers(0, 256, size).astype(np.uint8).tobytes())
        starts = byte_cnn.chunk_starts(data.size)
        assert starts[-1] + byte_cnn.CHUNK >= data.size
        want = [np.maximum(net.responses(data[s : s + byte_cnn.CHUNK]).max(axis=0) + net.bias, 0) for s in starts.tolist()]
        assert np.allclose(net.pooled(data), want, atol=1e-5)


def test_classifier_on_held_out_rows(spark, odd_documents, no_documents):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = byte_cnn.classify_quality(docs, labels, rows=400)
    seen = scored.where("held_out").join(labels, "doc_id").collect()
    right = sum(r["predicted"] == r["quality"] for r in seen) / len(seen)
    share = max(sum(r["quality"] for r in seen), len(seen) - sum(r["quality"] for r in seen)) / len(seen)
    assert right > share and right > 0.93
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in seen)
    odd = byte_cnn.classify_quality(odd_documents, labels.where("quality = 1"))
    assert odd.count() == odd_documents.count()
    assert byte_cnn.classify_quality(no_documents, labels.where("quality > 5")).count() == 0

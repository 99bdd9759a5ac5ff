"""Token files, mixing, URL filter and quality rules."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sectorgauge.llm import mixing, quality_rules, token_files, urls
from sectorgauge.llm.components import connected_components
from sectorgauge.llm.oracle import ORACLE_SQL

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("bits", [1, 7, 8, 15, 16, 17, 32])
def test_packing_gives_every_range_back(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype("<u4")
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-1000 * bits // 8)
    for start, count in ((0, 1000), (1, 7), (993, 7), (500, 0)):
        assert token_files.unpack(packed, bits, start, count).tolist() == ids[start : start + count].tolist()


def test_token_files_against_the_tokenizer(spark, documents, odd_documents, tmp_path):
    tokenizer = Tokenizer.from_file(PATH)
    for name, docs in (("given", documents), ("odd", odd_documents)):
        path = f"{tmp_path}/{name}"
        token_files.write_tokens(docs, path, PATH, 2, by_word=True, limit=200)
        got = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r["start"])
        assert [(r["doc_id"] is not None, r["doc_id"]) for r in got] == sorted((r["doc_id"] is not None, r["doc_id"]) for r in got)
        want = Counter()
        for r in docs.collect():
            ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
            want[r["doc_id"], len(ids), zlib.crc32(ids.tobytes())] += 1
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
        assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    total = sum(r["n_tokens"] for r in got)
    assert token_files.read_range(spark, path, 3, total - 3).size == total - 3


def test_no_tokens(spark, no_documents, tmp_path):
    token_files.write_tokens(no_documents, f"{tmp_path}/x", PATH, 2)
    assert token_files.read_documents(spark, f"{tmp_path}/x").count() == 0


def test_word_encoder_where_case_and_signs_matter():
    tokenizer, by_word = Tokenizer.from_file(PATH), token_files.WordEncoder(PATH, kept=3)
    for text in ("A,b. C.D e., 'S DON'T. x5, 5.", "ΑΣ ΣΑΣ. É, é, á.", "<|EndOfText|>. a<|endoftext|>b.", " a　c", ""):
        assert by_word.encode([text.encode()])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    texts = ["a,", ",b", "", " . ", "x.", "\u3000y"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in by_word.encode([t.encode() for t in texts])] == want


def test_word_encoder_remembers_a_bounded_number_of_words(monkeypatch):
    """Rare words are forgotten, frequent ones are encoded once, and ids stay right."""
    tokenizer, by_word = Tokenizer.from_file(PATH), token_files.WordEncoder(PATH, kept=2000)
    learned = Counter()
    learn = by_word._learn
    monkeypatch.setattr(by_word, "_learn", lambda words: (learned.update(words), learn(words)))
    for lot in range(40):
        text = "often, seen " + " ".join(f"w{lot}x{k}" for k in range(500))
        ids = by_word.encode([text.encode()])[0].tolist()
        assert lot % 13 or ids == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(by_word.known) + len(by_word.older) <= 2000 + 2 * 600
    assert learned[b"often"] == learned[b"seen"] == 1


class CountingTokenizer:
    """A tokenizer that counts what it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts, self.singles = tokenizer, 0, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)

    def encode(self, words, **options):
        self.singles += len(words)
        return self.tokenizer.encode(words, **options)


def test_words_of_letters_are_encoded_together():
    """One text holds many of them; words with signs or digits go on their own."""
    tokenizer, by_word = Tokenizer.from_file(PATH), token_files.WordEncoder(PATH)
    by_word.tokenizer = counting = CountingTokenizer(by_word.tokenizer)
    words = ["".join("aéкß漢"[k // 5**d % 5] for d in range(5)) for k in range(5**5)]
    text = " ".join([*words, "it's", "x5y", "a-b", "***"])
    assert by_word.encode([text.encode()])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert counting.texts <= len(words) / token_files.TOGETHER + 1
    assert counting.singles == 4


def test_words_whose_ends_are_unclear_are_encoded_alone():
    """Letters that the tokenizer takes apart or joins, next to words that it leaves whole."""
    tokenizer, rng = Tokenizer.from_file(PATH), np.random.default_rng(4)
    odd = ["İ", "aİb", "\u0958", "ǆ", "ŉ", "ſ", "각", "각", "𝒜b", "ª", "ⅷ", "e\u0301", "\u0301e", "\u0f43", "ﬃ", "\u3000", "it's", "½", "A\u030a", "ऀक"]
    plain = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    for marked in (True, False):
        by_word = token_files.WordEncoder(PATH, kept=50)
        assert by_word.last is not None
        if not marked:
            by_word.last = None
        for _ in range(20):
            texts = [" ".join(rng.permutation([*rng.choice(odd, 6), *rng.choice(plain, 60)])) for _ in range(3)]
            want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
            assert [ids.tolist() for ids in by_word.encode([t.encode() for t in texts])] == want


def test_parts_of_a_text_are_cut_at_white_space():
    by_word = token_files.WordEncoder(PATH)
    text = b"one two, three.four five" * 3
    for size in (1, 5, 9, 30, 500):
        parts = list(by_word.parts(text, size))
        assert b"".join(parts) == text
        assert np.concatenate(by_word.encode(parts)).tolist() == by_word.encode([text])[0].tolist()
    assert list(by_word.parts(b"a" * 50, 5)) == [b"a" * 50]


def test_a_long_text_lies_in_many_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "GATHER", 1 << 16)
    long = " ".join(f"word{i % 977}, w{i % 13}." for i in range(250_000))
    assert len(long) > 3_000_000
    rows = [(1, "first"), (2, long), (3, None), (None, "last"), (2, long)]
    path = f"{tmp_path}/long"
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH, 2, by_word=True, limit=1000)
    assert token_files.read_blocks(spark, path).agg({"n_ids": "max"}).first()[0] == 2000
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    got = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]


def test_joined_checksums():
    raw = np.random.default_rng(1).integers(0, 256, 5000, np.uint8).tobytes()
    for cuts in ([0, 5000], [0, 1, 17, 4096, 5000], [0, 0, 5000, 5000]):
        parts = [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        assert token_files.joined_crc32((zlib.crc32(p), len(p)) for p in parts) == zlib.crc32(raw)


def test_mix_meets_every_target(odd_documents, documents):
    for docs in (documents, odd_documents):
        got = mixing.mix(docs).collect()
        assert len(got) == docs.count()
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
        sums, targets = Counter(), {}
        for r, source in zip(got, [None] * len(got), strict=True):
            sums[r["source_size"], r["target"]] += r["taken"]
            targets[r["source_size"], r["target"]] = r["target"]
        total = sum(r["size"] for r in got)
        # Sources of equal size and target fall together, so whole sums are compared.
        assert abs(sum(sums.values()) - 1.5 * total) <= 3 * len(got)
    assert sorted(map(str, mixing.mix(documents).collect())) == sorted(map(str, mixing.mix(documents).collect()))


def test_targets_by_resharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 0, None: 300}
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1], strict=True))
    target, open_, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in full} | ({} if full else {s: weight[s] * share for s in open_})
        left -= sum(2 * sizes[s] for s in full)
        open_ = open_ - full if full else set()
    assert got == pytest.approx(target)


def test_mix_of_nothing(no_documents):
    assert mixing.mix(no_documents).count() == 0 and mixing.mixed_documents(no_documents).count() == 0


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (5, None), (1, 0)]
    got = {r["vertex"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_aliases_carry_a_block_and_allow_goes_first(spark):
    link, jump = '<link href="{}" rel="canonical">', '<META http-equiv=refresh content="0; url={}">'
    pages = [
        (1, "http://x.NET/a?q", None), (2, "http://ok.com/1", link.format("http://x.net/a")),
        (3, "http://ok.com/2#f", jump.format("/1")), (4, "http://ok.com/2", ""), (5, None, "x"), (6, "no scheme", "x"),
        (7, "http://e.com/", link.format("http://example.net/en/z")), (8, "http://e.com/q", link.format("http://y.net/")),
        (9, "http://e.com/", jump.format("http://e.com/q")), (10, "http://a.example.net/en/b", None), (10, "http://a.example.net/en/b", None),
    ]
    frame = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, host string, rule string")
    got = {r["page_id"]: tuple(r)[1:] for r in urls.filter_urls(frame, urls.rules_frame(spark)).collect()}
    assert got[1] == ("x.net", "/a", "net/", "block")
    assert got[2][3] == "block" and got[3][3] == "block" and got[4][3] == "block"
    assert got[5] == ("", "", None, "allow") and got[6] == ("", "", None, "allow")
    assert got[7][3] == got[8][3] == "allow"  # blocked and allowed aliases: allow goes first
    assert got[10] == ("a.example.net", "/en/b", "example.net/en/", "allow")
    assert urls.filter_urls(frame.where("page_id > 99"), urls.rules_frame(spark)).count() == 0


LINKED = [
    (1, "http://ok.com/1", '<link rel=canonical href="http://fine.com/"><link rel=canonical href="http://x.net/1">'),
    (2, "http://ok.com/8", None), (3, "http://z.com/", '<link rel="canonical" href="http://OK.com/8">'),
    (4, "http://OK.com/8#top", '<meta http-equiv="refresh" content="0; url=HTTP://X.net/8">'),
    (5, "http://q.com/a?x=1&y=2", None), (6, "http://r.com/", '<link href="http://q.com/a?x=1&amp;y=2" rel="canonical">'),
    (7, "http://s.com", '<link rel="canonical" href="http://q.com/b/.././a?x=1&y=2"><link rel="canonical" href="//x.net">'),
    (8, "http://t.com/a/b?c", '<link rel="canonical" href="../../..">'), (9, "http://T.com", '<link rel="canonical" href="//x.net/9">'),
    (10, "http://u.com/go?to=1", '<link rel="canonical" href="/go?to=http://x.net/">'), (11, "http://u.com/mail", '<link rel="canonical" href="mailto:a@x.net">'),
    (12, "http://v.com/p?q#r", '<link rel="canonical" href="?z">'), (13, "http://v.com/p?z", '<meta http-equiv=refresh content="0;url=http://x.net/13">'),
    (14, "http://w.com/", '<a href="http://x.net/">x</a><link rel="stylesheet" href="http://x.net/">'), (15, None, '<link rel="canonical" href="http://x.net/">'),
    (16, "http://w.com/16", "<p>" + "long text " * 200_000 + '<link rel="canonical" href="http://x.net/16">'),
]


def test_every_link_counts_in_one_form(spark):
    """Several tags, host case, entities, dot segments, relative links, very long pages; the same by SQL."""
    frame = spark.createDataFrame(LINKED, "page_id long, url string, html string")
    rows = urls.filter_urls(frame, urls.rules_frame(spark)).collect()
    assert {r["page_id"] for r in rows if r["verdict"] == "block"} == {1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 13, 16}
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", LINKED)
    assert Counter(map(tuple, rows)) == Counter(con.execute(ORACLE_SQL["op6_url_filter"]).fetchall())


def _statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, inside = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_statistics_against_brute_force(spark, odd_documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    loops = spark.createDataFrame([(9, "a b c a b c a\nb\n\nb"), (8, "x x x x"), (7, "a b c d a b c")], "doc_id long, text string")
    for frame in (docs, odd_documents.select("doc_id", "text"), loops):
        got = Counter(
            (r["doc_id"], *(r["stats"][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))
            for r in quality_rules.text_statistics(frame, "doc_id").collect()
        )
        assert got == Counter((r["doc_id"], *_statistics(r["text"])) for r in frame.collect())


def test_fitted_rules_keep_good_documents(spark):
    folder = "/root/testdata/sf0.1"
    stats = quality_rules.text_statistics(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id").cache()
    model = quality_rules.fit_label_model(stats)
    judged = stats.select("doc_id", quality_rules.kept(model).alias("kept"), quality_rules.base_failed().alias("failed"))
    seen = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not failed").collect()
    good = [r["kept"] for r in seen if r["quality"] == 1]
    bad = [r["kept"] for r in seen if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)
    assert quality_rules.fit_patterns([]).prior > 0

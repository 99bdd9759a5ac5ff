"""Language identification: kernel, regression and whole results."""

import unicodedata
import zlib

import numpy as np
from pyspark.sql import functions as F

from sectorgauge.llm import string_kernel as sk


def _grams(text: bytes, longest=sk.LONGEST):
    padded = b" " + text + b" "
    return {padded[i : i + n] for n in range(1, longest + 1) for i in range(len(padded) - n + 1)}


def test_spectrum_has_every_n_gram_once(monkeypatch):
    rng = np.random.default_rng(1)
    for piece in (sk.PIECE, 50):
        monkeypatch.setattr(sk, "PIECE", piece)
        for size in (0, 1, 2, 3, 49, 50, 51, 700):
            text = rng.choice(list(b"abc \xc3\xa9"), size).astype(np.uint8).tobytes()
            want = sorted((len(g) << 32) | int.from_bytes(g, "big") for g in _grams(text))
            assert sk.spectrum(text).tolist() == want


def test_products_are_kernel_values(monkeypatch):
    texts = [b"the cat", b"le chat noir", b"", b"zzz", b"the black cat sat"]
    rows = [sk.spectrum(t) for t in texts]
    keys, matrix = sk.landmark_matrix(rows[:2])
    for held in (sk.HELD, 1, 40):
        monkeypatch.setattr(sk, "HELD", held)
        got = sk.products(rows, keys, matrix) / np.sqrt([r.size for r in rows])[:, None]
        for i, t in enumerate(texts):
            for j, mark in enumerate(texts[:2]):
                a, b = _grams(t), _grams(mark)
                assert abs(got[i, j] - len(a & b) / np.sqrt(len(a) * len(b))) < 1e-6


def test_landmarks_that_are_all_rows_give_full_kernel_ridge():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 40))
    kernel, targets = x @ x.T, rng.choice([-1.0, 1.0], (30, 3))
    full = np.linalg.solve(kernel + 0.01 * 30 * np.eye(30), targets)  # kernel @ a are fitted values
    assert np.allclose(kernel @ sk.solve(kernel, kernel, targets, 0.01), kernel @ full, atol=1e-6)
    twice = np.hstack([kernel, kernel[:, :5]])  # repeated landmarks
    square = np.vstack([twice, twice[:5]])
    assert np.allclose(twice @ sk.solve(twice, square, targets, 0.01), kernel @ full, atol=1e-5)


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sk.identify_languages(docs).collect()
    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    assert len(rows) == len(lang)
    right = [r["lang_pred"] == lang[r["doc_id"]][0] for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(right) / len(right) > 0.97
    for r in rows:
        letters = any(unicodedata.category(c)[0] == "L" for c in lang[r["doc_id"]][1] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert sorted(map(str, rows)) == sorted(map(str, sk.identify_languages(docs.repartition(7)).collect()))


def test_labels_of_held_out_rows_and_other_columns_say_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    other = docs.withColumn("lang", F.when(fold == 0, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    want = sorted(map(str, sk.identify_languages(docs, 64, 16).collect()))
    assert sorted(map(str, sk.identify_languages(other, 64, 16).collect())) == want


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(1, "Das ist ein Wort", "de"), (2, "this is a word", "en"), (None, "no id, no lesson", "fr"), (3, None, "it"),
            (4, "1234 !!", "es"), (6, "noch ein deutsches Wort", "de"), (6, "noch ein deutsches Wort", "de"), (7, "words are here", "en"),
            (8, "", None), (9, "wort und wort " * 3000, None), (11, "Ж", None)]
    docs = spark.createDataFrame([(*r, 1, 2, "k") for r in rows], "doc_id long, text string, lang string, of int, place int, keys string")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in sk.identify_languages(docs).collect()]
    assert len(got) == len(rows)
    assert {(i, p) for i, p, _ in got if i in (3, 4, 8)} == {(3, "und"), (4, "und"), (8, "und")}
    assert {p for i, p, _ in got if i not in (3, 4, 8)} <= {"de", "en"}  # the others' languages have no usable row
    assert all(s == 0 for _, p, s in got if p == "und")
    unlabelled = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in sk.identify_languages(unlabelled).collect()} == {("und", 0.0)}
    assert sk.identify_languages(no_documents.withColumn("lang", F.lit("en"))).count() == 0

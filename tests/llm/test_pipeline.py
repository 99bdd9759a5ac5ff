from collections import Counter

import corpus_pipeline
from sectorgauge.llm import decontaminate, mixing, quality_rules, queries, shingles
from sectorgauge.llm.common import stored, with_row_keys


def test_every_stage_does_its_part(spark):
    """Each stage on the stored result of the one before, against the operator's own word."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        result = step(spark, docs, folder)
        before = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        after = Counter(r["doc_id"] for r in result.select("doc_id").collect())
        if name == "quality_rules":
            stats = queries.stage(quality_rules.text_statistics(docs, "doc_id"), "stats")
            model = quality_rules.fit_label_model(stats)
            want = Counter(r["doc_id"] for r in stats.where(quality_rules.kept(model)).collect())
        elif name == "ngram_jaccard_join":
            want = Counter(r["component_id"] for r in shingles.jaccard_components(docs, queries.NEAR_WORDS, queries.NEAR_PERCENT).select("component_id").distinct().collect())
        elif name == "benchmark_decontamination":
            items = spark.read.parquet(f"{folder}/benchmark.parquet")
            leaks = {r["doc_id"] for r in decontaminate.find_leaks(docs, items).collect()}
            want = Counter({i: n for i, n in before.items() if i not in leaks})
        elif name == "source_mixing":
            want = Counter({r["doc_id"]: n for r in mixing.mix(docs).collect() if r["size"] and (n := int(r["taken"] / r["size"] + 0.5))})
        else:
            want = before
            assert result.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        assert after == want and after
        if name != "token_files":
            assert result.columns == docs.columns
            docs = queries.stage(result, name)


def written(spark, tmp_path, rows):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t, None, "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    return spark.read.parquet(path)


def long_text(n, words=80):
    return " ".join(f"w{n}x{k * k % 101}y{k}" for k in range(words))


def test_row_keys_are_distinct_and_stay_the_same(spark, tmp_path):
    docs = written(spark, tmp_path, [(None, "a")] * 50 + [(1, "a")] * 50)
    first, again = (sorted(r["row_key"] for r in with_row_keys(docs, "text").collect()) for _ in range(2))
    assert first == again and len(set(first)) == 100
    assert stored(docs) is docs
    loose = stored(docs.union(docs))
    assert with_row_keys(loose, "doc_id").select("row_key").distinct().count() == 200


def test_near_copies_leave_one_row_whatever_their_ids(spark, tmp_path):
    """Repeated rows, equal ids with other texts and null ids: one row of each group, no other text."""
    a, b, c = long_text(1), long_text(2), long_text(3)
    docs = written(spark, tmp_path, [(5, a), (5, a), (5, a), (None, a), (5, b), (None, c), (None, c), (7, ""), (7, None)])
    kept = queries.keep_one_of_each_group(spark, docs, "")
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == sorted(
        [("5", a), ("5", b), ("None", c), ("7", ""), ("7", "")]
    )
    assert kept.columns == docs.columns


def test_leaks_go_by_row(spark, tmp_path):
    """A leak without an id goes, and a clean text that shares an id with a leak stays."""
    folder = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{folder}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first()["text"]
    leak = f"{long_text(4)} {item} {long_text(5)}"
    docs = written(spark, tmp_path, [(None, leak), (1, leak), (1, long_text(6)), (None, long_text(7))])
    left = queries.drop_benchmark_documents(spark, docs, folder)
    assert sorted(r["text"] for r in left.collect()) == sorted([long_text(6), long_text(7)])


def test_leaks_need_no_second_set_of_python_workers(spark, tmp_path):
    """No rows come from a Python RDD, whose workers would stay beside those of the texts."""
    docs = written(spark, tmp_path, [(1, "a")])
    for items in (spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"), spark.createDataFrame([], "item_id long, text string")):
        found = decontaminate.find_leaks(docs, items)
        assert "ExistingRDD" not in found._jdf.queryExecution().toString()
        assert found.count() == 0
        assert found.columns == ["doc_id", "item_id", "n_passages", "score", "question_overlap", "answer_overlap"]


def test_chain_takes_empty_tables_and_clashing_columns(spark, tmp_path, odd_documents):
    folder = "/root/testdata/sf0.001"
    for docs in (odd_documents, odd_documents.where("doc_id > 99")):
        docs = queries.stage(docs.withColumns({"row": queries.F.lit(1), "row_key": queries.F.lit(2)}), "odd")
        for _, step in corpus_pipeline.STAGES[:-1]:
            result = step(spark, docs, folder)
            assert result.columns == docs.columns
            docs = queries.stage(result, "odd")
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_names_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.partition("_")[0] for x in names} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names

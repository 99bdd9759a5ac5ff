from itertools import combinations

import numpy as np
import pytest

from sectorgauge.llm import queries, shingles


def _kept(rows, width, percent):
    """Ids that stay when each group of near copies keeps its smallest."""
    sets = {}
    for i, text in rows:
        w = text.lower().split()
        sets[i] = {tuple(w[a : a + width]) for a in range(max(1, len(w) - width + 1))}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i for i in sets if find(i) == i}


def _made():
    """Texts with one to four changed words, which lie on both sides of either limit, under a common line."""
    rng, rows = np.random.default_rng(3), []
    line = "this line stands in very many texts of the table"
    for size in (6, 9, 20, 40, 80, 160, 400, 900):
        for family in range(3):
            base = [f"w{x}" for x in rng.integers(0, 5000, size)]
            rows.append((len(rows) + 1, " ".join(base)))
            for changes in (1, max(1, size // 60), max(1, size // 45), max(1, size // 30)):
                near = list(base)
                for at in rng.choice(size, changes, replace=False):
                    near[at] = f"x{len(rows)}"
                rows.append((len(rows) + 1, " ".join(near) + (f" {line}" if family == 2 else "")))
    return rows


def test_stage_links_five_words_at_80_percent(spark):
    rows = _made()
    want = _kept(rows, 5, 80)
    assert want != _kept(rows, 3, 90)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in queries.keep_one_of_each_group(spark, docs, "").collect()}
    assert got == want


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (1, 60)])
def test_settings_against_brute_force(spark, documents, width, percent):
    rows = [tuple(r) for r in documents.where("text is not null and trim(text) <> ''").select("doc_id", "text").collect()]
    rows = list(dict(rows).items()) + [(i + 10**6, t) for i, t in _made()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["component_id"] for r in shingles.jaccard_components(docs, width, percent).collect()}
    assert got == _kept(rows, width, percent)


def test_segments_move_once_and_belong_to_classes(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i % 7}x{k}" for k in range(80))) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    classes = shingles.document_classes(docs, 5, 80)
    assert classes.where("size(bands) > 0").count() == 7 and classes.count() == 70
    plans = []
    monkeypatch.setattr(shingles, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    shingles.shared_segments(classes, 0)
    assert plans[0].count("Exchange hashpartitioning") == 1

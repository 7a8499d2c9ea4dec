"""The pipeline, stage by stage, each on what its predecessor kept."""

from collections import Counter

import pytest

import corpus_pipeline
from aislewatch.llm import jaccard, lines, mixing
from aislewatch.llm.shared import stored


@pytest.fixture(scope="module")
def tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = [docs]
    for name, stage in corpus_pipeline.STAGES:
        held.append(stored(stage(spark, held[-1], folder), f"test-{name}"))
    return held


def test_stages_keep_the_columns_of_documents(tables):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near", "mix", "pack"]
    for table in tables[1:-1]:
        assert table.dtypes == tables[0].dtypes


def test_quality_and_lines(tables):
    docs, good, cut = (t.collect() for t in tables[:3])
    assert {r.doc_id for r in good} < {r.doc_id for r in docs} and len(good) > 0.8 * len(docs)
    texts = {r.doc_id: r.text for r in good}
    for r in cut:
        own = texts[r.doc_id].split("\n")
        left = iter(own)
        assert all(line in left for line in r.text.split("\n"))
        assert r.n_chars == len(r.text)
    counts = Counter(tuple(x) for r in cut for x in lines.normal_lines(r.text) if len(x) >= lines.LEAST_WORDS)
    assert max(counts.values()) == 1
    # Every line of a document that went has, in its group of similar lines, one that stays.
    joined = lambda t: [b" ".join(x).decode() for x in lines.normal_lines(t) if len(x) >= lines.LEAST_WORDS]
    every = sorted({x for t in texts.values() for x in joined(t)})
    group = list(range(len(every)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in lines.line_links(list(range(len(every))), every):
        a, b = root(a), root(b)
        group[max(a, b)] = min(a, b)
    place = {x: n for n, x in enumerate(every)}
    stay = {root(place[x]) for r in cut for x in joined(r.text)}
    gone = [t for i, t in texts.items() if i not in {r.doc_id for r in cut}]
    assert all(root(place[x]) in stay for t in gone for x in joined(t))


def test_near_mix_and_pack(tables):
    cut, one, mixed, packed = tables[2:]
    again = jaccard.near_components(one).collect()
    assert all(r.component_id == r.doc_id for r in again) and one.count() <= cut.count()
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(one).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in plan.items() if n})
    words = sum(len(r.text.encode().split()) for r in mixed.collect())
    assert sum(r.n_words for r in packed.collect()) == words


def test_run_gives_the_last_stage(spark, folder, tables):
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == tables[-1].columns and found.count() == tables[-1].count()

"""Each document's number of links, against all pairs."""

import numpy as np
import pytest
from test_operators import copies

from aislewatch.llm import jaccard
from aislewatch.llm.shared import shingle_hashes, word_hashes


@pytest.mark.parametrize("limit", [1_000_000, 1000])
def test_number_of_links_by_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(jaccard, "REGION_SHINGLES", limit)
    rows = copies(6, [(40, 2), (20, 5), (2, 0), (1, 0)])
    near = jaccard.Nearness(5, 80)
    found = {r.doc_id: r.n_links for r in jaccard.near_components(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), near).collect()}
    sets = {i: set(shingle_hashes(word_hashes(t), 5).tolist()) for i, t, _ in rows}
    linked = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    assert found == {i: sum(linked(sets[i], sets[j]) for j in sets if j != i) for i in sets}


def test_links_of_large_groups_are_counted_not_written(spark, monkeypatch):
    """Near copies in a dense group, at sizes that go through pivots, windows and pairs of blocks."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(150):
        words = list(base)
        for place in rng.choice(60, k % 4, replace=False):
            words[place] = f"x{rng.integers(9)}"
        rows.append((k // 2 if k < 20 else k, " ".join(words)))
    rows += [(None, " ".join([*base[:-1], "alone"])), (None, " ".join([*base[:-1], "alone"])), (3, rows[6][1]), (200, "other text")]
    near = jaccard.Nearness(3, 80)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    seen = []
    for limit in (1_000_000, 3000, 300):
        monkeypatch.setattr(jaccard, "REGION_SHINGLES", limit)
        seen.append(sorted(jaccard.near_components(docs, near).collect(), key=str))
    assert seen[0] == seen[1] == seen[2]
    sets = [(i, n, frozenset(shingle_hashes(word_hashes(t), 3).tolist())) for n, (i, t) in enumerate(rows)]
    holders = {}
    for i, n, s in sets:
        holders.setdefault(s, set()).add(("null", n) if i is None else i)
    linked = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    expected = sorted((str(i), sum(len(h) for o, h in holders.items() if linked(s, o)) - 1) for i, _, s in sets)
    assert sorted((str(r.doc_id), r.n_links) for r in seen[0]) == expected
    written = jaccard.links_within
    rows_of_links = []

    def count(*args):
        found = written(*args)
        rows_of_links.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "links_within", count)
    jaccard.near_components(docs, near).collect()
    monkeypatch.setattr(jaccard, "REGION_SHINGLES", 1_000_000)
    jaccard.near_components(docs, near).collect()
    assert rows_of_links[1] <= 2 * len(holders)


def test_a_set_without_ids_connects(spark):
    words = [f"w{k}" for k in range(30)]
    texts = [" ".join(words), " ".join([*words, "a", "b", "c"]), " ".join([*words, *"abcdef"])]
    docs = spark.createDataFrame([(1, texts[0]), (None, texts[1]), (2, texts[2])], "doc_id bigint, text string")
    found = {r.doc_id: (r.component_id, r.n_links) for r in jaccard.near_components(docs, jaccard.Nearness(3, 90)).collect()}
    assert found == {1: (1, 1), None: (None, 2), 2: (1, 1)}


def test_keys_in_every_lower_band():
    shingles = np.unique(np.random.default_rng(1).integers(0, 2**64, 100, dtype=np.uint64))
    near = jaccard.Nearness(5, 30)
    assert np.intersect1d(jaccard.part_keys(shingles, near), jaccard.part_keys(shingles[:31], near)).size


def test_a_common_phrase_makes_no_pairs_of_blocks(spark, monkeypatch):
    """Texts that share no more than a phrase are a family; pairs that link within it are found without blocks in pairs."""
    rng = np.random.default_rng(3)
    phrase = [f"p{k}" for k in range(40)]
    rows = []
    for k in range(80):
        own = [f"w{rng.integers(10**6)}" for _ in range(25)]
        rows.append((2 * k, " ".join([*own, *phrase])))
        if k % 8 == 0:
            own[int(rng.integers(25))] = "changed"
            rows.append((2 * k + 1, " ".join([*own, *phrase])))
    near = jaccard.Nearness(5, 80)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(jaccard, "REGION_SHINGLES", 600)
    in_blocks, blocks = [], jaccard.pair_blocks
    monkeypatch.setattr(jaccard, "pair_blocks", lambda sets: in_blocks.append(sets.count()) or blocks(sets))
    found = {r.doc_id: r.component_id for r in jaccard.near_components(docs, near).collect()}
    assert sum(in_blocks) == 0
    sets = {i: set(shingle_hashes(word_hashes(t), 5).tolist()) for i, t in rows}
    linked = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    assert found == {i: min(j for j in sets if linked(sets[i], sets[j])) for i in sets}
    assert len(set(found.values())) == 80

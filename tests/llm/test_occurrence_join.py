"""T-occurrence search and the join built on it, against all pairs."""

import random

import numpy as np
import pytest

from brute_force import slow_groups, slow_set
from stratica.llm import occurrence_join as oj


def made():
    """Chains of edits, families of near copies, a line all share, and odd texts."""
    chance = random.Random(7)
    line = " ".join(f"common{i}" for i in range(30))
    texts = [None, "", " \t", "two words", "Two  Words", "a b c d e", "a b c d f", "x y x y x", "y x y x y", "x y x y x y"]
    for family in range(25):
        words = [f"f{family}w{chance.randrange(400)}" for _ in range(chance.choice([8, 12, 40, 90, 200]))]
        for _ in range(chance.randrange(1, 12)):
            texts.append(" ".join(words) + (" " + line if family % 3 else ""))
            words = list(words)
            for _ in range(chance.randrange(1, 4)):
                words[chance.randrange(len(words))] = f"x{chance.randrange(10**6)}"
    base = [f"b{i}" for i in range(120)]
    texts += [" ".join([*base[:i], "changed", *base[i + 1 :]]) for i in range(60)]
    shared = [f"s{i}" for i in range(50)]
    texts += [" ".join([*shared, *(f"own{i}_{j}" for j in range(i % 7))]) for i in range(40)]
    return texts


def expected(texts, size, p, q):
    sets = [slow_set(t, size) for t in texts]
    similar = lambda a, b: bool(sets[a]) and len(sets[a] & sets[b]) * (p + q) >= (len(sets[a]) + len(sets[b])) * p
    return sets, slow_groups(range(len(texts)), similar)


@pytest.mark.parametrize(("size", "least"), [(3, (9, 10)), (5, (4, 5)), (1, (1, 2))])
def test_made_texts_against_all_pairs(spark, size, least):
    texts = made()
    sets, groups = expected(texts, size, *least)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in oj.joined(docs, size, least).collect()}
    assert {i: r["component_id"] for i, r in rows.items()} == groups
    assert [rows[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]


def test_small_cells_and_blocks(spark, monkeypatch):
    """A query meets its partners in several cells and blocks."""
    monkeypatch.setattr(oj, "QUERIES", 2)
    monkeypatch.setattr(oj, "BLOCK", 50)
    texts = made()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in oj.joined(docs).collect()}
    assert found == expected(texts, 3, 9, 10)[1]


def test_divide_skip_against_counting():
    chance = random.Random(1)
    for _ in range(300):
        lists = [sorted(chance.sample(range(60), chance.choice([1, 2, 5, 40]))) for _ in range(chance.randrange(1, 30))]
        for need in (1, 2, len(lists) // 2 + 1, len(lists)):
            counts = {i: n for i in range(60) if (n := sum(i in part for part in lists)) >= need}
            assert oj.divide_skip(lists, need) == counts
    assert oj.divide_skip([[1]], 2) == {} and oj.divide_skip([], 1) == {}


def test_index_gives_partners_with_their_overlap():
    chance = np.random.default_rng(2)
    sets = [np.unique(chance.integers(0, 90, chance.integers(1, 80))) for _ in range(40)]
    index = oj.Index(sets)
    for query in sets:
        need = oj.occurrences(len(query), (1, 2))
        overlaps = {i: len(np.intersect1d(query, s)) for i, s in enumerate(sets)}
        assert index.partners(query, (1, 2)) == {i: n for i, n in overlaps.items() if n >= need}


@pytest.mark.parametrize("common", [0, 1])
@pytest.mark.parametrize("least", [(9, 10), (4, 5)])
def test_similar_sets_meet_within_the_bound(spark, common, least):
    """Whatever the order, sets that are similar share a short list, pass the bound at the first, and have parities alike."""
    p, q = least
    chance = np.random.default_rng(3)
    ranks = chance.integers(0, 9, oj.SLOTS).astype(np.uint8) * np.uint8(common)
    met, marks = 0, []
    for _ in range(3000):
        whole = np.unique(chance.integers(-(2**63), 2**63 - 1, chance.integers(1, 600)))
        a, b = (whole[chance.random(len(whole)) < 0.95] for _ in range(2))
        if not len(a) or not len(b):
            continue
        overlap = len(np.intersect1d(a, b))
        if overlap * (p + q) < (len(a) + len(b)) * p:
            continue
        met += 1
        marks.append((len(a), len(b), oj.parity(a, least).tolist(), oj.parity(b, least).tolist()))
        x, y = (oj.short_lists(s, ranks, least).tolist() for s in (a, b))
        i, j = next((i, y.index(s)) for i, s in enumerate(x) if s in y)
        assert min(len(a) - i, len(b) - j) * (p + q) >= (len(a) + len(b)) * p
    assert met > 300 and any(len(x) != len(y) for _, _, x, y in marks)
    assert spark.createDataFrame(marks, "m long, n long, x array<long>, y array<long>").where(~oj.alike(least)).count() == 0


def test_odd_rows(spark, odd_documents, no_documents):
    rows = oj.joined(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    one = sorted((r["component_id"] for r in rows if r["doc_id"] == 1), key=str)
    assert one == [1, 1, 1] and all(r["component_id"] == 7 for r in rows if r["doc_id"] in (7, 8))
    assert [r["component_id"] for r in rows if r["doc_id"] in (2, 3, 4)] == [r["doc_id"] for r in rows if r["doc_id"] in (2, 3, 4)]
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert oj.joined(no_documents).collect() == []


def test_documents_against_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    groups = expected([t for _, t in rows], 5, 4, 5)[1]
    found = {r["doc_id"]: r["component_id"] for r in oj.joined(docs, 5, (4, 5)).collect()}
    assert found == {rows[i][0]: rows[g][0] for i, g in groups.items()}

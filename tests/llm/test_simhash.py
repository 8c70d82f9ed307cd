import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from stratica.llm import simhash
from stratica.llm.components import components
from brute_force import slow_groups


def slow_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    hashes = [xxhash.xxh64(" ".join(found[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(found) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_within_counts_bits():
    chance = random.Random(3)
    base = [chance.getrandbits(64) for _ in range(5)]
    lanes = np.array([b ^ sum(1 << chance.randrange(64) for _ in range(chance.randrange(5))) % 2**64 for b in base * 20], dtype=np.uint64)
    planes = simhash._planes(lanes)
    for step in (1, 2, 5, 50):
        valid = (1 << (len(lanes) - step)) - 1
        near = simhash.within(planes, step, len(lanes), valid)
        expected = [i for i in range(len(lanes) - step) if (int(lanes[i]) ^ int(lanes[i + step])).bit_count() <= 2]
        assert simhash._digits(near, len(lanes)).tolist() == expected if near else not expected


def test_planted_groups_are_found_whole(spark):
    """Chains, dense clusters and bits at every position, against all pairs."""
    chance = random.Random(5)
    fps = set()
    for _ in range(60):
        seed = chance.getrandbits(64)
        for _ in range(chance.randrange(1, 12)):
            fps.add(seed)
            for _ in range(chance.randrange(4)):
                seed ^= 1 << chance.randrange(64)
    center = chance.getrandbits(64)
    fps |= {center ^ (1 << i) for i in range(64)} | {0, 3, 2**63}
    expected = slow_groups(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 2)
    signed = {f: f - 2**64 if f >> 63 else f for f in fps}
    rows = spark.createDataFrame([(i, signed[f]) for i, f in enumerate(sorted(fps))], "doc_id long, fp long")
    found = {r["fp"]: r["component_id"] for r in simhash.groups(rows).collect()}
    smallest = {}
    for i, f in enumerate(sorted(fps)):
        smallest.setdefault(expected[f], i)
    assert found == {signed[f]: smallest[expected[f]] for f in fps}


def test_documents_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    groups = slow_groups(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    rows = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in rows} == {i: (fps[i], groups[i]) for i in fps}


def test_defined_cases(spark, odd_documents, no_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    blank = [r for r in rows if r["fp"] == 0]
    assert len(blank) == 4 and {r["component_id"] for r in blank} == {2}
    kept = simhash.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    fingerprints = defaultdict(int)
    for row in kept.collect():
        fingerprints[slow_fingerprint(row["text"])] += 1
    assert set(fingerprints.values()) == {1}
    assert simhash.near_duplicates(no_documents).count() == simhash.one_of_each(no_documents).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 2), (2, 3), (5, 4), (9, 9)], [(i, i + 1) for i in range(40)]])
def test_components(spark, links):
    nodes = {n for a, b in links if a != b for n in (a, b)}
    edges = {frozenset(x) for x in links}
    expected = slow_groups(sorted(nodes), lambda a, b: frozenset((a, b)) in edges)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == expected and len(found) == len(expected)

"""Proofs against a tree built plainly in memory."""

import zlib
from hashlib import sha256

import pytest

from stratica.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[f] for f in FIELDS)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def steps(tree, rank):
    """(sibling or None, whether it stands left) from the leaf up."""
    for level in tree[:-1]:
        other = rank ^ 1
        yield (level[other] if other < len(level) else None), other < rank
        rank //= 2


def slow(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = levels([leaf(r) for r in by_lang[lang]])
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for place, lang in enumerate(langs):
        for rank, row in enumerate(by_lang[lang]):
            path = [*steps(trees[lang], rank), *steps(top, place)]
            name = "" if row["doc_id"] is None else str(row["doc_id"])
            hit = zlib.crc32(name.encode()) % 7 == 0 and row["n_chars"] is not None
            at = leaf({**row, "n_chars": row["n_chars"] + 1}) if hit else leaf(row)
            for other, left in path:
                at = digest((other or "") + at if left else at + (other or ""))
            proof = digest("".join(other or "" for other, _ in path))
            out.append((row["doc_id"], leaf(row), trees[lang][-1][0], top[-1][0], proof, at, at == top[-1][0]))
    return sorted(out, key=str)


def check(docs):
    rows = [r.asDict() for r in docs.select(*FIELDS).collect()]
    found = merkle.proofs(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=str) == slow(rows)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("depth", [1, 2, 9])
def test_trees_of_many_sizes(spark, monkeypatch, depth):
    """Segments of two, four and 512 leaves: several rounds, trees that end in different ones."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "SPAN", 1 << depth)
    sizes = {None: 1, "": 2, "a": 3, "b": 4, "é": 5, "z": 8, "𝄞": 17, "y": 33}
    rows = [(1000 * i + k, f"text {i} {k}", lang, "s", k) for i, (lang, n) in enumerate(sizes.items()) for k in range(n)]
    check(spark.createDataFrame(rows, SCHEMA))
    check(spark.createDataFrame(rows[:1], SCHEMA))
    check(spark.createDataFrame(rows[1:3], SCHEMA))


def test_more_than_a_segment(spark):
    check(spark.createDataFrame([(k, f"t{k}", "en" if k % 9 else "de", "s", k) for k in range(2500)], SCHEMA))


def test_odd_rows(spark, odd_documents, no_documents):
    check(odd_documents)
    check(odd_documents.unionByName(odd_documents))
    assert merkle.proofs(no_documents).collect() == []


def test_records_lead_from_the_root_to_every_leaf(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    records, root = merkle.manifest(docs)
    children = {r["digest"]: r["children"] for r in records.collect()}
    assert all(node == digest("".join(own)) for node, own in children.items())
    reached, open_ = set(), [root.first()["root"]]
    while open_:
        at = open_.pop()
        open_ += children[at] if at in children else []
        reached.add(at)
    assert {leaf(r.asDict()) for r in docs.collect()} == {d for d in reached if d not in children}

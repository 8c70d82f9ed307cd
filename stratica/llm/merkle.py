"""Merkle manifest of a data set: a content-addressed graph, and the proof of every row.

A row's digest is a leaf. Per language leaves stand in order of ``doc_id``; every two consecutive nodes of a
level (the last run may be one) become the digest of their digests until one remains, the language's
subroot, and the subroots become the root in the same way. What is kept are records from a digest to
its children: equal contents share a record.

A proof is found by descent. A request for a leaf starts at the root with the binary digits of the leaf's
rank, looks up the children of the digest it stands on, takes the child its next digit names and collects
the other one. What was collected from the root down is reversed at the end, as proofs run from the leaf up.

Levels are worked off in segments of ``DEPTH``: a segment is a subtree of at most 512 leaves, so no group
grows with the data, and N rows need a round of grouping for every nine levels. Requests of the upper segments
are made once for each subtree below, not once for each row; only the last step has a row per document.

Defined results: null fields count as absent, which differs from empty; rows that repeat are leaves of their
own, in order of their digests where the ids agree (null ids first); a language of one row has its leaf for
subroot; an empty table gives no rows. Columns other than the five are not read.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratica.llm.common import numbered, remainder, written

#: Levels of a segment.
DEPTH = 9
SPAN = 1 << DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One row in so many is tampered with, to show that its proof fails.
TAMPERED = 7
_SEGMENT = "tree string, seg long, root string, records array<struct<digest string, children array<string>>>"
_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(n_chars: Column) -> Column:
    """The digest of a row, with ``n_chars`` in the place of its own."""
    fields = [_field(n_chars if name == "n_chars" else F.col(name)) for name in FIELDS]
    return F.sha2(F.concat(*fields), 256)


def tree_key(lang: Column) -> Column:
    """A text that sorts as the languages do: null first, then by UTF-8 bytes."""
    return F.when(lang.isNull(), "0").otherwise(F.concat(F.lit("1"), lang))


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def grown(leaves: list[str], depth: int) -> tuple[str, list[tuple[str, list[str]]]]:
    """The root of the leaves after ``depth`` levels, and the records of every node above them."""
    records: dict[str, list[str]] = {}
    level = leaves
    for _ in range(depth):
        above = []
        for i in range(0, len(level), 2):
            children = level[i : i + 2]
            node = _digest("".join(children))
            records[node] = children
            above.append(node)
        level = above
    return level[0], list(records.items())


def depth_of(leaves: int) -> int:
    """Levels until one node remains."""
    return max(0, leaves - 1).bit_length()


def descended(root: str, records: dict[str, list[str]], rank: int, depth: int) -> list[str]:
    """What is left beside the way from the root to the leaf of this rank, from the root down.

    Each step is the unselected child behind ``<`` or ``>``, the side it lies on, or ``=`` where there is none.
    """
    path, at = [], root
    for digit in ((rank >> level) & 1 for level in range(depth - 1, -1, -1)):
        children = records[at]
        if len(children) == 1:
            path.append("=")
        else:
            path.append(("<" if digit else ">") + children[1 - digit])
        at = children[digit]
    return path


def folded(leaf: str, steps: list[str]) -> str:
    """The root that a leaf and the steps of its reversed path give."""
    for step in steps:
        other = step[1:]
        leaf = _digest(other + leaf if step[0] == "<" else leaf + other)
    return leaf


def _segments(nodes: DataFrame, counts: DataFrame) -> DataFrame:
    """The segments over ``nodes(tree, rank, digest)`` as ``(tree, seg, root, records)``."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        n = table.column("n")[0].as_py()
        root, records = grown(table.column("digest").to_pylist(), DEPTH if n > SPAN else depth_of(n))
        kinds = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))
        packed = [{"digest": d, "children": c} for d, c in records]
        return pa.table(
            {
                "tree": table.column("tree").slice(0, 1), "seg": table.column("seg").slice(0, 1),
                "root": pa.array([root]), "records": pa.array([packed], kinds),
            }
        )

    rows = nodes.join(counts, "tree").withColumn("seg", F.shiftright("rank", DEPTH))
    return rows.groupBy("tree", "seg").applyInArrow(build, _SEGMENT)


def grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Trees over ``nodes(tree, rank, digest)``: their rounds of segments from the bottom, and ``(tree, subroot, n)``."""
    rounds, finished = [], []
    sizes = written(nodes.groupBy("tree").agg(F.count("*").alias("n")), "merkle-sizes")
    counts = sizes
    while True:
        rounds.append(written(_segments(nodes, counts), "merkle-segments"))
        counts = written(rounds[-1].groupBy("tree").agg(F.count("*").alias("n")), "merkle-counts")
        whole = rounds[-1].join(counts.where("n = 1").select("tree"), "tree", "left_semi")
        finished.append(whole.select("tree", F.col("root").alias("subroot")))
        counts = counts.where("n > 1")
        if counts.isEmpty():
            return rounds, written(reduce(DataFrame.unionByName, finished).join(sizes, "tree"), "merkle-subroots")
        nodes = rounds[-1].select("tree", F.col("seg").alias("rank"), F.col("root").alias("digest"))


def _walker(segments: pa.Table):
    """(root, records, path above) of the one segment of a group."""
    row = segments.to_pylist()[0]
    return row["root"], {r["digest"]: r["children"] for r in row["records"]}, row["path"], row["depth"]


def _with_depth(segments: DataFrame, level: int, sizes: DataFrame) -> DataFrame:
    """Segments with how many levels they hold: all, or in a tree's last round what its nodes there need."""
    nodes = F.ceil(F.col("n") / F.lit(float(SPAN**level))).cast("long")
    at = F.when(nodes > SPAN, DEPTH).when(nodes == 1, 0).otherwise(F.length(F.bin(nodes - 1)))
    return segments.join(sizes.select("tree", at.alias("depth")), "tree")


def descend(rounds: list[DataFrame], sizes: DataFrame) -> DataFrame:
    """The lowest segments ``(tree, seg, root, records, depth, path)`` with the path from their tree's root down to them."""
    above = None
    for level in range(len(rounds) - 1, -1, -1):
        here = _with_depth(rounds[level], level, sizes)
        if above is None:
            here = here.withColumn("path", F.array().cast("array<string>"))
        else:
            here = here.join(above, ["tree", "seg"], "left")
            here = here.withColumn("path", F.coalesce("path", F.array().cast("array<string>")))
        if not level:
            return here

        def walk(segments: pa.Table, requests: pa.Table) -> pa.Table:
            root, records, path, depth = _walker(segments)
            ranks = requests.column("rank").to_pylist()
            paths = [path + descended(root, records, rank & (SPAN - 1), depth) for rank in ranks]
            return pa.table(
                {"tree": requests.column("tree"), "seg": requests.column("rank"), "path": pa.array(paths, pa.list_(pa.string()))}
            )

        requests = rounds[level - 1].select("tree", F.col("seg").alias("rank")).withColumn("seg", F.shiftright("rank", DEPTH))
        # a tree that ends in a lower round has no segment here and asks for none
        requests = requests.join(here.select("tree").distinct(), "tree", "left_semi")
        found = here.groupBy("tree", "seg").cogroup(requests.groupBy("tree", "seg"))
        above = written(found.applyInArrow(walk, "tree string, seg long, path array<string>"), "merkle-paths")
    raise ValueError("no rounds")


def leaves(docs: DataFrame) -> DataFrame:
    """``(tree, rank, doc_id, leaf, tampered)`` of every row, ranks per tree from 0."""
    n = F.col("n_chars")
    hit = remainder(F.col("doc_id"), TAMPERED) == 0
    rows = docs.select(
        tree_key(F.col("lang").cast("string")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(n).alias("leaf"),
        F.when(hit & n.isNotNull(), leaf_digest(n.cast("decimal(38,0)") + 1)).alias("tampered"),
    )
    rows = numbered(rows, ["tree", "doc_id", "leaf"], "merkle-leaves")
    first = rows.groupBy("tree").agg(F.min("place").alias("first"))
    return rows.join(first, "tree").select(
        "tree", (F.col("place") - F.col("first")).alias("rank"), "doc_id", "leaf", F.coalesce("tampered", "leaf").alias("tampered")
    )


def manifest(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The digest-to-children records of a data set, each content once, and its root as one row."""
    rows = written(leaves(docs).select("tree", "rank", F.col("leaf").alias("digest")), "merkle-nodes")
    rounds, subroots = grow(rows)
    top, root = grow(_top(subroots))
    records = [r.select(F.explode("records").alias("r")).select("r.digest", "r.children") for r in rounds + top]
    return reduce(DataFrame.unionByName, records).dropDuplicates(["digest"]), root.select(F.col("subroot").alias("root"))


def _top(subroots: DataFrame) -> DataFrame:
    rows = numbered(subroots, ["tree"], "merkle-trees")
    return rows.select(F.lit("").alias("tree"), F.col("place").alias("rank"), F.col("subroot").alias("digest"), F.col("tree").alias("own"))


def proofs(docs: DataFrame) -> DataFrame:
    """Every row's leaf, subroot and root, the digest of its proof, and whether its (perhaps tampered) leaf still folds to the root."""
    rows = written(leaves(docs), "merkle-leaves")
    if rows.isEmpty():
        return docs.sparkSession.createDataFrame([], _PROOF)
    rounds, subroots = grow(rows.select("tree", "rank", F.col("leaf").alias("digest")))
    top = written(_top(subroots), "merkle-top")
    top_rounds, apex = grow(top.drop("own"))
    lowest = descend(top_rounds, apex)

    def to_trees(segments: pa.Table, requests: pa.Table) -> pa.Table:
        root, records, path, depth = _walker(segments)
        paths = [path + descended(root, records, rank & (SPAN - 1), depth) for rank in requests.column("rank").to_pylist()]
        return pa.table(
            {"tree": requests.column("own"), "subroot": requests.column("digest"), "upper": pa.array(paths, pa.list_(pa.string()))}
        )

    requests = top.withColumn("seg", F.shiftright("rank", DEPTH))
    trees = lowest.groupBy("tree", "seg").cogroup(requests.groupBy("tree", "seg"))
    trees = written(trees.applyInArrow(to_trees, "tree string, subroot string, upper array<string>"), "merkle-upper")
    root = apex.first()["subroot"]
    segments = descend(rounds, subroots).join(trees, "tree")
    segments = segments.withColumn("path", F.concat("upper", "path")).drop("upper")

    def prove(own: pa.Table, asked: pa.Table) -> pa.Table:
        subroot = own.column("subroot")[0].as_py()
        at, records, path, depth = _walker(own)
        ranks, ids, plain, changed = (asked.column(c).to_pylist() for c in ("rank", "doc_id", "leaf", "tampered"))
        proof, refolded = [], []
        for rank, leaf in zip(ranks, changed, strict=True):
            steps = (path + descended(at, records, rank & (SPAN - 1), depth))[::-1]
            proof.append(_digest("".join(s[1:] for s in steps)))
            refolded.append(folded(leaf, steps))
        n = len(ids)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()), "leaf": pa.array(plain, pa.string()), "subroot": pa.array([subroot] * n, pa.string()),
                "root": pa.array([root] * n, pa.string()), "proof_sha256": pa.array(proof, pa.string()),
                "folded_root": pa.array(refolded, pa.string()), "verified": pa.array([f == root for f in refolded], pa.bool_()),
            }
        )

    asked = rows.withColumn("seg", F.shiftright("rank", DEPTH))
    return segments.groupBy("tree", "seg").cogroup(asked.groupBy("tree", "seg")).applyInArrow(prove, _PROOF)

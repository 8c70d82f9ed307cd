"""Near-duplicates by SimHash with a bit-sliced comparison.

A fingerprint is 64 majority votes over the hashes of a text's three-word shingles. Two fingerprints are
linked at ``RADIUS`` or fewer differing bits, and linked documents form groups.

Candidates: a fingerprint is eight bytes; if two differ in at most two bits, six bytes agree whole. So each
fingerprint goes into 28 buckets, one for every choice of six bytes, and every link lies in one of them. A
bucket fixes 48 bits, so it can never hold more than 65,536 different fingerprints, whatever the data:
copies are folded before. Inside a run of buckets, bit planes are stored vertically, as one long integer per
bit with a lane per fingerprint. Lane i is compared with lane i + d in all lanes at once: the planes' differences go
into carry-save counters (ones, twos, over), and the block is abandoned once no lane is within the radius.

A bucket emits at most one link per member, enough to keep its groups together; the links of all buckets meet
in distributed connected components.

Defined results: null, empty and blank texts have fingerprint zero, linked like any other; texts of one
or two words are one shingle; a group is named by its smallest id, null if all its ids are null; no rows
give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from stratica.llm.common import WORD, small_batches, spare, written
from stratica.llm.components import components

SHINGLE = 3
RADIUS = 2
#: Bytes that must agree whole: of eight, all but ``RADIUS``.
_CHOICES = list(combinations(range(8), 8 - RADIUS))
_MASKS = [sum(0xFF << (8 * byte) for byte in choice) for choice in _CHOICES]
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_LANES = 4096


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    from xxhash import xxh64_intdigest

    found = re.findall(WORD, (text or "").translate(_LOWER))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    hashes = np.fromiter((xxh64_intdigest(s, 42) for s in shingles), dtype="<u8", count=len(shingles))
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):  # bounded scratch for very long texts
        part = hashes[at : at + 8192]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def fingerprint_of(text: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in text], dtype="uint64").astype("int64")


def _planes(lanes: np.ndarray) -> list[int]:
    """One integer per bit; its binary digit i is that bit of lane i."""
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits, axis=0, bitorder="little")
    return [int.from_bytes(packed[:, b].tobytes(), "little") for b in range(64)]


def _digits(number: int, lanes: int) -> np.ndarray:
    raw = np.frombuffer(number.to_bytes((lanes + 7) // 8, "little"), dtype=np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")[:lanes])


def within(planes: list[int], step: int, lanes: int, valid: int) -> int:
    """Lanes i of ``valid`` whose fingerprint is within two bits of lane i + ``step``'s."""
    ones = twos = over = 0
    near = valid
    for plane in planes:
        differ = plane ^ (plane >> step)
        carry = ones & differ
        ones ^= differ
        over |= twos & carry
        twos ^= carry
        near = valid & ~(over | (ones & twos))
        if not near:
            break
    return near


def linked(fps: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """For each fingerprint the first one of its group, links within the bucket considered.

    ``fps`` (unsigned) is sorted by ``bucket``, the bucket's number, and holds no fingerprint twice
    in a bucket.
    """
    n = len(fps)
    root = np.arange(n)
    size = np.bincount(bucket, minlength=int(bucket[-1]) + 1 if n else 0)
    rest = np.flatnonzero(size[bucket] > 1)
    at = 0
    while at < len(rest):
        end = min(at + _LANES, len(rest))
        while end < len(rest) and bucket[rest[end]] == bucket[rest[end - 1]]:
            end += 1  # a bucket is never cut
        block, own = rest[at:end], bucket[rest[at:end]]
        planes = [p for p in _planes(fps[block]) if p]
        lanes = end - at
        full = (1 << lanes) - 1
        planes = [p for p in planes if p != full]
        for step in range(1, int(size[own].max())):
            together = np.zeros(lanes, dtype=np.uint8)
            together[: lanes - step] = own[:-step] == own[step:]
            valid = int.from_bytes(np.packbits(together, bitorder="little").tobytes(), "little")
            near = within(planes, step, lanes, valid)
            if not near:
                continue
            found = _digits(near, lanes)
            left, right = block[found], block[found + step]
            fresh = root[left] != root[right]
            for a, b in zip(left[fresh].tolist(), right[fresh].tolist(), strict=True):
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                root[max(a, b)] = min(a, b)
            if fresh.any():
                while not np.array_equal(root[block], root[root[block]]):
                    root[block] = root[root[block]]
        at = end
    return root


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each bucket; a bucket that spans batches is held until it is whole (65,536 rows at most)."""
    held: list[np.ndarray] = []

    def links(rows: np.ndarray) -> pa.RecordBatch:
        cut = np.any(rows[:, 1:] != np.roll(rows[:, 1:], 1, axis=0), axis=1)
        cut[0] = True
        root = linked(rows[:, 0].astype(np.uint64), np.cumsum(cut) - 1)
        moved = root != np.arange(len(root))
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[moved, 0], pa.int64()), pa.array(rows[root[moved], 0], pa.int64())], names=["a", "b"]
        )

    for batch in batches:
        rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        if not len(rows):
            continue
        rows = np.vstack([*held, rows])
        differs = np.flatnonzero(np.any(rows[:, 1:] != rows[-1, 1:], axis=1))
        whole = int(differs[-1]) + 1 if len(differs) else 0
        if whole:
            yield links(rows[:whole])
        held = [rows[whole:]]
    if held and len(held[0]):
        yield links(held[0])


def near_links(fps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between different fingerprints that keep every group of linked ones together.

    ``fps`` has the long column ``fp``.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in _MASKS]
    choice = F.posexplode(F.array(*map(F.lit, masks))).alias("choice", "mask")
    spots = fps.select("fp").distinct().select("fp", choice)
    spots = spots.select("fp", F.col("choice").cast("long").alias("choice"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    spots = spots.repartition("choice", "key").sortWithinPartitions("choice", "key", "fp")
    return spots.mapInArrow(_bucket_links, "a long, b long").distinct()


def groups(rows: DataFrame, further: DataFrame | None = None) -> DataFrame:
    """``(fp, component, component_id)`` of every fingerprint in ``rows(doc_id, fp)``.

    ``component`` is the smallest fingerprint of the group, ``component_id`` its smallest document id.
    ``further(a, b)`` holds links between fingerprints besides those within the radius.
    """
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    links = near_links(rows)
    found = written(components(links if further is None else links.unionByName(further)), "simhash-components")
    named = first.join(found, F.col("fp") == F.col("node"), "left")
    named = written(named.select("fp", "first", F.coalesce("component", "fp").alias("component")), "simhash-named")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return written(named.join(smallest, "component").select("fp", "component", "component_id"), "simhash-groups")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every document row; ``fp`` is signed."""
    small_batches(docs.sparkSession)
    rows = written(docs.select("doc_id", fingerprint_of("text").alias("fp")), "simhash-rows")
    return rows.join(groups(rows), "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _further(rows: DataFrame, similar: DataFrame) -> DataFrame:
    """Links between the fingerprints of texts grouped by their keys; ``similar`` is ``(node, component)``, both keys."""
    marks = written(rows.select("key", "fp").distinct(), "simhash-keys")
    own = marks.join(similar, F.col("key") == F.col("node")).select(F.col("fp").alias("a"), "component")
    return own.join(marks, F.col("component") == F.col("key")).select("a", F.col("fp").alias("b")).where("a <> b").distinct()


def one_of_each(docs: DataFrame, key: Column | None = None, similar: DataFrame | None = None) -> DataFrame:
    """One document of each group: the row with the smallest id, columns unchanged.

    Groups are SimHash's. ``similar(node, component)`` joins to them what another comparison found besides, as groups of texts
    under ``key``, a hash of the text. Rows are told apart by a hash of all their columns, so of an id that repeats with different
    texts one row stays; copies of a whole row fold into one.
    """
    small_batches(docs.sparkSession)
    tag = spare(docs, "row_hash")
    tagged = docs.withColumn(tag, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    named = [] if key is None else [key.alias("key")]
    rows = tagged.select("doc_id", F.col(tag).alias("same"), fingerprint_of("text").alias("fp"), *named)
    rows = written(rows, "simhash-rows")
    further = None if similar is None else _further(rows, similar)
    # a fingerprint's rows fold first, then its group's fingerprints
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "same")).alias("kept")
    of_fp = rows.groupBy("fp").agg(smallest).join(groups(rows, further), "fp")
    kept = of_fp.groupBy("component").agg(F.min("kept").alias("kept")).select("kept.doc_id", "kept.same")
    copies = rows.groupBy("doc_id", "same").agg(F.count("*").alias("copies"))
    match = F.col("k.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("k.same") == F.col("c.same"))
    kept = written(kept.alias("k").join(copies.alias("c"), match).select("k.doc_id", "k.same", "copies"), "simhash-kept")

    def rows_of(part: DataFrame) -> DataFrame:
        match = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col(f"d.{tag}") == F.col("k.same"))
        return tagged.alias("d").join(part.alias("k"), match, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])

    once, often = kept.where("copies = 1"), kept.where("copies > 1")
    return rows_of(once) if often.isEmpty() else rows_of(once).unionByName(rows_of(often).dropDuplicates())

"""Similarity join of texts on word shingles by T-occurrence search.

Two texts are linked when their sets of shingles have a Jaccard similarity of p/q or more. A partner of a set of n
shingles must occur on T = ⌈p n / q⌉ of the n inverted lists of its shingles. DivideSkip does not merge all lists: the L
longest are set aside, the short ones are merged through a heap, and whoever occurs T - L times there is
looked up in the long lists by binary search.

On a cluster this happens twice:

1. *Short lists.* With L = T - 1, a partner occurs at least once on the n - T + 1 shortest lists, of either text. Only these
   postings are shuffled, by shingle, with the size of the set and the place of the shingle in it. What may
   come before and after a shared posting bounds the overlap, and pairs below it are not looked at. How
   long a list is, is estimated from a sample: the estimate decides which pairs are looked at in vain, never which are found.
2. *Cells.* Whom the lists bring together goes, if parities of the two sets allow it, into cells of some hundred queries with
   their possible partners. A cell is an inverted index of its own, made of whole sets and searched by
   DivideSkip in full. Partners pass through in blocks of bounded size, so a query with very many needs no more memory.

Components need no pair of a group twice. First neighbours on each list are searched, in a few orders, which joins most of a
family of near copies at a cost in proportion to its size; then, on lists that still hold several groups, members
outside the largest group against all. No link between different groups is lost.

Defined results: case of A to Z and the kind of white space do not count; copies are folded first, by a 64-bit hash of the
text; a text of fewer words than a shingle is one shingle; a text without words, or none, has the empty set
and is linked with nothing; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratica.llm.common import SPACES, WORD, small_batches, written
from stratica.llm.components import components

#: Shingles of three words, similar at 90 in a hundred.
SHINGLE, LEAST = 3, (9, 10)
#: Weight of a long list's look-up against a merge step (Li, Lu and Lu, 2008).
MU = 0.0085
#: About so many texts are sampled to estimate how long lists are, counted in so many slots.
SAMPLE, SLOTS, OFTEN = 20_000, 1 << 22, 8
#: Queries of a cell, and shingles of the partners indexed at a time.
QUERIES, BLOCK = 256, 1 << 20
_MEMBER = ("key", "size", "place", "own")
_LEAST_BITS = 64
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(text: Column) -> Column:
    """Hash of a text, equal for copies; 0 for texts without words."""
    return F.when(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)) == "", F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The different shingles of a text as sorted signed 64-bit hashes."""
    from xxhash import xxh64_intdigest

    found = re.findall(WORD, (text or "").translate(_FOLD))
    if not found:
        return np.empty(0, dtype=np.int64)
    words = np.fromiter(map(xxh64_intdigest, found), dtype=np.uint64, count=len(found))
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        out = (out ^ words[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out.view(np.int64))


def occurrences(n: int, least: tuple[int, int]) -> int:
    """T: on how many of its ``n`` lists any partner of a set must occur."""
    return -(-least[0] * n // least[1])


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(42)).astype(np.int64)


def short_lists(found: np.ndarray, common: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """The shingles of the n - T + 1 shortest lists, by estimate, shortest first; hashes settle ties for all texts alike."""
    order = np.lexsort((found, common[_slot(found)]))
    return found[order[: len(found) - occurrences(len(found), least) + 1]]


def parity(found: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """Of each of 2^k cells, whether an odd number of shingles falls into it; packed in longs.

    There are five to ten times as many cells as shingles in which a partner of like size may differ: sets without likeness
    then differ in far more cells than allowed.
    """
    p, q = least
    need = 10 * len(found) * (q - p) // (p + q)
    bits = max(_LEAST_BITS, 1 << max(0, need - 1).bit_length())
    return np.packbits(np.bincount(found & (bits - 1), minlength=bits) & 1, bitorder="little").view("<i8")


def alike(least: tuple[int, int], m: str = "m", n: str = "n", x: str = "x", y: str = "y") -> Column:
    """Whether sets of sizes m and n with parities x and y may be similar.

    Parities differ in no more cells than there are shingles that only one set has. Of two lengths the longer is folded
    onto the shorter; where it is over twice as long, nothing is ruled out.
    """
    p, q = least
    x, y = F.col(x), F.col(y)

    def fold(own: Column, other: Column) -> Column:
        half = F.size(other)
        halves = F.zip_with(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(own) == 2 * half, halves).otherwise(own)

    cells = F.zip_with(fold(x, y), fold(y, x), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    far = F.greatest(F.size(x), F.size(y)) > 2 * F.least(F.size(x), F.size(y))
    return far | (F.aggregate(cells, F.lit(0), lambda s, c: s + c) * (p + q) <= (F.col(m) + F.col(n)) * (q - p))


def divide_skip(lists: list[list[int]], need: int) -> dict[int, int]:
    """The ids on at least ``need`` of the sorted ``lists``, and on how many."""
    if need < 1 or len(lists) < need:
        return {}
    lists = sorted(lists, key=len)
    n_long = min(need - 1, int(need / (MU * log2(max(2, len(lists[-1]))) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    out = {}
    for found, run in groupby(heapq.merge(*short)):
        count = sum(1 for _ in run)
        if count < need - n_long:
            continue
        left = n_long
        for other in long:
            at = bisect_left(other, found)
            count += at < len(other) and other[at] == found
            left -= 1
            if count + left < need:
                break
        if count >= need:
            out[found] = count
    return out


class Index:
    """Inverted lists over a block of sets."""

    def __init__(self, sets: list[np.ndarray]):
        whole = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(whole, kind="stable")  # lists stay sorted by owner
        self.owner, whole = owner[order], whole[order]
        starts = np.flatnonzero(np.append(True, whole[1:] != whole[:-1]))
        self.shingles, self.starts = whole[starts], np.append(starts, len(whole))

    def partners(self, query: np.ndarray, least: tuple[int, int]) -> dict[int, int]:
        """Owners that occur on T of the query's lists, with their overlap."""
        at = np.minimum(np.searchsorted(self.shingles, query), len(self.shingles) - 1)
        at = at[self.shingles[at] == query]
        need = occurrences(len(query), least)
        if len(at) < need:
            return {}
        return divide_skip([self.owner[self.starts[i] : self.starts[i + 1]].tolist() for i in at.tolist()], need)


def _texts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray | None], list[int]]]:
    """Each batch (whose last columns are key and text) with the sets of its texts and their sizes; None for a copy met of late."""
    seen: dict[int, int] = {}
    for batch in batches:
        sets: list[np.ndarray | None] = []
        sizes: list[int] = []
        for key, text in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            known = seen.get(key)
            own = shingles(text, size) if known is None else None
            sets.append(own)
            sizes.append(known if own is None else len(own))
            if len(seen) > 100_000:
                seen.clear()
            seen[key] = sizes[-1]
        yield batch, sets, sizes


def _commonness(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots the sample has ``OFTEN`` or more times, and the binary logarithms of how often."""

    def slots(batches):
        for _, sets, _ in _texts(batches, size):
            found = [_slot(s) for s in sets if s is not None]
            if found:
                slot, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n)], names=["slot", "n"])

    def packed(batches):
        for batch in batches:
            slot = batch.column(0).to_numpy().astype("<i4")
            n = np.log2(batch.column(1).to_numpy()).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([slot.tobytes()]), pa.array([n.tobytes()])], names=["slot", "n"])

    n, scale = texts.count(), 1 << 30
    sample = texts.where(F.pmod("key", F.lit(scale)) < SAMPLE * scale // n) if n > SAMPLE else texts
    counted = sample.mapInArrow(slots, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
    found = counted.mapInArrow(packed, "slot binary, n binary").collect()  # at most SLOTS entries of five bytes
    return tuple(np.frombuffer(b"".join(r[c] for r in found), dtype=kind) for c, kind in (("slot", "<i4"), ("n", np.uint8)))


def prepared(docs: DataFrame, size: int, least: tuple[int, int]) -> DataFrame:
    """``docs(..., key, text)`` with the text's ``size``, and for one row of each key at least its short lists, its parity
    and how many of its shingles are ``rare`` by estimate.

    One pass over the texts; written, for the steps that follow read different columns.
    """
    often = _commonness(docs.select("key", "text"), size)
    kept = docs.drop("text").schema
    added = [("size", T.LongType()), ("rare", T.LongType()), ("lists", T.ArrayType(T.LongType())), ("parity", T.ArrayType(T.LongType()))]
    schema = T.StructType([*kept.fields, *(T.StructField(name, kind) for name, kind in added)])

    def rows(batches):
        common = np.zeros(SLOTS, dtype=np.uint8)
        common[often[0]] = often[1]
        for batch, sets, sizes in _texts(batches, size):
            lists = [None if s is None or not len(s) else short_lists(s, common, least) for s in sets]
            marks = [None if s is None or not len(s) else parity(s, least) for s in sets]
            rare = [None if s is None else int((common[_slot(s)] == 0).sum()) for s in sets]
            longs = pa.list_(pa.int64())
            more = [pa.array(sizes, pa.int64()), pa.array(rare, pa.int64()), pa.array(lists, longs), pa.array(marks, longs)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more], names=schema.names)

    return written(docs.mapInArrow(rows, schema), "join-prepared")


def _bound(least: tuple[int, int], m: str, n: str, i: str, j: str) -> Column:
    """Whether sets of sizes m and n that first meet at places i and j of their lists can be similar."""
    p, q = least
    fit = F.least(m, n) * q >= F.greatest(m, n) * p
    most = F.least(F.col(m) - F.col(i), F.col(n) - F.col(j))  # the shared one and what follows it
    return fit & (most * (p + q) >= (F.col(m) + F.col(n)) * p)


def _searched(least: tuple[int, int]):
    """Links that hold each cell's groups together; rows are cell, asks, held, key and set, those that ask first."""
    p, q = least

    def links(queries: list[tuple[int, np.ndarray]], held: list[tuple[int, np.ndarray]], root: dict[int, int]) -> pa.RecordBatch:
        def find(key: int) -> int:
            while (up := root.setdefault(key, key)) != key:
                root[key] = key = root.setdefault(up, up)
            return key

        index = Index([s for _, s in held])
        a, b = [], []
        for key, own in queries:
            for i, overlap in index.partners(own, least).items():
                other, others = held[i]
                if overlap * (p + q) >= (len(own) + len(others)) * p and (x := find(key)) != (y := find(other)):
                    root[x] = y
                    a.append(max(key, other))
                    b.append(min(key, other))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def rows(batches):
        for batch in batches:
            cells, asks, held, keys = (batch.column(i).to_pylist() for i in range(4))
            sets = batch.column(4)
            at, flat = sets.offsets.to_numpy(), sets.values.to_numpy(zero_copy_only=False)
            for i in range(len(cells)):
                yield cells[i], asks[i], held[i], keys[i], flat[at[i] : at[i + 1]].copy()

    def body(batches):
        for _, members in groupby(rows(batches), key=lambda r: r[0]):
            queries, held, total, root = [], [], 0, {}
            for _, asks, listed, key, own in members:
                if asks:
                    queries.append((key, own))
                if listed:
                    held.append((key, own))
                    total += len(own)
                # rows that ask come first: only when they are all there is a block searched
                if total >= BLOCK and not asks:
                    yield links(queries, held, root)
                    held, total = [], 0
            if held:
                yield links(queries, held, root)

    return body


def _sets(size: int):
    def body(batches):
        for batch, sets, _ in _texts(batches, size):
            own = [(k, s) for k, s in zip(batch.column(0).to_pylist(), sets, strict=True) if s is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in own], pa.int64()), pa.array([s for _, s in own], pa.list_(pa.int64()))], names=["key", "own"]
            )

    return body


def _verified(pairs: DataFrame, parities: DataFrame, texts: DataFrame, size: int, least: tuple[int, int]) -> DataFrame:
    """Links among the ``pairs(a, b)``: parities first, then whole sets in cells."""
    both = pairs.join(parities.select(F.col("key").alias("a"), F.col("size").alias("m"), F.col("parity").alias("x")), "a")
    both = both.join(parities.select(F.col("key").alias("b"), F.col("size").alias("n"), F.col("parity").alias("y")), "b")
    near = written(both.where(alike(least)).select("a", "b"), "join-near")
    cells = max(1, near.count() // QUERIES)
    cell = F.pmod(F.xxhash64("a"), F.lit(cells)).alias("cell")
    role = lambda key, asks: near.select(cell, F.col(key).alias("key"), F.lit(asks).alias("asks"))
    roles = role("a", True).unionByName(role("b", False)).groupBy("key", "cell")
    roles = written(roles.agg(F.max("asks").alias("asks"), F.max(~F.col("asks")).alias("held")), "join-roles")
    wanted = texts.join(roles.select("key").distinct(), "key", "left_semi").select("key", "text")
    sets = wanted.mapInArrow(_sets(size), "key long, own array<long>").dropDuplicates(["key"])
    dealt = roles.join(sets, "key").select("cell", "asks", "held", "key", "own")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell", F.col("asks").desc(), "key")
    return written(dealt.mapInArrow(_searched(least), "a long, b long").distinct(), "join-links")


def links(table: DataFrame, texts: DataFrame, size: int = SHINGLE, least: tuple[int, int] = LEAST, rounds: int = 0) -> DataFrame:
    """Links ``(a, b)`` of keys that keep every group of similar texts together.

    ``table`` is what :func:`prepared` gives, ``texts(key, text)`` the texts behind it. ``rounds`` of neighbours in other orders
    come before all open pairs are looked at: they cost a scan each, and pay where a low similarity leaves many groups on a list. They never change the groups.
    """
    listed = table.where(F.col("lists").isNotNull())
    postings = listed.select("key", "size", "rare", F.posexplode("lists").alias("place", "shingle"))
    # the same neighbours on list after list, copies with as many edits of their own side by side
    line = Window.partitionBy("shingle").orderBy("rare", "size", "key")
    ahead = lambda c: F.lead(c).over(line).alias(f"next_{c}")
    last = F.lag("key").over(line).alias("last_key")
    rows = postings.select("*", ahead("key"), ahead("size"), ahead("place"), last)
    # lists of one text go; copies of a row that several tasks gave stand side by side
    shared = written(rows.where("next_key <> key OR last_key <> key"), "join-shared")
    parities = written(listed.select("key", "size", "parity").dropDuplicates(["key"]), "join-parities")
    chain = shared.where((F.col("next_key") != F.col("key")) & _bound(least, "size", "next_size", "place", "next_place"))
    chain = written(chain.select(F.least("key", "next_key").alias("a"), F.greatest("key", "next_key").alias("b")).distinct(), "join-chain")
    found = _verified(chain, parities, texts, size, least)
    shared = _merged_lists(shared)
    for turn in range(rounds):
        open_ = _open_lists(shared, found)
        line = Window.partitionBy("shingle").orderBy(F.xxhash64(F.lit(turn), "key"), "key")
        ahead = [F.lead(c).over(line).alias(n) for c, n in zip(_MEMBER, "bnjh", strict=True)]
        pairs = open_.select(*(F.col(c).alias(n) for c, n in zip(_MEMBER, "amig", strict=True)), *ahead)
        pairs = written(pairs.where(_may_link(least)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "join-round")
        new = _verified(pairs, parities, texts, size, least)
        if new.isEmpty():
            break
        found = found.unionByName(new)
    open_ = _open_lists(shared, found).join(parities.select("key", "parity"), "key")
    open_ = written(open_, "join-open-parities")
    named = lambda names: [F.col(c).alias(n) for c, n in zip((*_MEMBER, "parity"), names, strict=True)]
    outside = open_.where("own <> largest").select("shingle", *named("amigx"))
    # both outside: one order is enough
    once = (F.col("h") == F.col("largest")) | (F.col("a") < F.col("b"))
    pairs = outside.join(open_.select("shingle", "largest", *named("bnjhy")), "shingle").where(once & _may_link(least) & alike(least))
    rest = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "join-rest")
    return found if rest.isEmpty() else found.unionByName(_verified(rest, parities, texts, size, least))


def _may_link(least: tuple[int, int]) -> Column:
    """Whether a (size m, place i, group g) and b (n, j, h) may be similar and are not yet in one group."""
    return (F.col("g") != F.col("h")) & _bound(least, "m", "n", "i", "j")


def _merged_lists(shared: DataFrame) -> DataFrame:
    """Lists with the same members as one, each member at its first place: a passage of many shingles is many such lists.

    Lists of two members are left out: these are neighbours, and compared as such.
    """
    members = shared.select("shingle", "key", "size", "place").distinct()
    mark = F.xxhash64(F.expr("bit_xor(xxhash64(key))"), F.expr("bit_xor(xxhash64(key, 1))"), F.count("*"))
    marks = members.groupBy("shingle").agg(mark.alias("mark"), F.count("*").alias("n")).where("n > 2").drop("n")
    rows = members.join(marks, "shingle").groupBy(F.col("mark").alias("shingle"), "key", "size").agg(F.min("place").alias("place"))
    return written(rows, "join-lists")


def _open_lists(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the lists on which several groups are left, with their group ``own`` and the list's ``largest``."""
    groups = written(components(found), "join-components")
    members = shared.join(groups, F.col("key") == F.col("node"), "left")
    members = written(members.select("shingle", "key", "size", "place", F.coalesce("component", "key").alias("own")), "join-members")
    counted = members.groupBy("shingle", "own").agg(F.count("*").alias("n"))
    largest = counted.groupBy("shingle").agg(F.max_by("own", F.struct("n", "own")).alias("largest"), F.count("*").alias("groups"))
    return written(members.join(largest.where("groups > 1").drop("groups"), "shingle"), "join-open")


def grouped(docs: DataFrame, size: int = SHINGLE, least: tuple[int, int] = LEAST, rounds: int = 2) -> DataFrame:
    """``(node, component)`` of the keys (:func:`key_of`) of all texts that have a partner; ``docs`` needs text."""
    small_batches(docs.sparkSession)
    texts = docs.select(key_of(F.col("text")).alias("key"), "text")
    return components(links(prepared(texts, size, least), texts, size, least, rounds))


def joined(docs: DataFrame, size: int = SHINGLE, least: tuple[int, int] = LEAST) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` reachable by links; a row without words is its own.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(key_of(F.col("text")).alias("key"), "text")
    table = prepared(docs.select("doc_id", key_of(F.col("text")).alias("key"), "text"), size, least)
    rows = table.select("doc_id", "key", "size")
    found = written(components(links(table, texts, size, least)), "join-groups")
    first = rows.where("size > 0").groupBy("key").agg(F.min("doc_id").alias("first"))
    named = first.join(found, F.col("key") == F.col("node"), "left")
    named = written(named.select("key", "first", F.coalesce("component", "key").alias("component")), "join-named")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    groups = written(named.join(smallest, "component").select("key", "component_id"), "join-smallest")
    # a row without words meets no key
    meets = F.when(F.col("size") > 0, F.col("key"))
    whole = rows.withColumn("meets", meets).alias("r").join(groups.alias("g"), F.col("meets") == F.col("g.key"), "left")
    return whole.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))

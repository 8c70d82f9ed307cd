"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its distinct words hashed into ``WORD_BUCKETS`` slots with damped
counts, and ``STATISTICS`` about its structure and length, each as the one of ``BINS`` slots it falls into. The score is
a logistic of a linear part and of all pairwise interactions, whose weights are products of ``RANK``-dimensional
vectors. The pairs are never formed: with s = sum v_i x_i, their sum is (s.s - sum |v_i x_i|^2) / 2, linear
in the words of a text.

The model is fitted on at most ``SAMPLE`` labelled documents, taken in hash order of their ids, and
only that sample's sparse vectors reach the driver. Scoring reads the documents once, without a shuffle.

Defined results: null and empty texts get the score of a document without words; labels that repeat
for an id are averaged and rounded; labels without a document and null labels are not used; with no
labels, or one class only, every score is that class's smoothed share (0.5 without any label).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratica.llm.common import SPACES, bounded_sample, remainder, small_batches, spare

WORD_BUCKETS = 1 << 14
BINS = 12
#: What is measured, each scaled to 0..1 before binning.
STATISTICS = (
    "length", "word_length", "longest_word", "symbols", "digits", "capitals", "exclamations", "bars", "distinct_words",
    "distinct_lines", "commonest_word", "adjacent_repeats", "punctuation", "words_per_line",
)
SLOTS = WORD_BUCKETS + BINS * len(STATISTICS)
RANK = 8
SAMPLE = 12_000
EPOCHS = 8
_KINDS = np.zeros(256, dtype=np.int64)
for _kind, _signs in enumerate((b"#*$%&<>", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!", b"|", b".,;:?'\"-"), start=1):
    for _sign in _signs:
        _KINDS[_sign] = _kind


def statistics(text: str, found: list[str], counts: Counter) -> list[float]:
    """The structure statistics of a text, each between 0 and 1."""
    n = max(1, len(found))
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    kinds = np.bincount(_KINDS[raw], minlength=7) / max(1, len(raw))
    lines = [line for line in text.split("\n") if line.strip()]
    repeats = sum(a == b for a, b in zip(found, found[1:], strict=False))
    return [
        np.log1p(len(text)) / 14,
        sum(map(len, found)) / n / 16,
        np.log1p(max(map(len, found), default=0)) / 6,
        kinds[1] * 4,
        kinds[2] * 4,
        kinds[3] * 2,
        kinds[4] * 8,
        kinds[5] * 8,
        len(counts) / n,
        len(set(lines)) / max(1, len(lines)),
        max(counts.values(), default=0) / n,
        repeats / n,
        kinds[6] * 8,
        np.log1p(n / max(1, len(lines))) / 10,
    ]


def encoded(text: str | None, slots: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text; ``slots`` remembers hashes of words and is emptied when it grows large."""
    text = text or ""
    found = [w for w in re.split("[" + SPACES + "]+", text) if w]
    counts = Counter(found)
    if len(slots) > 200_000:
        slots.clear()
    index = []
    for word in counts:
        slot = slots.get(word)
        if slot is None:
            slot = slots[word] = crc32(word.lower().encode("utf-8", "replace")) % WORD_BUCKETS
        index.append(slot)
    value = np.log1p(np.fromiter(counts.values(), dtype=np.float32, count=len(counts)))
    norm = float(np.sqrt((value * value).sum())) or 1.0
    bins = [min(BINS - 1, int(min(x, 1.0) * BINS)) for x in statistics(text, found, counts)]
    marks = [WORD_BUCKETS + BINS * i + b for i, b in enumerate(bins)]
    return (
        np.array(index + marks, dtype=np.int32),
        np.concatenate([value / norm, np.full(len(marks), 1 / np.sqrt(len(marks)), dtype=np.float32)]),
    )


@dataclass
class Machine:
    """Weights of the machine: a constant, one weight and one vector per slot."""

    constant: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log-odds of vectors laid end to end, the first entries of which are at ``starts``."""
        vectors = self.factors[index] * value[:, None]
        sums = np.add.reduceat(vectors, starts)
        pairs = ((sums * sums).sum(axis=1) - np.add.reduceat((vectors * vectors).sum(axis=1), starts)) / 2
        return self.constant + np.add.reduceat(self.linear[index] * value, starts) + pairs


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fitted(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Weights by mini-batch AdaGrad on the logistic loss; the order of steps is fixed by ``seed``."""
    labels = np.array([y for _, _, y in rows], dtype=np.float64)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(SLOTS), np.zeros((SLOTS, RANK)))
    if not 0 < labels.sum() < len(labels):
        return machine
    random = np.random.default_rng(seed)
    machine.factors = random.normal(0, 0.05, (SLOTS, RANK))
    seen = np.full((SLOTS, RANK + 1), 1e-3)
    for _ in range(max(epochs, 40_000 // len(rows))):  # few labels: more rounds
        order = random.permutation(len(rows))
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            sizes = np.array([len(rows[i][0]) for i in batch])
            index = np.concatenate([rows[i][0] for i in batch])
            value = np.concatenate([rows[i][1] for i in batch]).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            error = logistic(machine.margins(index, value, starts)) - labels[batch]
            machine.constant -= 0.02 * error.mean()
            spread = np.repeat(error, sizes) * value
            vectors = machine.factors[index]
            sums = np.add.reduceat(vectors * value[:, None], starts)
            steps = np.column_stack([spread, spread[:, None] * (np.repeat(sums, sizes, axis=0) - vectors * value[:, None])])
            own, place = np.unique(index, return_inverse=True)
            total = np.column_stack([np.bincount(place, steps[:, j], minlength=len(own)) for j in range(RANK + 1)])
            total[:, 0] += 1e-3 * machine.linear[own]
            total[:, 1:] += 1e-3 * machine.factors[own]
            seen[own] += total * total
            rate = 0.1 / np.sqrt(seen[own])
            machine.linear[own] -= rate[:, 0] * total[:, 0]
            machine.factors[own] -= rate[:, 1:] * total[:, 1:]
    return machine


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    slots: dict[str, int] = {}
    for batch in batches:
        pairs = [encoded(text, slots) for text in batch["text"]]
        yield pd.DataFrame(
            {
                "doc_id": batch["doc_id"],
                "label": batch["label"],
                "index": [i.tobytes() for i, _ in pairs],
                "value": [v.tobytes() for _, v in pairs],
            }
        )


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """The machine for ``labels(doc_id, label)``; which labels may be used is the caller's choice."""
    small_batches(docs.sparkSession)
    usable = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id")
    usable = bounded_sample(usable.agg(F.round(F.avg("label")).cast("int").alias("label")), ["doc_id"], sample)
    # at most ``sample`` small rows, so they may be broadcast; texts that repeat for an id count once each
    rows = docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id")
    schema = "doc_id bigint, label int, index binary, value binary"
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInPandas(_vectors, schema)
    rows = rows.orderBy("doc_id", "index", "value").limit(2 * sample).collect()
    return fitted([(np.frombuffer(r["index"], np.int32), np.frombuffer(r["value"], np.float32), r["label"]) for r in rows])


def scored(docs: DataFrame, machine: Machine, score: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in a new column."""
    if spare(docs, score) != score:
        raise ValueError(f"the documents already have a column {score}")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((machine.constant, machine.linear, machine.factors))

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        slots: dict[str, int] = {}
        weights = Machine(*shared.value)
        for batch in batches:
            if not len(batch):
                yield pd.Series([], dtype="float64")
                continue
            pairs = [encoded(text, slots) for text in batch]
            starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in pairs])[:-1]]).astype(np.int64)
            index, value = (np.concatenate([p[j] for p in pairs]) for j in (0, 1))
            yield pd.Series(logistic(weights.margins(index, value, starts)))

    return docs.withColumn(score, probability("text"))


def quality(docs: DataFrame, labels: DataFrame, score: str = "score", folds: int = 5, held_out: int = 0) -> DataFrame:
    """Documents scored by a machine learnt from the labelled rows outside the held-out fold."""
    train = labels.where(remainder(F.col("doc_id"), folds) != held_out)
    return scored(docs, learned(docs, train.select("doc_id", F.col("quality").alias("label"))), score)

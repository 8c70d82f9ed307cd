"""Embedding texts on the executors with a pluggable model.

A model is any picklable callable ``(list of texts, task) -> array of shape (n, dims)`` with a
``dims`` attribute; one that needs a client can open it on first use inside the task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Vector length, texts per call, and the two uses of a text.
DIMS = 768
BATCH = 100
DOCUMENT, QUERY = "document", "query"


class HashingModel:
    """Offline default: counts of lower-cased, white-space separated words hashed into ``dims`` cells,
    scaled to unit length. Documents and queries are treated alike."""

    def __init__(self, dims: int = DIMS):
        self.dims = dims
        self._cells: dict[str, int] = {}

    def __getstate__(self):
        return {"dims": self.dims, "_cells": {}}

    def _cell(self, word: str) -> int:
        cell = self._cells.get(word)
        if cell is None:
            if len(self._cells) >= 100_000:
                self._cells.clear()
            cell = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dims
            self._cells[word] = cell
        return cell

    def __call__(self, texts: list[str], task: str) -> np.ndarray:
        out = np.zeros((len(texts), self.dims))
        for row, text in enumerate(texts):
            words = [w for w in re.split(r"[ \t\n\f\r]+", text.lower()) if w]
            if words:
                out[row] = np.bincount([self._cell(w) for w in words], minlength=self.dims)
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=out, where=norms > 0)


def _vectors(parts: Iterator[pd.Series], model, task: str, batch: int) -> Iterator[pd.Series]:
    """The vectors of one call at a time: a task holds no more, however many texts Spark hands over at once."""
    for part in parts:
        for i in range(0, len(part), batch):
            found = model(part.iloc[i : i + batch].fillna("").tolist(), task)
            yield pd.Series(list(found.astype(np.float32)))


def embed(
    df: DataFrame,
    text: str,
    model=None,
    task: str = DOCUMENT,
    batch: int = BATCH,
    into: str = "embedding",
    partitions: int | None = None,
) -> DataFrame:
    """Add the vector of a text column; a missing text is embedded as an empty one.

    ``partitions`` deals the texts out first, for an input that comes in fewer pieces than there are cores.
    """
    model = model or HashingModel()

    @F.pandas_udf("array<float>")
    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return _vectors(parts, model, task, batch)

    dealt = df if partitions is None else df.repartition(partitions)
    return dealt.withColumn(into, vectors(F.col(text)))

"""Token counts by dynamic programming over prefixes.

For a byte-pair vocabulary, the encoding of a prefix ends in exactly one token t such that t may follow the
last token of the prefix before it, that is, such that encoding the two tokens' text gives back the two tokens. So
from left to right, each prefix's last token and count follow from shorter prefixes: count[i] =
count[i - len(t)] + 1. The table holds the exact number of tokens of every prefix; how long a text may
grow within a budget, or what a cut costs, is a look-up and needs no encoding.

The vocabulary here marks a word's start with U+2581 and no piece has that mark after another character, nor
any piece a character that is unknown by itself. So a text falls into pieces that are encoded
independently: marks with the word after them. Their tables are computed once per task and word.

Defined results: null and empty texts have no tokens; an unknown character counts one token for each of its
UTF-8 bytes; repeated rows give a row each; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratica.llm.common import small_batches

MARK = "\u2581"
LIMIT = 4096
_REMEMBERED = 400_000
_PART = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class PrefixTables:
    """Exact token counts of prefixes under one SentencePiece BPE model."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.pieces = list(scores)
        self.pairs: dict[int, bool] = {}
        self.tables: dict[str, tuple[int, ...]] = {}
        self.totals: dict[str, int] = {}
        self.tree: dict = {}
        for number, piece in enumerate(self.pieces):
            node = self.tree
            for character in piece:
                node = node.setdefault(character, {})
            node[""] = ~number  # a piece ends here; negative until merging is known to reach it

    @classmethod
    def load(cls, model: bytes) -> PrefixTables:
        return cls(cls.vocabulary(model))

    @staticmethod
    def vocabulary(model: bytes) -> dict[str, float]:
        """The scores of the model's usual pieces."""
        import sentencepiece

        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        usual = (
            i for i in range(reader.get_piece_size())
            if not (reader.is_control(i) or reader.is_unknown(i) or reader.is_byte(i) or reader.is_unused(i))
        )
        return {reader.id_to_piece(i): reader.get_score(i) for i in usual}

    def merged(self, text: str) -> list[str]:
        """The text's tokens by merging the best-scored neighbours, the leftmost of equals, again and again."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def reached(self, node: dict) -> int:
        """The number of the piece ending at a node; pieces that merging never makes leave the tree."""
        number = ~node[""]
        if self.merged(self.pieces[number]) == [self.pieces[number]]:
            node[""] = number
            return number
        del node[""]
        return -1

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` can be the token after ``left``."""
        if len(self.pairs) > _REMEMBERED:
            self.pairs.clear()
        known = self.merged(self.pieces[left] + self.pieces[right]) == [self.pieces[left], self.pieces[right]]
        self.pairs[left << 20 | right] = known
        return known

    def table(self, part: str) -> tuple[int, ...]:
        """Token counts of the part's prefixes of 0, 1, ... characters."""
        n, tree, pairs = len(part), self.tree, self.pairs
        counts, last = [0] + [-1] * n, [-1] * (n + 1)
        for start in range(n + 1):
            if counts[start] < 0:  # no token ends here: an unknown character, which counts as its bytes
                counts[start] = counts[start - 1] + len(part[start - 1].encode("utf-8", "replace"))
            next_count, before, node = counts[start] + 1, last[start], tree
            for end in range(start + 1, n + 1):
                node = node.get(part[end - 1])
                if node is None:
                    break
                token = node.get("")
                if token is None or counts[end] >= 0:
                    continue
                if token < 0 and (token := self.reached(node)) < 0:
                    continue
                if before < 0 or (known := pairs.get(before << 20 | token)) or known is None and self.follows(before, token):
                    counts[end], last[end] = next_count, token
        return tuple(counts)

    def counts(self, part: str) -> tuple[int, ...]:
        known = self.tables.get(part)
        if known is None:
            known = self.table(part)
            if len(part) <= 64:
                if len(self.tables) > _REMEMBERED // 8:
                    self.tables.clear()
                self.tables[part] = known
        return known

    def total(self, part: str) -> int:
        known = self.totals.get(part)
        if known is None:
            known = self.table(part)[-1]
            if len(part) <= 64:
                if len(self.totals) > _REMEMBERED:
                    self.totals.clear()
                self.totals[part] = known
        return known

    def parts(self, text: str) -> list[str]:
        return _PART.findall(MARK + text.replace(" ", MARK)) if text else []

    def ends(self, text: str) -> list[tuple[int, int, int]]:
        """The stored table in short form: (first character, characters, tokens so far) after each part."""
        at, so_far, out = 0, 0, []
        for part in self.parts(text):
            so_far += self.total(part)
            out.append((at, len(part), so_far))
            at += len(part)
        return out

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of the prefixes of 0, 1, ... characters of a text."""
        out, so_far = [0], 0
        for part in self.parts(text):
            own = self.counts(part)
            out += [so_far + c for c in own[1:]]
            so_far += own[-1]
        # the leading mark is no character of the text
        return [0, *out[2:]] if text else [0]

    def size(self, text: str | None) -> int:
        return sum(map(self.total, self.parts(text))) if text else 0

    def measured(self, text: str | None, budget: int) -> tuple[int, int]:
        """Tokens of a text, and the characters of its longest prefix within the budget."""
        if not text:
            return 0, 0
        so_far = at = 0
        fit = None
        for part in self.parts(text):
            own = self.total(part)
            if fit is None and so_far + own > budget:
                # counts before this part are within the budget, those after it are not
                fit = at + max(i for i, c in enumerate(self.counts(part)) if so_far + c <= budget)
            so_far += own
            at += len(part)
        return so_far, max(0, (at if fit is None else fit) - 1)


def counted(docs: DataFrame, model_path: str, budget: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, fit_chars (the longest prefix within the budget) and over_limit.

    The model file is read on the driver and travels with the job.
    """
    small_batches(docs.sparkSession)
    with open(model_path, "rb") as file:
        scores = PrefixTables.vocabulary(file.read())
    # a broadcast value lives as long as a Python worker: its tables serve all tasks of the worker
    shared = docs.sparkSession.sparkContext.broadcast({"scores": scores})

    @F.pandas_udf("n_tokens long, fit_chars long")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        state = shared.value
        if "tables" not in state:
            state["tables"] = PrefixTables(state["scores"])
        for batch in batches:
            rows = [state["tables"].measured(text, budget) for text in batch]
            yield pd.DataFrame(rows, columns=["n_tokens", "fit_chars"], dtype="int64")

    found = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), measure("text").alias("m"))
    return found.select("doc_id", "n_bytes", "m.n_tokens", "m.fit_chars", (F.col("m.n_tokens") > budget).alias("over_limit"))

"""Secret scan over a trigram inverted index.

Each rule is a regular expression. From its syntax tree follows a Boolean query over lower-cased trigrams that
any match must satisfy: a literal run gives the AND of its trigrams, alternatives give an OR, repeats and classes
give nothing. The documents of a batch are indexed by the trigrams the rules ask for, posting lists are
intersected and united as the query says, and only candidates are verified with the expression itself. A
rule without mandatory trigrams scans every text.

The index is partitioned with the documents: a batch's postings are built where its texts are read, so nothing
is shuffled and no posting list outgrows a batch.

Defined results: null and empty texts hold no secret; spans are in code points, end exclusive; repeated
rows give a row each; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parse

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from stratica.llm.common import small_batches

#: A private key: from its BEGIN line to the END line that follows, or, where that is missing, over the lines of base64
#: (and of PEM headers) below it. Line ends may be escaped or lost; a shorter run than 16 ends its line.
_GAP = r"""[\x20\t"'>,;+]*+"""
_LINE = rf"""{_GAP}(?:(?:\r?\n|(?:\\r)?\\n){_GAP})?+"""
_END = rf"(?={_GAP}(?:\r?\n|\\[rn]|\Z))"
_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    r"(?:[^-]*+(?:-(?!----(?:BEGIN|END)\x20)[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----"
    r"""|(?:(?:[\x20\t"'>,;+\r\n]|\\[rn])*+"""
    rf"(?:[A-Za-z0-9+/=]{{16,}}+|(?=[A-Za-z]*+[0-9+/=])[A-Za-z0-9+/=]++{_END})"
    rf"|{_LINE}[A-Za-z0-9+/=]++{_END}"
    rf"|{_LINE}(?:Proc-Type|DEK-Info):[^\n\\]*+(?:(?:\r?\n|\\n)(?=\r?\n|\\n))?)*+)"
)
#: The three base kinds in their order, then the further ones. ``least`` is the fewest
#: characters of a match, or of its group where one is named; shorter matches are dropped.
RULES = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("private_key", _KEY, 0, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("login_url", r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@", 0, 0),
)
# ``[0-9a-f]{24,}`` has the matches of ``[0-9a-f]+`` with 24 characters or more: a run is matched from its start.
BASE = ("assign", "access", "hex")
_SPANS = ArrayType(StructType().add("kind", StringType()).add("start", LongType()).add("end", LongType()))
#: A query is ("and" | "or", parts); a part is a trigram or a query. An empty AND is always true.
Query = tuple[str, tuple]
ALWAYS: Query = ("and", ())


def _trigrams(literal: str) -> Query:
    return ("and", tuple(dict.fromkeys(literal[i : i + 3] for i in range(len(literal) - 2))))


def _all_of(parts: list[Query]) -> Query:
    kept = [p for p in parts if p != ALWAYS]
    return kept[0] if len(kept) == 1 else ("and", tuple(kept))


def _any_of(parts: list[Query]) -> Query:
    return ALWAYS if ALWAYS in parts else ("or", tuple(dict.fromkeys(parts)))


def _literals(tree) -> list[str] | None:
    """The strings an expression can be, lower-cased, where they are few and short; else None."""
    found = [""]
    for kind, value in tree:
        if kind is sre.LITERAL:
            own = [chr(value).lower()]
        elif kind is sre.SUBPATTERN:
            own = _literals(value[3])
        elif kind is sre.BRANCH:
            own = [_literals(branch) for branch in value[1]]
            own = None if None in own else [x for branch in own for x in branch]
        elif kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
            own = sorted({chr(v).lower() for _, v in value})
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[1] <= 4 and value[1] is not sre.MAXREPEAT:
            once = _literals(value[2])
            own = None
            if once is not None:
                own, power = [], [""]
                for times in range(value[1] + 1):
                    own += power if times >= value[0] else []
                    power = [a + b for a in power for b in once][:65]
        else:
            own = None
        if own is None or len(found) * len(own) > 64:
            return None
        found = [a + b for a in found for b in own]
    return found


def trigram_query(pattern: str) -> Query:
    """A Boolean query over trigrams of the lower-cased text that holds wherever ``pattern`` matches."""
    return _query(sre_parse.parse(pattern))


def _query(tree) -> Query:
    parts: list[Query] = []
    run: list = []

    def close() -> None:
        exact = _literals(run)
        if exact is not None:
            parts.append(_any_of([_trigrams(x) if len(x) > 2 else ALWAYS for x in exact]))
        run.clear()

    for item in tree:
        kind, value = item
        if _literals([*run, item]) is not None:
            run.append(item)
            continue
        close()
        if _literals([item]) is not None:
            run.append(item)
        elif kind is sre.SUBPATTERN:
            parts.append(_query(value[3]))
        elif kind is sre.BRANCH:
            parts.append(_any_of([_query(branch) for branch in value[1]]))
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
            parts.append(_query(value[2]))
    close()
    return _all_of(parts)


def grams_of(query: Query) -> set[str]:
    return {g for part in query[1] for g in ([part] if isinstance(part, str) else grams_of(part))}


class Index:
    """Posting lists of a batch: for each trigram in question, which texts have it."""

    def __init__(self, texts: list[str], grams: list[str]):
        self.everything = np.ones(len(texts), dtype=bool)
        lowered = [t.lower() for t in texts]
        self.postings = {g: np.fromiter((g in t for t in lowered), dtype=bool, count=len(lowered)) for g in grams}

    def candidates(self, query: Query) -> np.ndarray:
        kind, parts = query
        if not parts:
            return self.everything
        lists = [self.postings[p] if isinstance(p, str) else self.candidates(p) for p in parts]
        return np.logical_and.reduce(lists) if kind == "and" else np.logical_or.reduce(lists)


@dataclass
class Rule:
    kind: str
    pattern: re.Pattern
    group: int
    least: int
    query: Query

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost, non-overlapping matches; those too short are dropped after they were matched."""
        return [m.span() for m in self.pattern.finditer(text) if len(m[self.group]) >= self.least]


def compiled(rules=RULES) -> list[Rule]:
    return [Rule(kind, re.compile(p, re.ASCII), group, least, trigram_query(p)) for kind, p, group, least in rules]


def found_in(texts: list[str], rules: list[Rule]) -> list[list[tuple[int, int, int]]]:
    """For each text its spans as (start, rule number, end), in order."""
    index = Index(texts, sorted({g for r in rules for g in grams_of(r.query)}))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, rule in enumerate(rules):
        for i in np.flatnonzero(index.candidates(rule.query)):
            found[i] += [(start, number, end) for start, end in rule.spans(texts[i])]
    return [sorted(spans) for spans in found]


@F.pandas_udf(_SPANS)
def _secrets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    rules = compiled()
    for batch in batches:
        texts = [t or "" for t in batch]
        yield pd.Series(
            [
                [{"kind": rules[k].kind, "start": start, "end": end} for start, k, end in spans]
                for spans in found_in(texts, rules)
            ],
            dtype=object,
        )


def secrets(text: Column) -> Column:
    """All secrets of a text as an array of kind, start and end, ordered by start and then rule."""
    return _secrets(text)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, secrets, and their digest: counts of the base kinds and the spans as text."""
    small_batches(docs.sparkSession)
    shown = lambda s: F.array_join(
        F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    base = F.filter("secrets", lambda x: x["kind"].isin(*BASE))

    def number(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return docs.select("doc_id", secrets(F.col("text")).alias("secrets")).select(
        "doc_id",
        "secrets",
        *map(number, BASE),
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("secrets")).alias("spans"),
    )


def masked_text(text: str, spans: list[tuple[int, int, int]], rules: list[Rule]) -> str:
    """The text with every span, overlapping ones merged, replaced by the kind of its first rule."""
    parts, at = [], 0
    for start, number, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{rules[number].kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


@F.pandas_udf(StringType())
def _masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    rules = compiled()
    for batch in batches:
        found = found_in([t or "" for t in batch], rules)
        yield pd.Series([t and masked_text(t, s, rules) for t, s in zip(batch, found, strict=True)], dtype=object)


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with its secrets replaced by their kinds; ``n_chars``, where there is one, follows the text."""
    small_batches(docs.sparkSession)
    out = docs.withColumn("text", _masked("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out

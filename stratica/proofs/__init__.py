"""Runnable proofs: each registered query exercises operators on whole tables.

A query sits next to the SQL that states its result independently; ``registry`` collects both.
"""

from stratica.proofs import (  # noqa: F401  (importing registers)
    answers,
    cleaning,
    increments,
    layers,
    quality,
    questions,
    raw,
    relational,
    streams,
    vectors,
)
from stratica.proofs.registry import ORACLES, QUERIES  # noqa: F401

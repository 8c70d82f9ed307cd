"""Quality rules judged per document and per host.

Each document is held to rules about length, repetition, symbols and repeated lines. A host's failure rate is
shrunk towards the rate of all hosts by a beta prior whose two parameters come from the hosts
themselves (method of moments), so a host with few documents is not judged by them alone. The
verdicts go back to the documents: a host that fails as a whole takes its documents with it, and a
document that breaks a minor rule is dropped where its host is suspect.

A document's figures depend on its own words only and are computed in its row; the one thing shuffled
is a row of counts per document and the counts per host, summed before they move.

Defined results: null and blank texts have no words and fail; a null host is a host of its own; repeated rows
are judged each; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratica.llm.common import let, words, written

LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
SPAN = 8
#: Minor rules: more than this many symbols, or repeated lines, per hundred words or lines.
MOST_SYMBOLS_PERCENT = 25
MOST_DUP_LINES_PERCENT = 30
#: Shrunk failure rates above which a host is suspect, and above which it fails.
SUSPECT, FAILED = 0.25, 0.6
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(found: Column, span: int = SPAN) -> Column:
    """Words inside a window of ``span`` words that occurs twice or more in the text."""

    def covered(marks: Column) -> Column:
        # window starts in order; each covers what the next one does not
        reach = F.zip_with(
            marks, F.slice(marks, 2, F.size(marks)), lambda a, b: F.least(F.lit(span), F.coalesce(b - a, F.lit(span)))
        )
        return F.aggregate(reach, F.lit(0), lambda total, x: total + x)

    def starts(ordered: Column) -> Column:
        # equal windows stand next to each other after sorting by hash
        before = F.concat(F.array(F.lit(None).cast(_PAIR)), ordered)
        after = F.concat(F.slice(ordered, 2, F.size(ordered)), F.array(F.lit(None).cast(_PAIR)))
        same = F.zip_with(
            ordered,
            F.zip_with(F.slice(before, 1, F.size(ordered)), after, lambda b, a: F.struct(b["h"].alias("b"), a["h"].alias("a"))),
            lambda x, y: F.when((x["h"] == y["b"]) | (x["h"] == y["a"]), x["i"]),
        )
        return F.array_sort(F.filter(same, lambda i: i.isNotNull()))

    def count(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, let(let(pairs, starts), covered)).otherwise(0)

    at = F.sequence(F.lit(1), F.size(found) - (span - 1))
    hashes = F.transform(at, lambda i: F.xxhash64(F.slice(found, i, span)))
    return F.when(F.size(found) > span, let(hashes, count)).otherwise(0).cast("long")


_PAIR = "struct<h:bigint,i:int>"


def _measured(found: Column, text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        F.size(found).cast("long").alias("n_words"),
        F.length(F.array_join(found, "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), F.lit(0)).cast("long").alias("n_symbols"),
        let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
        let(lines, F.size).cast("long").alias("n_lines"),
        repeated_words(found).alias("n_repeat_words"),
    )


def figures(docs: DataFrame, host: str = "source", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, ``host``, the figures and which rules each document breaks."""
    measured = let(words(F.col("text")), lambda found: _measured(found, F.col("text")))
    rows = docs.select(*keep, F.col(host).alias("host"), measured.alias("m")).select(*keep, "host", "m.*")
    base = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    minor = (100 * F.col("n_symbols") > MOST_SYMBOLS_PERCENT * F.col("n_words")) | (
        100 * F.col("n_dup_lines") > MOST_DUP_LINES_PERCENT * F.col("n_lines")
    )
    return rows.withColumn("base_failed", base).withColumn("minor_failed", minor)


def shrunk_rates(judged: DataFrame) -> DataFrame:
    """Per host: documents, failures, and the failure rate under the empirical beta prior.

    The prior's mean is the failure rate of all documents; its strength is what makes the variance
    of the hosts' rates, less the part that chance explains, its own. Four sums reach the driver.
    """
    failed = (F.col("base_failed") | F.col("minor_failed")).cast("long")
    hosts = written(judged.groupBy("host").agg(F.count("*").alias("docs"), F.sum(failed).alias("failures")), "rule-hosts")
    n, failures, squares, n_hosts = hosts.agg(
        F.sum("docs"), F.sum("failures"), F.sum(F.col("docs") * F.col("docs")), F.count("*")
    ).first()
    if not n:
        return hosts.withColumn("rate", F.lit(0.0))
    mean = failures / n
    spread = hosts.agg(F.sum(F.col("docs") * F.pow(F.col("failures") / F.col("docs") - F.lit(mean), 2))).first()[0]
    chance = mean * (1 - mean)
    # between-host variance of a weighted one-way layout
    weight = n - squares / n
    between = (spread - (n_hosts - 1) * chance) / weight if weight > 0 else 0.0
    strength = chance / between - 1 if between > 0 else float(n)
    strength = min(max(strength, 1.0), float(n))
    rate = (F.col("failures") + F.lit(mean * strength)) / (F.col("docs") + F.lit(strength))
    return hosts.withColumn("rate", rate)


def verdicts(docs: DataFrame, host: str = "source", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every document row's figures, base verdict and final verdict."""
    judged = written(figures(docs, host, keep), "rule-figures")
    rates = written(shrunk_rates(judged), "rule-rates")
    joined = judged.alias("d").join(rates.alias("h"), F.col("d.host").eqNullSafe(F.col("h.host")))
    kept = ~F.col("base_failed") & (F.col("rate") <= FAILED) & ~(F.col("minor_failed") & (F.col("rate") > SUSPECT))
    return joined.select("d.*", F.col("rate").alias("host_rate"), kept.alias("kept"))

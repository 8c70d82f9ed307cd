"""Toxicity: gradient-boosted trees over a few dense features, calibrated by isotonic regression.

The features are densities of a graded lexicon, how close its words stand to a second person, and rates of capitals,
punctuation and obfuscation. The lexicon is learnt: word stems (the first four or five letters, and whole words) that mark
toxic documents among the labelled ones. So that the trees don't trust stems that were chosen on their own rows, a training
row's features use stems learnt from the other folds.

At most ``SAMPLE`` labelled documents, in hash order of their ids, are learnt from; of their stems the ``STEMS`` most telling
ones become the lexicon. Both are parameters. Scoring reads the documents once, without a shuffle.

Defined results: null and empty texts get the score of a text without words; labels that repeat for an id
are averaged and rounded; null labels and labels without a document are not used; where the labels lack a
class, the score is the smoothed share of toxic ones (0.5 without any label).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from stratica.llm.common import bounded_sample, remainder, small_batches, spare, written

SAMPLE = 8_000
STEMS = 3_000
FOLDS = 3
TREES, DEPTH = 20, 3
#: A stem is kept from this many toxic documents and this weight on; the weights of the medium and strong grades.
LEAST_DOCS, LEAST_ODDS = 2, 1.5
MEDIUM, STRONG = 2.2, 3.2
#: A stem seen in n toxic documents keeps n / (n + DOUBT) of its log-odds.
DOUBT = 2
#: Second-person words of the languages at hand; characters that stand in for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch sie tú usted ustedes tus vosotros".split()
)
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_EDGE = ".,;:!?\"'()[]{}|#*%&$<>-_"
_INNER = re.compile(r"[^\W\d_][^\w\s]+[^\W\d_]|[^\W\d_]\d+[^\W\d_]")
FEATURES = (
    "strong", "medium", "weak", "odds", "top", "distinct", "hits", "near_you", "you", "capitals", "exclamations",
    "punctuation", "obfuscated", "decoded", "length",
)


def stems(word: str) -> list[str]:
    """What of a lower-cased word can be in the lexicon: the word, and its first five and four letters."""
    return [word + "$", *(word[:n] for n in (5, 4) if len(word) >= n)]


def plain_words(text: str) -> list[str]:
    return [w for raw in text.split() if (w := raw.strip(_EDGE).lower())]


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The dense features of a text, in the order of ``FEATURES``."""
    text = text or ""
    raw = text.split()
    found = [w.strip(_EDGE).lower() for w in raw]
    n = max(1, sum(map(bool, found)))
    odds = [0.0] * len(found)
    you = []
    obfuscated = decoded = 0
    for i, word in enumerate(found):
        if not word:
            continue
        if word in SECOND_PERSON:
            you.append(i)
        value = max([lexicon.get(s, 0.0) for s in (word + "$", word[:5], word[:4])])
        if not word.isalpha() and _INNER.search(word):
            obfuscated += 1
            letters = re.sub(r"[\W\d_]", "", word.translate(STAND_INS))
            other = max([lexicon.get(s, 0.0) for s in stems(letters)], default=0.0) if letters else 0.0
            if other > value:
                decoded, value = decoded + 1, other
        odds[i] = value
    values = np.array(odds or [0.0])
    hit = np.flatnonzero(values >= LEAST_ODDS)
    near = 0
    if len(you) and len(hit):
        place = np.searchsorted(you, hit)
        left = np.abs(hit - np.array(you)[np.maximum(place - 1, 0)])
        right = np.abs(np.array(you)[np.minimum(place, len(you) - 1)] - hit)
        near = int((np.minimum(left, right) <= 5).sum())
    size = max(1, len(text))
    return [
        float((values >= STRONG).sum()) / n,
        float(((values >= MEDIUM) & (values < STRONG)).sum()) / n,
        float(((values >= LEAST_ODDS) & (values < MEDIUM)).sum()) / n,
        float(values.sum()) / n,
        float(values.max()),
        math.log1p(len({found[i] for i in hit if values[i] >= STRONG})),
        math.log1p(float((values >= STRONG).sum())),
        near / n,
        len(you) / n,
        sum(w.isupper() for w in raw) / n,
        text.count("!") / size,
        sum(text.count(c) for c in ".,;:?") / size,
        obfuscated / n,
        decoded / n,
        math.log1p(n),
    ]


@F.pandas_udf(ArrayType(StringType()))
def _document_stems(text: pd.Series) -> pd.Series:
    return text.map(lambda t: sorted({s for w in set(plain_words(t or "")) for s in stems(w)}))


def lexicons(rows: DataFrame) -> list[dict[str, float]]:
    """Weights of stems (their log-odds, less where they rest on few documents): for each fold from the rows of the other folds, and last from all rows.

    ``rows`` has text, label and fold; at most ``STEMS`` stems reach the driver.
    """
    sums = [
        F.count(F.when((F.col("fold") == fold) & (F.col("label") == label), 1)).alias(f"f{fold}_{label}")
        for fold in range(FOLDS)
        for label in (0, 1)
    ]
    totals = rows.agg(*sums).first()
    counted = rows.select("label", "fold", F.explode(_document_stems("text")).alias("stem")).groupBy("stem").agg(*sums)

    def odds(counts, without: int | None):
        """Smoothed log-odds of a stem in toxic against other documents, and its toxic documents."""
        folds = [f for f in range(FOLDS) if f != without]
        toxic, other = (sum(counts[f"f{f}_{label}"] for f in folds) for label in (1, 0))
        all_toxic, all_other = (sum(totals[f"f{f}_{label}"] for f in folds) for label in (1, 0))
        return toxic, (toxic + 0.1) / (all_toxic + 1.0) * (all_other + 1.0), other + 0.5

    toxic, share, rest = odds({c: F.col(c) for c in counted.columns if c != "stem"}, None)
    told = counted.withColumn("weight", F.log(share / rest) * toxic / (toxic + DOUBT))
    kept = told.where((toxic >= LEAST_DOCS) & (F.col("weight") >= LEAST_ODDS / 2))
    kept = kept.orderBy(F.col("weight").desc(), "stem").limit(STEMS).collect()
    out = []
    for without in [*range(FOLDS), None]:
        lexicon = {}
        for row in kept:
            toxic, share, rest = odds(row, without)
            value = math.log(share / rest) * toxic / (toxic + DOUBT)
            if toxic >= LEAST_DOCS and value >= LEAST_ODDS:
                lexicon[row["stem"]] = value
        out.append(lexicon)
    return out


def _vector(spark, lexicon: list[dict[str, float]]):
    """A function of text and fold giving the features under that fold's lexicon."""
    shared = spark.sparkContext.broadcast(lexicon)

    @F.pandas_udf(ArrayType(DoubleType()))
    def measured(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, folds in batches:
            yield pd.Series([features(t, shared.value[f]) for t, f in zip(texts, folds, strict=True)], dtype=object)

    return lambda text, fold: array_to_vector(measured(text, fold))


def scored(docs: DataFrame, labels: DataFrame, score: str = "score", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with the calibrated probability that a text is toxic.

    ``labels(doc_id, label)`` are the rows to learn from. Three quarters of the sample grow the
    trees. The rest calibrate them, along with the trees' own rows at a quarter of the weight.
    """
    if spare(docs, score) != score:
        raise ValueError(f"the documents already have a column {score}")
    spark = docs.sparkSession
    small_batches(spark)
    usable = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id")
    usable = bounded_sample(usable.agg(F.round(F.avg("label")).cast("int").alias("label")), ["doc_id"], sample)
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)).alias("part")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    rows = docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id").select("doc_id", "text", "label", fold, part)
    rows = written(rows, "toxic-sample")
    n, toxic, grown, toxic_grown = rows.agg(
        F.count("*"),
        F.coalesce(F.sum("label"), F.lit(0)),
        F.count(F.when(F.col("part") > 0, 1)),
        F.count(F.when((F.col("part") > 0) & (F.col("label") == 1), 1)),
    ).first()
    if not 0 < toxic < n or not 0 < toxic_grown < grown:
        return docs.withColumn(score, F.lit((toxic + 0.5) / (n + 1)))
    vector = _vector(spark, lexicons(rows))
    train = rows.select("doc_id", F.col("label").cast("double").alias("label"), "part", vector(F.col("text"), F.col("fold")).alias("features"))
    train = written(train.repartition(4, "doc_id"), "toxic-train")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=2, seed=11)
    model = trees.fit(train.where("part > 0").sortWithinPartitions("doc_id"))
    chance = lambda c: vector_to_array(F.col(c))[1]
    held = model.transform(train).withColumn("weight", F.when(F.col("part") == 0, 1.0).otherwise(0.25))
    held = held.select("label", "weight", chance("probability").alias("chance"))
    steps = IsotonicRegression(featuresCol="chance", labelCol="label", weightCol="weight").fit(written(held, "toxic-chances"))
    names = {c: spare(docs, f"toxic_{c}") for c in ("features", "raw", "probability", "class", "chance")}
    model.setFeaturesCol(names["features"]).setRawPredictionCol(names["raw"])
    model.setProbabilityCol(names["probability"]).setPredictionCol(names["class"])
    steps.setFeaturesCol(names["chance"]).setPredictionCol(score)
    out = model.transform(docs.withColumn(names["features"], vector(F.col("text"), F.lit(FOLDS))))
    return steps.transform(out.withColumn(names["chance"], chance(names["probability"]))).drop(*names.values())


def toxicity(docs: DataFrame, labels: DataFrame, score: str = "score", folds: int = 3, held_out: int = 1) -> DataFrame:
    """Documents scored by what is learnt from the labelled rows outside the held-out fold."""
    train = labels.where(remainder(F.col("doc_id"), folds) != held_out)
    return scored(docs, train.select("doc_id", F.col("toxic").alias("label")), score)

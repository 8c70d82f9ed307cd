"""Entity-to-fact joins, in batch and on streams, and the anti and semi joins around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratica.operators.dedup import STREAM_SALTS, salt_of
from stratica.sources.contracts import STAMP, STAMP_DATE

WATERMARK = "24 hours"
_SALT, _ENTITY_TS, _FACT_TS = "_salt", "_entity_ts", "_fact_ts"


def entity_join(
    entities: DataFrame,
    facts: DataFrame,
    key: str,
    *,
    stamp: str = STAMP,
    watermark: str = WATERMARK,
    within: str | None = None,
    how: str = "inner",
    salts: int | None = None,
    hot: DataFrame | None = None,
    spread_by: list[str] | None = None,
    once: list[str] | None = None,
) -> DataFrame:
    """Join facts to their entity and resolve the columns both sides carry.

    The key comes from the entity, the stamp is the later of both and its date is derived from it.
    Duplicate keys multiply, facts without an entity are dropped (see ``unmatched``).

    Either side may be a stream; streaming sides get the watermark. ``within`` bounds the distance
    of the two stamps, which is what lets stream state expire: with a watermark alone an equality
    join keeps every row. Entities that arrive long before their facts belong in a batch frame
    (a stream-static join) instead.

    Skew: a batch join is left to AQE, which splits an oversized partition at run time. Streams
    have no AQE, so where both sides are streams facts are salted and each entity row is repeated
    once per salt; pass ``salts`` for a stream against entities at rest whose keys are hot. Outer joins
    take no salts. The salt mixes a hash of ``spread_by`` (all fact columns by default) with the input partition, so that
    copies of one row spread as well; a retried task repeats its salts.

    ``hot`` is a table at rest of the keys known to be hot with a number of salts each
    (:func:`stratica.operators.profile.hot_keys`; at most one row per share): only these are spread, and an entity that
    is not among them is kept once.

    ``once`` names columns of the fact that identify it: facts that arrive again after the join
    are dropped by a second stateful step under the same watermark. It takes a time bound, and one row per entity.
    """
    if how != "inner" and within is None and (entities.isStreaming and facts.isStreaming):
        raise ValueError("an outer stream-stream join never emits unmatched rows without a time bound")
    if how != "inner" and (salts or 1) > 1:
        raise ValueError("salts repeat the entities, which an outer join would show")
    streaming = entities.isStreaming or facts.isStreaming
    if hot is not None:
        if how != "inner" or salts is not None:
            raise ValueError("hot keys take the place of salts, in inner joins")
        salts = 1
    if once and streaming and within is None:
        raise ValueError("rows can be told from earlier ones for a bounded time only")
    if salts is None:
        salts = STREAM_SALTS if entities.isStreaming and facts.isStreaming and how == "inner" else 1

    left = entities.withColumnRenamed(stamp, _ENTITY_TS)
    right = facts.withColumnRenamed(stamp, _FACT_TS)
    if streaming:
        left = left.withWatermark(_ENTITY_TS, watermark) if entities.isStreaming else left
        right = right.withWatermark(_FACT_TS, watermark) if facts.isStreaming else right
    if salts > 1:
        spread = spread_by or facts.columns
        spread = [_FACT_TS if c == stamp else c for c in spread]
        right = right.withColumn(_SALT, salt_of(spread, salts))
        left = left.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    if hot is not None:
        few = F.broadcast(hot.select(key, F.col("salts").alias("_salts")))
        spread = [_FACT_TS if c == stamp else c for c in spread_by or facts.columns]
        right = right.join(few, key, "left")
        right = right.withColumn(_SALT, F.when(F.col("_salts").isNotNull(), F.pmod(salt_of(spread, 1 << 30), F.col("_salts"))).otherwise(0)).drop("_salts")
        left = left.join(few, key, "left")
        left = left.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")

    left, right = left.alias("e"), right.alias("f")
    condition = F.col(f"e.{key}") == F.col(f"f.{key}")
    if salts > 1 or hot is not None:
        condition &= F.col(f"e.{_SALT}") == F.col(f"f.{_SALT}")
    if within is not None:
        gap = F.expr(f"INTERVAL {within}")
        condition &= F.col(f"f.{_FACT_TS}").between(
            F.col(f"e.{_ENTITY_TS}") - gap, F.col(f"e.{_ENTITY_TS}") + gap
        )
    joined = left.join(right, condition, how)

    clash = (set(entities.columns) & set(facts.columns)) - {key, stamp}
    if clash:
        raise ValueError(f"rename columns present on both sides: {sorted(clash)}")
    later = F.greatest(F.col(f"e.{_ENTITY_TS}"), F.col(f"f.{_FACT_TS}"))
    # an inner join has both keys; an outer one shows whichever side is there
    own = F.col(f"e.{key}") if how == "inner" else F.coalesce(f"e.{key}", f"f.{key}")
    shown = [own.alias(key) if c == key else F.col(f"e.{c}") for c in entities.columns if c != stamp]
    shown += [F.col(f"f.{c}") for c in facts.columns if c not in (key, stamp)]
    out = joined.select(*shown, later.alias(stamp), F.to_date(later).alias(STAMP_DATE), *([F.col(f"f.{_FACT_TS}")] if once else []))
    if once:
        # only the fact's own time is left of the two, so the watermark is one
        out = (out.dropDuplicatesWithinWatermark([key, *once]) if streaming else out.dropDuplicates([key, *once])).drop(_FACT_TS)
    return out


def unmatched(rows: DataFrame, matched: DataFrame, key: str, may: Column | None = None) -> DataFrame:
    """Rows whose key does not occur among the matched ones; a null key never matches.

    Rows without a key skip the join, where they would all hash to one task; the scan that finds
    them prunes on null counts. Matched keys are made distinct first: copies of a hot key collapse
    before the shuffle, and the join reuses that shuffle. ``may`` says of a row whether its key may be matched at all
    (:func:`stratica.operators.bloom.may_contain`): the others are not shuffled either.
    """
    asked = F.col(key).isNotNull() if may is None else F.col(key).isNotNull() & may
    keyed = rows.where(asked)
    keyless = rows.where(~asked)
    return keyed.join(matched.select(key).distinct(), key, "left_anti").select(rows.columns).unionByName(keyless)


def restricted_to(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the ids; null and empty ids are ignored, repeats collapse first."""
    usable = ids.where(F.col(key).isNotNull())
    if dict(ids.dtypes)[key] == "string":
        usable = usable.where(F.col(key) != "")
    return rows.join(usable.select(key).distinct(), key, "left_semi")

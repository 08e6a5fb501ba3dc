"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from farsight.llm.common import broadcast_if_small, fresh_name, ranked, saved, text_size

#: How much of the sum of all sizes the mix holds, how often a row may be taken, and the weights in turn.
SHARE, MAX_EPOCHS, WEIGHTS = 1.5, 2, (3, 1, 2)
SEED = "mix"


def fill_level(sources: DataFrame, total: float) -> float:
    """The level at which min(cap, weight * level), summed over `sources` (cap, weight), is `total`.

    Each round clamps what is above its cap and shares what is left by weight among the others, until no more is
    clamped. Only two sums a round reach the driver. Infinite if all caps together are at most `total`.
    """
    level = -1.0
    while True:
        clamped = F.col("cap") < F.col("weight") * F.lit(level)
        found = sources.agg(
            F.sum(F.when(clamped, F.col("cap")).otherwise(0)).alias("clamped"),
            F.sum(F.when(~clamped, F.col("weight")).otherwise(0)).alias("weight"),
        ).first()
        if not found["weight"]:
            return float("inf")
        new = (total - found["clamped"]) / found["weight"]
        if new <= level:
            return level
        level = new


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source, source_size, target) for `sizes` (source, size): one row per source.

    Sources in the order of their code points, null last, weigh `weights` in turn. A source never gets more than
    `max_epochs` times its size; what it cannot take goes to the others by weight.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = ranked(totals, F.col("source").asc_nulls_last(), "rank")
    place = (F.col("rank") % len(weights)).cast("int")
    sources = saved(
        in_order.select(
            "source",
            "source_size",
            (F.col("source_size") * max_epochs).alias("cap"),
            F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("long").alias("weight"),
        ),
        "sources",
    )
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = F.lit(fill_level(sources, total))
    return sources.select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * level).alias("target")
    )


def draw(row_id: Column, seed: str) -> Column:
    """A number of 24 bits, evenly spread, that depends on the id and the seed only."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(row_id.cast("string"), F.lit("")))), 1, 6)
    return F.conv(digits, 16, 10).cast("int")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """All columns of `docs` and size, source_size, target, copies, taken (which replace columns of these names).

    A source's target over its size is split into whole repetitions, which every row gets, and a fraction, which
    the rows of lowest draw get, up to the draw where the source's words come nearest to the target. That draw is
    found from sums of sizes: by the upper half of its bits, then by the lower half within one value of the upper,
    so that a source has at most 2 * 4096 sums however many rows it holds; rows of one draw go together.

    A null text has size 0, a null source is a source of its own; a source of size 0 has copies 0, or `max_epochs` where its
    rows are all without words (nothing is taken either way). Equal ids draw alike. An empty table gives no rows.
    """
    columns = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "copies", "taken")]
    own_draw, own_source = fresh_name("draw", columns), fresh_name("mixed_source", columns)
    sized = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        text_size(F.col(f"`{text_col}`")).alias("size"),
        draw(F.col(f"`{id_col}`"), seed).alias(own_draw),
        F.col(f"`{source_col}`").alias(own_source),
    )
    small = saved(sized.select(F.col(own_source).alias("source"), "size", F.col(own_draw).alias("draw")), "sizes")
    targets = source_targets(small, weights, share, max_epochs).withColumn(
        "whole",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)),
    )
    targets = saved(targets.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    same = lambda right: F.col("l.source").eqNullSafe(F.col(f"{right}.source"))

    def lowest(bins: DataFrame) -> DataFrame:
        """Of each source's (source, bin, size), the sizes before each bin, with the source's need."""
        before = F.sum("size").over(W.partitionBy("source").orderBy("bin")) - F.col("size")
        found = bins.withColumn("before", before)
        return found.alias("l").join(targets.alias("t"), same("t")).select("l.*", "t.need")

    upper = small.groupBy("source", F.shiftright("draw", 12).alias("bin")).agg(F.sum("size").alias("size"))
    edge = lowest(upper).filter("before <= need AND need < before + size")
    edge = saved(edge.select("source", "bin", "before", "need"), "edges")
    lower = (
        small.alias("l")
        .join(edge.alias("e"), same("e") & (F.shiftright("l.draw", 12) == F.col("e.bin")))
        .groupBy("e.source", "e.before", "e.need", F.col("l.draw").alias("bin"))
        .agg(F.sum("l.size").alias("size"))
        .withColumn("from", F.sum("size").over(W.partitionBy("source").orderBy("bin")) - F.col("size") + F.col("before"))
    )
    # the first draw that is left out: rows that hold the need's middle or lie before it are taken
    taken = F.col("from") + F.col("size") - F.col("need") <= F.col("need") - F.col("from")
    limits = lower.groupBy("source").agg(
        F.coalesce(F.max(F.when(taken, F.col("bin"))) + 1, F.min("bin")).alias("limit")
    )
    plan = saved(
        targets.alias("l")
        .join(limits.alias("r"), same("r"), "left")
        .select("l.*", F.when(F.col("need") > 0, F.coalesce("r.limit", F.lit(1 << 24))).otherwise(0).alias("limit")),
        "mix-plan",
    )
    copies = F.col("t.whole") + F.when(F.col(f"l.{own_draw}") < F.col("t.limit"), 1).otherwise(0)
    return (
        sized.alias("l")
        .join(
            broadcast_if_small(plan, F.coalesce(F.length("source"), F.lit(0)) + 64).alias("t"),
            F.col(f"l.{own_source}").eqNullSafe(F.col("t.source")),
        )
        .select(
            *[F.col(f"l.`{c}`") for c in columns],
            "l.size",
            "t.source_size",
            "t.target",
            copies.cast("long").alias("copies"),
            (F.col("l.size") * copies).cast("long").alias("taken"),
        )
    )

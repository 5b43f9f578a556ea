"""Mixing sources to target weights.

Words are counted per source, every source gets a target (a weighted share of
the wanted total, at most ``max_rate`` times what it has; what a capped source
cannot take is reshared by weight), and a document is emitted ``floor(rate)``
times plus one hash-seeded Bernoulli copy whose probability is the fraction of
its source's rate (``rate = target / source size``).

The copy of a document depends only on its id and its source's seed.  Eight
seeds are tried per source in one aggregate and the one whose total lands
nearest the target is used, so a source of few, very uneven documents comes
near its target too.

Defined results: a NULL text has size 0 (its copies take no words); NULL is a
source of its own and sorts last; a source without words has target 0 and is
not emitted; an empty table gives an empty result; repeated rows (same id)
share one decision; input columns that clash with the computed ones
(``size source_size target copies``) are replaced.

Plan: one scan aggregates sizes to a narrow table in the shared folder; the
per-source table (one row per source) is joined by broadcast only after its
row count is checked, otherwise by a shuffle join.  Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.storage import materialize
from dimforge.operators.joins import broadcast_if_small

WORD = r"[^\x20\x09-\x0D]+"
SEEDS = 8
ADDED = ("size", "source_size", "target", "copies")


def word_count(text: str):
    """Number of white-space separated words; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(key: str):
    """Eight independent numbers in [0, 1) from one digest of the id."""
    digest = F.sha2(F.concat(F.lit("mix:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
                     for k in range(SEEDS)])


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5,
            max_rate: float = 2.0) -> DataFrame:
    """Per-source targets from ``(src, size)`` rows: ``src, source_size,
    target, rate``.

    Water filling in closed form: the source with cap ``c`` and weight ``w``
    is capped exactly if filling every source to the level ``c / w`` needs no
    more than the budget.  The windows run over one row per source.
    """
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    order = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (order % len(weights) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(1))
    upto = everything.orderBy(F.col("cap") / F.col("w")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    t = (per.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(max_rate)))
            .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
            .withColumn("all_w", F.sum("w").over(everything))
            .withColumn("cap_below", F.sum("cap").over(upto)).withColumn("w_below", F.sum("w").over(upto))
            .withColumn("capped", F.col("cap_below") * F.col("w") + F.col("cap") * (F.col("all_w") - F.col("w_below"))
                        <= F.col("budget") * F.col("w"))
            .withColumn("left", F.col("budget") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything))
            .withColumn("free_w", F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("w"))).over(everything)))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * (F.col("left") / F.col("free_w")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return t.withColumn("target", target).select("src", "source_size", "target", rate.alias("rate"))


def _join_sources(df: DataFrame, per_source: DataFrame) -> DataFrame:
    p = broadcast_if_small(per_source.withColumnRenamed("src", "_mix_src"))
    return df.join(p, df["src"].eqNullSafe(p["_mix_src"]), "left").drop("_mix_src")


def seeded_plan(sizes: DataFrame, **mix) -> DataFrame:
    """Per source: ``src, source_size, target, rate, seed`` from narrow
    ``(key, src, size)`` rows."""
    per = materialize(targets(sizes, **mix), "mix-targets")
    frac = F.col("rate") - F.floor("rate")
    trial = _join_sources(sizes.withColumn("u", _uniform("key")), per)
    sums = trial.groupBy("src").agg(*[
        F.sum(F.when(F.col("u")[k] < frac, F.col("size")).otherwise(0)).alias(f"extra{k}") for k in range(SEEDS)])
    best = _join_sources(sums, per)
    miss = F.array(*[F.abs(F.floor("rate") * F.col("source_size") + F.col(f"extra{k}") - F.col("target"))
                     for k in range(SEEDS)])
    return materialize(best.select("src", "source_size", "target", "rate",
                                   F.array_position(miss, F.array_min(miss)).cast("int").alias("seed")), "mix-plan")


def mix_plan(docs: DataFrame, *, text: str = "text", source: str = "source", key: str = "doc_id", **mix) -> DataFrame:
    """``docs`` plus ``size``, ``source_size``, ``target`` (of its source) and
    ``copies`` (how often the mix emits the document)."""
    base = docs.drop(*[c for c in ADDED if c not in (text, source, key)])
    narrow = materialize(base.select(F.col(key).alias("key"), F.col(source).alias("src"),
                                     word_count(text).alias("size")), "mix-sizes")
    plan = seeded_plan(narrow, **mix)
    cols = [F.col(c) for c in base.columns]
    d = base.select(F.struct(*cols).alias("row"), F.col(source).alias("src"), word_count(text).alias("size"),
                    _uniform(key).alias("u"))
    d = _join_sources(d, plan)
    extra = (F.col("u")[F.col("seed") - 1] < F.col("rate") - F.floor("rate")).cast("long")
    return d.select("row.*", "size", "source_size", "target", (F.floor("rate") + extra).alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document repeated ``copies`` times, with the
    columns of ``docs``."""
    plan = mix_plan(docs, **options)
    return (plan.where("copies > 0")
                .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
                .select(*docs.columns))

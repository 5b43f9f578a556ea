"""Runs of consecutive periods as small states that merge.

``streak_states`` describes the periods of an entity in one chunk of the
calendar by ``first, last`` (its first and last period), ``head, tail`` (length
of the run that starts at ``first`` and of the one that ends at ``last``) and
``longest, longest_start`` (the earliest of the longest runs).  Two such states
merge when one lies before the other, so an entity with a very long history is
worked on in many tasks, and a new period needs yesterday's state only, not the
history.  Merging is associative: chunks and loads may be grouped in any way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 10_000
STATE = ("first", "last", "head", "tail", "longest", "longest_start")


def run_starts(periods: str) -> Column:
    """Of a sorted array of distinct integers: those without their predecessor."""
    ps = F.col(periods)
    return F.filter(ps, lambda p, i: (i == 0) | (F.get(ps, i - 1) != p - 1))


def run_ends(periods: str) -> Column:
    """Of a sorted array of distinct integers: those without their successor."""
    ps = F.col(periods)
    return F.filter(ps, lambda p, i: (i == F.size(ps) - 1) | (F.get(ps, i + 1) != p + 1))


def streak_states(hits: DataFrame, *, keys: Sequence[str], period: str, chunk: int = CHUNK) -> DataFrame:
    """``keys``, the chunk's number and the state of its periods.  ``hits``
    holds a row for each period that counts; repeated rows count once, rows
    without a period not at all, a NULL key is an entity.  At most ``chunk``
    periods meet in one group."""
    p = F.col(period).cast("int")
    sets = (hits.where(F.col(period).isNotNull())
                .groupBy(*keys, F.floor(p / chunk).cast("long").alias("chunk"))
                .agg(F.sort_array(F.collect_set(p)).alias("_ps")))
    runs = sets.select(*keys, "chunk", run_starts("_ps").alias("_s"), run_ends("_ps").alias("_e"))
    lengths = F.zip_with("_s", "_e", lambda s, e: F.struct((e - s + 1).alias("n"), (-s).alias("neg_start")))
    runs = runs.select(*keys, "chunk", F.element_at("_s", 1).alias("first"), F.element_at("_e", -1).alias("last"),
                       lengths.alias("_n"), F.array_max(lengths).alias("_top"))
    return runs.select(*keys, "chunk", "first", "last", F.element_at("_n", 1)["n"].alias("head"),
                       F.element_at("_n", -1)["n"].alias("tail"), F.col("_top.n").alias("longest"),
                       (-F.col("_top.neg_start")).alias("longest_start"))


def _merged(a: Column, b: Column) -> Column:
    """The state of ``a``'s and ``b``'s periods; all of ``b`` come after ``a``."""
    meet = a["last"] + 1 == b["first"]
    whole_a, whole_b = a["head"] == a["last"] - a["first"] + 1, b["head"] == b["last"] - b["first"] + 1
    across = F.struct(F.when(meet, a["tail"] + b["head"]).otherwise(F.lit(0)).alias("n"),
                      (a["tail"] - a["last"] - 1).alias("neg_start"))
    top = F.array_max(F.array(F.struct(a["longest"].alias("n"), (-a["longest_start"]).alias("neg_start")), across,
                              F.struct(b["longest"].alias("n"), (-b["longest_start"]).alias("neg_start"))))
    ordered = F.when(a["last"] < b["first"], a["first"]).otherwise(
        F.raise_error(F.concat(F.lit("streak states overlap at period "), b["first"].cast("string"))).cast("int"))
    return F.struct(ordered.alias("first"), b["last"].alias("last"),
                    F.when(meet & whole_a, a["head"] + b["head"]).otherwise(a["head"]).alias("head"),
                    F.when(meet & whole_b, a["tail"] + b["tail"]).otherwise(b["tail"]).alias("tail"),
                    top["n"].alias("longest"), (-top["neg_start"]).alias("longest_start"))


def merge_streaks(states: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """One state per entity from states over disjoint stretches of periods
    (chunks, or stored states and those of a new load).  Stretches that overlap
    raise: a period loaded again replaces its chunk's state, it is not added."""
    rows = states.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*STATE))).alias("_x"))
    one = F.aggregate(F.slice("_x", 2, F.size("_x")), F.element_at("_x", 1), _merged)
    return rows.select(*keys, one.alias("_y")).select(*keys, *[F.col(f"_y.{c}").alias(c) for c in STATE])


def streak_step(stored: DataFrame | None, hits: DataFrame, *, keys: Sequence[str], period: str,
                chunk: int = CHUNK) -> DataFrame:
    """Stored states and later periods: the states afterwards.  The periods
    before are not read."""
    new = streak_states(hits, keys=keys, period=period, chunk=chunk).drop("chunk")
    return merge_streaks(new if stored is None else stored.select(*keys, *STATE).unionByName(new), keys=keys)

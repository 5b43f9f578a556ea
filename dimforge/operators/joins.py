"""Join helpers shared by the cumulative operators.

* ``broadcast_if_small`` — broadcast a dimension only after proving its row
  count is below a bound (a ``limit(n+1).count()`` probe: no rows reach the
  driver); beyond the bound the join is left to the planner (sort-merge, or a
  run-time conversion by AQE from the measured size, see ``session``).
* ``full_outer`` — the prior-snapshot ⟗ new-period join of every cumulative
  step.  Rows whose key is NULL never match (plain ``=``, as in SQL); they
  bypass the join (padded with NULLs) instead of all hashing to one task.
* ``dealt_join`` — two tables of any size whose joined rows are then grouped by
  the join key in the same tasks: as many tasks as the rows need.
* ``split_join`` — a large dimension and facts with a few very frequent keys:
  these meet a broadcast slice of the dimension, the rest is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def bounded_count(df: DataFrame, limit: int) -> int:
    """``min(row count, limit + 1)``: counts at most ``limit + 1`` rows of each
    partition, of an empty projection, and merges the counts; nothing but the
    number reaches the driver.  Answers are not remembered: the table may have
    been rewritten in place."""
    return df.select(F.lit(1).alias("_one")).limit(limit + 1).count()


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Return ``broadcast(df)`` if ``df`` has at most ``max_rows`` rows
    (proven by :func:`bounded_count`); beyond the bound the join is left to
    the planner (sort-merge, or an AQE conversion from measured sizes)."""
    return F.broadcast(df) if bounded_count(df, max_rows) <= max_rows else df


# Rows of both sides of ``dealt_join`` in one task.
TASK_ROWS = 1_000_000


def dealt_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """``left`` inner-joined to ``right`` on one column each, at most about
    ``task_rows`` rows of both per task, whatever their size.

    For rows that are grouped or numbered by the join key next: that runs in the
    join's tasks, whose sorts and groups are all held at once, and adaptive
    execution deals tasks out by compressed bytes.  A table that the planner's
    own tasks hold within ``task_rows`` is left to the planner.  Both sides are
    counted: pass stored tables.  Rows of one key stay in one task, so a join
    whose rows are not grouped is better left to the planner, which splits hot
    keys."""
    spark = left.sparkSession
    tasks = -(-(left.count() + right.count()) // task_rows)
    if tasks > min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))):
        left, right = left.repartition(tasks, left_key), right.repartition(tasks, right_key)
    return left.join(right, left[left_key] == right[right_key])


def _any_null(df: DataFrame, keys) -> Column:
    return reduce(lambda a, b: a | b, [df[k].isNull() for k in keys])


def _all_set(df: DataFrame, keys) -> Column:
    return reduce(lambda a, b: a & b, [df[k].isNotNull() for k in keys])


def full_outer(prev: DataFrame, cur: DataFrame, keys, project, keys_not_null: bool = False) -> DataFrame:
    """``prev FULL OUTER JOIN cur ON prev.k = cur.k``, projected by
    ``project(p, c)`` where ``p(name)`` / ``c(name)`` return a side's column
    (NULL when the row has no partner on that side).

    Rows whose key is NULL never match (SQL ``=``).  They are split off
    before the join and padded with typed NULLs instead of being hashed to
    one partition, so the join shuffles on the plain keys only — an existing
    hash or bucket partitioning of either side on those keys is reused — and
    a NULL-heavy input cannot create a hot partition.  (For Parquet inputs
    the ``IS NULL`` branch is mostly skipped by row-group statistics.)

    ``keys_not_null`` declares that no key is NULL: each input is then read
    once.  A NULL key would still give a correct, unmatched row.
    """
    ptypes = {f.name: f.dataType for f in prev.schema.fields}
    ctypes = {f.name: f.dataType for f in cur.schema.fields}
    p_ok, c_ok = (prev, cur) if keys_not_null else (prev.where(_all_set(prev, keys)), cur.where(_all_set(cur, keys)))
    pa, ca = p_ok.alias("p"), c_ok.alias("c")
    cond = reduce(lambda a, b: a & b, [F.col(f"p.{k}") == F.col(f"c.{k}") for k in keys])
    matched = pa.join(ca, cond, "full_outer").select(
        *project(lambda x: F.col(f"p.{x}"), lambda x: F.col(f"c.{x}")))
    if keys_not_null:
        return matched
    only_p = prev.where(_any_null(prev, keys)).select(
        *project(lambda x: F.col(x), lambda x: F.lit(None).cast(ctypes[x])))
    only_c = cur.where(_any_null(cur, keys)).select(
        *project(lambda x: F.lit(None).cast(ptypes[x]), lambda x: F.col(x)))
    return matched.unionByName(only_p).unionByName(only_c)


def frequent_keys(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """Hashes (``_hot``) of the keys that hold about ``1 / parts`` of the rows
    or more, at most ``2 * parts``: a frequent-items sketch per task, merged.
    A key above the bound is never missed by more than the sketch's error
    (below a third of the bound); rows without a key do not count."""
    named = df.where(_all_set(df, keys)).select(F.xxhash64(*keys).alias("_k"))
    one = named.agg(F.count(F.lit(1)).alias("_n"), F.expr(f"approx_top_k(_k, {2 * parts}, {16 * parts})").alias("_top"))
    return (one.select("_n", F.inline("_top")).where(F.col("count") * parts * 2 >= F.col("_n"))
               .select(F.col("item").alias("_hot")))


def split_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], *, how: str = "left", parts: int | None = None,
               max_rows: int = 100_000) -> DataFrame:
    """``facts`` joined to a dimension that is too large to broadcast, on keys
    of the same names, a few of which may hold most of the rows.

    Rows of frequent keys stay where they are and meet the broadcast slice of
    the dimension that these keys need; if that slice has more than
    ``max_rows`` rows, frequent keys are salted instead.  The other rows are
    shuffled.  Rows with a NULL key match nothing and are not shuffled
    (``left``: NULLs for the dimension's columns).  ``parts``: a key with more
    than about 1 / parts of the rows is frequent (default: the number of shuffle
    partitions).  Repeated rows on either side join as they would plainly.
    ``facts`` and ``dim`` are read for each share: pass stored tables."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    parts = parts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(keys)
    out = [*facts.columns, *[c for c in dim.columns if c not in keys]]
    hot = frequent_keys(facts, keys, parts)
    found = [r[0] for r in hot.collect()]                                # at most 2 * parts numbers
    is_hot = F.xxhash64(*keys).isin(found) if found else F.lit(False)
    named = facts.where(_all_set(facts, keys))
    joined = named.where(~is_hot).join(dim.where(~is_hot), keys, how).select(*out)
    if found:
        often, few = named.where(is_hot), dim.where(is_hot)
        if bounded_count(few, max_rows) <= max_rows:
            rows = often.join(F.broadcast(few), keys, how)
        else:
            salted = often.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int"))
            many = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
            rows = salted.join(many, [*keys, "_salt"], how)
        joined = joined.unionByName(rows.select(*out))
    if how == "left":
        types = {f.name: f.dataType for f in dim.schema.fields}
        bare = facts.where(_any_null(facts, keys))
        joined = joined.unionByName(bare.select(*facts.columns, *[F.lit(None).cast(types[c]).alias(c) for c in out[len(facts.columns):]]))
    return joined

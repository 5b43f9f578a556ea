"""Document fingerprints: bottom-k sketches of shingle hashes.

A fingerprint is the ``k`` smallest distinct 32-bit hashes of a text's word
shingles, ascending, as big-endian binary.  The sketch of a union is the ``k``
smallest of two sketches, so parts of a document (or of a collection) are
fingerprinted apart and merged.  Two sketches estimate resemblance (Jaccard) and
containment, one the number of distinct shingles; sketches of fewer than ``k``
values are the whole set, and what they estimate is exact.

Equal texts have equal fingerprints.  Defined results: NULL and empty texts, and
texts without words, have the empty fingerprint; two empty ones are alike (1),
an empty and another are not (0); a text shorter than ``width`` words is one
shingle; repeated rows are separate documents; an empty table gives an empty
result; the added columns replace clashing input columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimforge.llm.chosen_path import shingles
from dimforge.llm.storage import forget, materialize, ship_package, tidy

K = 64
WIDTH = 5
HELD = 50_000                # sketches that a task of merge_parts holds


def sketch(data: bytes, k: int = K, width: int = WIDTH) -> np.ndarray:
    """The ``k`` smallest distinct shingle hashes, ascending."""
    h = (shingles(data, width) >> np.uint64(32)).astype(np.uint32)         # ascending still
    if len(h) > 1:
        h = h[np.concatenate([[True], h[1:] != h[:-1]])]
    return h[:k]


def pack(s: np.ndarray) -> bytes:
    return s.astype(">u4").tobytes()


def unpack(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", ">u4").astype(np.uint32)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity: the share of the union's sketch that lies
    in both; exact if both sketches are whole sets."""
    whole = len(a) < k and len(b) < k
    union = merge(a, b, len(a) + len(b) if whole else k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(both <= union[-1])) / len(union)


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**32 / (float(a[k - 1]) + 1.0)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has: resemblance times the size of
    the union over the size of a."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def _estimator(f, k: int):
    @F.pandas_udf("double")
    def estimate(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(unpack(x), unpack(y), k) for x, y in zip(a, b)], dtype="float64")

    return estimate


def resemblance_of(a, b, k: int = K):
    """:func:`resemblance` of two fingerprint columns."""
    return _estimator(resemblance, k)(a, b)


def containment_of(a, b, k: int = K):
    """:func:`containment` of two fingerprint columns."""
    return _estimator(containment, k)(a, b)


def distinct_of(a, k: int = K):
    """:func:`distinct` of a fingerprint column."""
    @F.pandas_udf("double")
    def estimate(x: pd.Series) -> pd.Series:
        return pd.Series([distinct(unpack(v), k) for v in x], dtype="float64")

    return estimate(a)


def _kept(docs: DataFrame, keep, added) -> list[str]:
    return [c for c in (docs.columns if keep is None else keep) if c not in added]


def fingerprint(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, k: int = K,
                width: int = WIDTH) -> DataFrame:
    """The ``keep`` columns (all by default) plus ``fingerprint``; no shuffle."""
    ship_package(docs.sparkSession)
    keep = _kept(docs, keep, ("fingerprint",))
    source = docs.select(*keep, F.col(text).cast("binary").alias("_fp_text"))

    def run(batches):
        forget()
        for batch in batches:
            made = [pack(sketch(t.as_py() or b"", k, width)) for t in batch.column("_fp_text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(made, pa.binary())],
                                             names=[*keep, "fingerprint"])

    return source.mapInArrow(run, T.StructType([source.schema[c] for c in keep] + [T.StructField("fingerprint", T.BinaryType())]))


def merge_parts(parts: DataFrame, by: str, *, k: int = K) -> DataFrame:
    """One fingerprint per value of ``by`` (NULL is a value), that of all its
    rows' shingles together.  Tasks merge what they read before the shuffle, so
    a value that holds a third of the rows sends few sketches per task; after
    it, the sketches of a value stream by and are merged one by one."""
    ship_package(parts.sparkSession)
    rows = parts.select(F.col(by), F.col("fingerprint"))
    schema = T.StructType([rows.schema[by], T.StructField("fingerprint", T.BinaryType())])

    def merged(most):
        def run(batches):
            held, kind = {}, None

            def out():
                return pa.RecordBatch.from_arrays([pa.array([v for v, _ in held.values()], kind),
                                                   pa.array([pack(s) for _, s in held.values()], pa.binary())],
                                                  names=[by, "fingerprint"])

            for batch in batches:
                kind = batch.schema.field(by).type
                for value, raw in zip(batch.column(by).to_pylist(), batch.column("fingerprint").to_pylist()):
                    name, new = repr(value), unpack(raw)
                    if name not in held and len(held) >= most:
                        yield out()
                        held = {}
                    held[name] = (value, merge(held[name][1], new, k) if name in held else new[:k])
            if held:
                yield out()
        return run

    return (rows.mapInArrow(merged(HELD), schema).repartition(by).sortWithinPartitions(by)
                .mapInArrow(merged(1), schema))


ADDED = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
DONE, LAST, FIRST = 0, 1, 2


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as many code points of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


class _Compared:
    """Columns of finished rows."""

    def __init__(self, k: int, width: int):
        self.k, self.width, self.rows = k, width, []

    def sketch(self, text: str) -> np.ndarray:
        return sketch(text.encode(), self.k, self.width)

    def add(self, text: str, own: np.ndarray, following: str, next_sketch: np.ndarray) -> None:
        changed = edited(text, following)
        other = self.sketch(changed)
        self.rows.append((len(text), hashlib.sha256(changed.encode()).hexdigest(), pack(own), pack(other),
                          resemblance(own, other, self.k), resemblance(own, next_sketch, self.k)))

    def columns(self) -> list[pa.Array]:
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
        columns = list(zip(*self.rows)) if self.rows else [[]] * len(kinds)
        return [pa.array(c, t) for c, t in zip(columns, kinds)]


def compare_with_next(docs: DataFrame, *, key: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                      k: int = K, width: int = WIDTH) -> DataFrame:
    """Each document beside the next one in descending order of ``key`` (NULL
    last, equal keys by their texts' hash; the first follows the last).

    Adds ``n_chars``, ``edited_sha256`` (of the text whose last half is
    replaced by the beginning of the next), ``fingerprint`` and
    ``edited_fingerprint``, and the resemblances ``near_edited`` and
    ``near_next``.

    Texts are range-partitioned by the key and sorted once; equal keys without
    end are split by the row's position.  A task compares neighbours as they
    stream by; only its first and last texts are written, and meet those of the
    neighbouring partitions in a join of two rows per partition.
    """
    ship_package(docs.sparkSession)
    keep = _kept(docs, keep, ADDED)
    source = docs.select(*keep, F.col(key).alias("_fp_key"), F.coalesce(F.col(text), F.lit("")).alias("_fp_text"))
    kept = [source.schema[c] for c in keep]
    order = [F.col("_fp_key").desc_nulls_last(), F.col("_fp_hash"), F.col("_fp_pos")]
    ordered = (source.withColumn("_fp_hash", F.xxhash64("_fp_text")).withColumn("_fp_pos", F.monotonically_increasing_id())
                     .repartitionByRange(*order).sortWithinPartitions(*order).select(*keep, "_fp_text"))
    result = [T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
              T.StructField("fingerprint", T.BinaryType()), T.StructField("edited_fingerprint", T.BinaryType()),
              T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())]
    schema = T.StructType([T.StructField("_fp_part", T.LongType()), T.StructField("_fp_kind", T.IntegerType()),
                           T.StructField("_fp_text", T.StringType()), *kept, *result])

    def neighbours(batches):
        forget()
        part, last = TaskContext.get().partitionId(), None         # last: a row of the kept columns, text, sketch

        def rows(kind, columns, texts, found):
            n = len(texts)
            empty = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                     pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64())]
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array(texts, pa.string()),
                 *columns, *(found or empty)], names=schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            done, texts = _Compared(k, width), batch.column("_fp_text")
            before = last
            for t in texts:
                t = t.as_py()
                own = done.sketch(t)
                if last is not None:
                    done.add(last[1], last[2], t, own)
                else:
                    yield rows(FIRST, batch.slice(0, 1).select(keep).columns, [t], None)
                last = (None, t, own)
            # a row is finished when its successor has come: one batch late for the last
            finished = batch.select(keep).slice(0, batch.num_rows - 1)
            columns = [pa.concat_arrays([b, f]) for b, f in zip(before[0].columns, finished.columns)] if before else finished.columns
            yield rows(DONE, columns, [None] * len(done.rows), done.columns())
            last = (batch.select(keep).slice(batch.num_rows - 1, 1), *last[1:])
        if last is not None:
            yield rows(LAST, last[0].columns, [last[1]], None)

    def across(batches):
        forget()
        for batch in batches:
            done = _Compared(k, width)
            for t, following in zip(batch.column("_fp_text").to_pylist(), batch.column("_fp_next").to_pylist()):
                done.add(t, done.sketch(t), following, done.sketch(following))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *done.columns()], names=[*keep, *ADDED])

    made = materialize(ordered.mapInArrow(tidy(neighbours), schema), "fingerprints")
    first = made.where(F.col("_fp_kind") == FIRST).select("_fp_part", "_fp_text")
    everything = Window.partitionBy(F.lit(0))                                      # one row per partition
    follows = first.select("_fp_part", F.coalesce(F.lead("_fp_part").over(everything.orderBy("_fp_part")),
                                                  F.min("_fp_part").over(everything)).alias("_fp_after"))
    heads = first.select(F.col("_fp_part").alias("_fp_after"), F.col("_fp_text").alias("_fp_next"))
    seam = (made.where(F.col("_fp_kind") == LAST).select("_fp_part", "_fp_text", *keep)
                .join(follows, "_fp_part").join(heads, "_fp_after").select(*keep, "_fp_text", "_fp_next"))
    inside = made.where(F.col("_fp_kind") == DONE).select(*keep, *ADDED)
    return inside.unionByName(seam.mapInArrow(across, T.StructType([*kept, *result])))

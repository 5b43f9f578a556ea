"""Embedding near-duplicates with spherical k-means cells.

Vectors are compared only within their label.  Equal vectors are first folded
into one class (a hot vector costs one row).  Per label, spherical k-means is
fitted on a bounded hash sample (``sample`` vectors) with about one cell for
every ``cell_rows`` vectors; every vector goes to its nearest cell (home) and,
as a guest, to each cell whose similarity is within ``margin`` of it.  A linked
pair is missed only if both vectors lie more than ``margin`` inside their own
cells, i.e. if the pair's difference moves the gap between the two cells by
more than ``2 * margin``; measured recall is in the README.

Within a cell, blocks of at most ``block_rows`` vectors are compared by cosine
in double precision; a large cell becomes block pairs, so no task holds a
whole group.  A pair that meets in two cells is counted in one of them.  Tasks
return link counts and one local root per vector, never all pairs.

Defined results: vectors that are NULL, zero, or hold a NULL or non-finite
component, and vectors without a label, link with nothing; vectors of
different lengths never link; repeated rows are separate vectors; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.components import components
from dimforge.llm.storage import materialize, ship_package


def _normed(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids; rows of ``x`` in a fixed order make it repeatable."""
    x = _normed(x)
    centre = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        cell = np.argmax(x @ centre.T, axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, cell, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(size > 1e-12, total / np.maximum(size, 1e-12), centre)
    return centre


def _fit(cell_rows: int, sample: int):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "rep"])
        n = int(pdf["total"].iloc[0])
        k = max(1, min(-(-n // cell_rows), sample // 8, len(pdf)))
        centre = spherical_kmeans(np.stack(pdf["vec"].to_numpy()).astype(float), k)
        return pd.DataFrame({"label": pdf["label"].iloc[0], "dim": pdf["dim"].iloc[0],
                             "cell": np.arange(k), "centre": list(centre)})
    return fit


def _assign(margin: float):
    def assign(rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        columns = ["label", "dim", "cell", "home", "cells", "rep", "n", "vec"]
        if not len(rows):
            return pd.DataFrame(columns=columns)
        centres = centres.sort_values("cell")
        sim = _normed(np.stack(rows["vec"].to_numpy()).astype(float)) @ np.stack(centres["centre"].to_numpy()).T
        home = sim.argmax(1)
        inside = sim >= sim[np.arange(len(sim)), home][:, None] - margin
        row, cell = np.nonzero(inside)
        cells = [np.flatnonzero(i) for i in inside]
        out = rows.iloc[row]
        return pd.DataFrame({"label": out["label"].to_numpy(), "dim": out["dim"].to_numpy(), "cell": cell,
                             "home": home[row], "cells": [cells[r] for r in row], "rep": out["rep"].to_numpy(),
                             "n": out["n"].to_numpy(), "vec": out["vec"].to_numpy()})
    return assign


def local_roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable through a symmetric link matrix."""
    root = np.arange(len(linked))
    while True:
        best = np.where(linked, root[None, :], len(root)).min(1, initial=len(root))
        new = np.minimum(root, best)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(threshold: float):
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", kind="stable").reset_index(drop=True)
        cell, same = pdf["cell"].iloc[0], pdf["bi"].iloc[0] == pdf["bj"].iloc[0]
        x = np.stack(pdf["vec"].to_numpy()).astype(float)
        norm = np.linalg.norm(x, axis=1)
        linked = (x @ x.T) / np.outer(norm, norm) >= threshold
        np.fill_diagonal(linked, False)
        if not same:
            linked &= pdf["block"].to_numpy()[:, None] != pdf["block"].to_numpy()[None, :]
        # a pair counts in the smallest cell that both are in
        cells = pdf["cells"].to_numpy()
        row, other = np.repeat(np.arange(len(pdf)), [len(c) for c in cells]), np.concatenate(cells)
        row, other = row[other < cell], other[other < cell]
        if len(row):
            lower, column = np.unique(other, return_inverse=True)
            inside = np.zeros((len(pdf), len(lower)), np.float32)
            inside[row, column] = 1
            linked &= inside @ inside.T == 0
        some = linked.any(1)
        root = local_roots(linked)
        rep = pdf["rep"].to_numpy()
        return pd.DataFrame({"rep": rep[some], "links": (linked @ pdf["n"].to_numpy())[some], "root": rep[root][some]})
    return compare


def near_vectors(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = 0.93, cell_rows: int = 512, block_rows: int = 256, margin: float = 0.12,
                 sample: int = 20_000) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"),
                          F.col(vector).cast("array<double>").alias("vec"))
    sound = (F.col("label").isNotNull() & F.col("vec").isNotNull() & F.col("id").isNotNull()
             & F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
             & F.coalesce(F.exists("vec", lambda x: x != 0.0), F.lit(False)))
    valid = rows.where(sound)
    kind = dict(vectors.dtypes)[label]
    classes = materialize(valid.groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
                               .withColumn("dim", F.size("vec")), "emb-classes")
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("total"))
    sizes = materialize(sizes, "emb-sizes")
    named = classes.withColumn("h", F.pmod(F.xxhash64("rep"), F.lit(1 << 30)))
    fit_rows = (named.join(sizes, ["label", "dim"])
                     .where(F.col("h") < F.least(F.lit(1.0), sample / F.col("total")) * (1 << 30)))
    head = f"label {kind}, dim int"
    centres = materialize(fit_rows.groupBy("label", "dim").applyInPandas(
        _fit(cell_rows, sample), f"{head}, cell int, centre array<double>"), "emb-centres")
    # chunks of a label, so that a large label is assigned by many tasks
    chunks = F.ceil(F.col("total") / 2048).cast("int")
    dealt = named.join(sizes, ["label", "dim"]).withColumn("chunk", F.pmod(F.col("h"), chunks).cast("int"))
    spread = materialize(centres.join(sizes, ["label", "dim"])
                                .withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
                                .drop("total"), "emb-spread")
    placed = materialize(
        dealt.groupBy("label", "dim", "chunk").cogroup(spread.groupBy("label", "dim", "chunk")).applyInPandas(
            _assign(margin), f"{head}, cell int, home int, cells array<int>, rep long, n long, vec array<double>"),
        "emb-placed")
    blocks = (placed.groupBy("label", "dim", "cell").agg(F.count(F.lit(1)).alias("c"))
                    .withColumn("blocks", F.ceil(F.col("c") / block_rows).cast("int")).drop("c"))
    cut = placed.join(blocks, ["label", "dim", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int"))
    pairs = (cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")))
    found = materialize(pairs.groupBy("label", "dim", "cell", "bi", "bj").applyInPandas(
        _compare(threshold), "rep long, links long, root long"), "emb-links")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per_class = materialize(
        classes.join(linked, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
               .select("label", "vec", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                       F.coalesce("component", "rep").alias("component_id")), "emb-result")
    matched = valid.join(per_class, ["label", "vec"]).select("id", "n_links", "component_id")
    alone = rows.where(~sound).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return matched.unionByName(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

"""N-gram Jaccard join by chosen paths.

Every text becomes the set of its word shingles (``width`` words).  Equal sets
are folded into one class, so copies cost one row.  Classes are split
recursively: a node of the recursion picks one or two (1.25 on average, the
inverse of the threshold) of ``SKETCH`` min-hash positions, the same for all
its members, and each member goes to the child named by its token there.  Two
sets of similarity 0.8 share a child with probability 0.8 per pick, so the
expected number of paths they share does not shrink with depth.  Nodes of at
most ``leaf_rows`` members are brute-forced by their sketches; larger ones are
split again, up to ``max_depth``; in what is then still large (sets that agree
along the whole path) members are compared with the smallest one, and those
that do not agree with it with all others, in block pairs.  Everything is repeated for ``runs`` independent recursions: a pair at
the threshold survives a run with probability 0.73 (two levels) to 0.57 (four),
so twelve runs reach a recall above 0.999 even at four levels.

Pairs whose sketches agree in at least ``loose`` of the positions (five
standard deviations below the threshold) tie classes into candidate groups.
Within a group *all* pairs are then checked exactly on the full shingle sets,
in block pairs, so a group of any size is spread over tasks.  Tasks return
link counts and one local root per class, never all pairs.

Defined results: documents without words or without an id link with nothing; a
text shorter than ``width`` words is one shingle; repeated rows are copies; an
empty table gives an empty result; only the key column is carried.

Recovery and memory: each round is written to the shared folder; texts are
scanned twice (sketches, then the sets of candidates only) and never shuffled
as long as the candidates fit a checked broadcast.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.components import components
from dimforge.llm.decontaminate import words
from dimforge.llm.storage import forget, materialize, ship_package, tidy
from dimforge.operators.joins import broadcast_if_small

SKETCH = 128
NARROW_ROWS = 1_000_000      # rows of one or two integers that may be broadcast
_RNG = np.random.default_rng(20240101)
_FLIP = _RNG.integers(0, 2**63, SKETCH, dtype=np.uint64)
_TIMES = _RNG.integers(0, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(data: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    ws = words(data)
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    w = min(width, len(h))
    with np.errstate(over="ignore"):
        s = h[:len(h) - w + 1] * _WORD[0]
        for k in range(1, w):
            s = s + h[k:len(h) - w + 1 + k] * _WORD[k]
            s = mix(s)
    return np.unique(mix(s))


def sketch(s: np.ndarray) -> np.ndarray:
    """Min-hash values of a non-empty set, 16 bits each.  The minimum of a large
    set is near 0, so it is scrambled before bits are taken from it."""
    low = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 2048):
            low = np.minimum(low, ((s[None, at:at + 2048] ^ _FLIP[:, None]) * _TIMES[:, None]).min(1))
    return mix(low).astype("<u2")


def _binary(column):
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def _sketch_task(width):
    def run(batches):
        forget()
        for batch in batches:
            keys, sigs, sizes, out = [], [], [], []
            for k, t in zip(batch.column("key").to_pylist(), _binary(batch.column("text"))):
                s = shingles(t.as_py() or b"", width)
                keys.append(k)
                sizes.append(len(s))
                some = len(s) and k is not None
                sigs.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if some else None)
                out.append(sketch(s).tobytes() if some else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sigs, pa.binary()), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())],
                names=["key", "sig", "size", "sketch"])
    return run


def children(node: np.ndarray, sketches: np.ndarray):
    """One splitting step: (row, child key) pairs.  Which positions a node
    picks depends on the node alone; a second position is picked by a quarter
    of the nodes."""
    rows = np.arange(len(node))
    out = []
    for pick in range(2):
        r = mix(node + np.uint64(pick + 1))
        use = rows if pick == 0 else rows[(mix(node ^ np.uint64(0x5DEECE66D)) & np.uint64(3)) == 0]
        at = (r[use] % np.uint64(SKETCH)).astype(np.int64)
        with np.errstate(over="ignore"):
            child = mix(mix(r[use]) ^ sketches[use, at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out.append((use, child))
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _matrix(column, dtype, width):
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _first_task(runs, levels):
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("sketch"), np.uint16, SKETCH)
            rep = batch.column("rep").to_numpy()
            for r in range(runs):
                row, node = np.arange(len(x)), np.full(len(x), mix(np.array([r + 1], np.uint64))[0])
                for _ in range(levels):
                    at, node = children(node, x[row])
                    row = row[at]
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(rep[row])], names=["node", "rep"])
    return run


def _deeper_task(batches):
    for batch in batches:
        x = _matrix(batch.column("sketch"), np.uint16, SKETCH)
        row, node = children(batch.column("node").to_numpy().view(np.uint64), x)
        yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(batch.column("rep").to_numpy()[row])],
                                         names=["node", "rep"])


def groups(batches, keys):
    """Runs of equal keys in sorted batches, as Arrow tables; a run may span
    batches."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in keys]
        cut = np.zeros(batch.num_rows, bool)
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        edges = np.flatnonzero(cut).tolist()
        for a, b in zip([0, *edges], [*edges, batch.num_rows]):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


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


def _leaf_task(loose):
    def run(batches):
        a, b = [], []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for t in groups(batches, ["node"]):
            if t.num_rows < 2:
                continue
            x = _matrix(t.column("small"), np.uint8, SKETCH)
            rep = t.column("rep").to_numpy()
            order = np.argsort(rep, kind="stable")
            x, rep = x[order], rep[order]
            need = int(np.ceil(loose * SKETCH))
            linked = np.zeros((len(x), len(x)), bool)
            for i in range(len(x) - 1):
                linked[i, i + 1:] = (x[i + 1:] == x[i]).sum(1) >= need
            root = local_roots(linked | linked.T)
            some = root != np.arange(len(root))
            a += rep[some].tolist()
            b += rep[root[some]].tolist()
            if len(a) > 50_000:
                yield out()
                a, b = [], []
        if a:
            yield out()
    return run


def _head_task(loose):
    """Members of heavy last nodes: whether their sketches agree with that of
    the node's smallest member."""
    def run(batches):
        need = int(np.ceil(loose * SKETCH))
        for batch in batches:
            x, head = (_matrix(batch.column(c), np.uint8, SKETCH) for c in ("small", "head"))
            tied = (x == head).sum(1) >= need
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("rep"), batch.column("least"), pa.array(tied)],
                                             names=["node", "rep", "least", "tied"])
    return run


def _heavy_nodes(frontier: DataFrame, heavy: DataFrame, classes: DataFrame, leaf_rows: int,
                 loose: float) -> tuple[DataFrame, DataFrame]:
    """Nodes above ``leaf_rows`` that are not split any more: ``(a, b)`` ties of
    members to their node's smallest one, and leaves ``(node, rep)`` in which
    every member without such a tie meets all others, in blocks of half a leaf.
    Near copies tie, so the blocks of their nodes are few."""
    small = classes.select("rep", "small")
    heads = heavy.select("node", "least").join(small.withColumnRenamed("rep", "least"), "least").withColumnRenamed("small", "head")
    members = frontier.join(broadcast_if_small(heads), "node").join(small, "rep").select("node", "rep", "least", "small", "head")
    found = materialize(members.mapInArrow(tidy(_head_task(loose)), "node long, rep long, least long, tied boolean"), "path-heavy")
    half = leaf_rows // 2
    blocks = (found.groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.sum((~F.col("tied")).cast("long")).alias("u"))
                   .where("u > 0").select("node", F.ceil(F.col("c") / half).cast("int").alias("cb"),
                                          F.ceil(F.col("u") / half).cast("int").alias("ub")))
    dealt = found.join(broadcast_if_small(blocks), "node")
    in_c = F.pmod(F.xxhash64("rep"), "cb").cast("int")
    in_u = F.pmod(F.xxhash64("rep", F.lit(1)), "ub").cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sides = (dealt.select("node", "rep", in_c.alias("i"), every("ub").alias("j"))
                  .unionByName(dealt.where("not tied").select("node", "rep", every("cb").alias("i"), in_u.alias("j"))))
    ties = found.where("tied and rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    return ties, sides.select(F.xxhash64("node", "i", "j").alias("node"), "rep").distinct()


def _set_task(width):
    def run(batches):
        forget()
        for batch in batches:
            found, sets = [], []
            for i, (t, sig) in enumerate(zip(_binary(batch.column("text")), batch.column("sig").to_pylist())):
                s = shingles(t.as_py() or b"", width)
                if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == sig:
                    found.append(i)
                    sets.append(s.tobytes())
            out = batch.select(["rep", "component", "blocks", "block", "n"]).take(pa.array(found, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(sets, pa.binary())], names=[*out.schema.names, "set"])
    return run


def intersections(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all pairwise intersections, over slices of the shared
    elements (an element that one set has adds nothing)."""
    element, where, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    new = np.cumsum(count > 1) - 1
    use = count[where] > 1
    row, col = row[use], new[where[use]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    n_shared = int((count > 1).sum())
    for at in range(0, n_shared, columns):
        lo, hi = np.searchsorted(col, [at, at + columns])
        m = np.zeros((len(sets), min(columns, n_shared - at)), np.float32)
        m[row[lo:hi], col[lo:hi] - at] = 1
        total += m @ m.T
    return total


def _verify_task(threshold):
    def run(batches):
        for t in groups(batches, ["component", "bi", "bj"]):
            rep, first = np.unique(t.column("rep").to_numpy(), return_index=True)    # repeated rows of one id
            if len(rep) < 2:
                continue
            sets = [np.frombuffer(t.column("set")[int(i)].as_py(), np.uint64) for i in first]
            block, n = t.column("block").to_numpy()[first], t.column("n").to_numpy()[first]
            size = np.array([len(s) for s in sets], float)
            both = intersections(sets)
            linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
            np.fill_diagonal(linked, False)
            if t.column("bi")[0].as_py() != t.column("bj")[0].as_py():
                linked &= block[:, None] != block[None, :]
            some = linked.any(1)
            root = local_roots(linked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[some]), pa.array((linked @ n)[some].astype(np.int64)), pa.array(rep[root[some]])],
                names=["rep", "links", "root"])
    return run


def candidate_links(classes: DataFrame, *, runs: int, levels: int, max_depth: int, leaf_rows: int,
                    loose: float) -> DataFrame:
    """``(a, b)`` ties between classes that share a leaf and whose sketches
    agree; one tie per class and leaf at most."""
    kind = "node long, rep long"
    frontier = materialize(classes.select("rep", "sketch").mapInArrow(tidy(_first_task(runs, levels)), kind), "path-nodes")
    leaves, ties, depth = [], [], levels
    while True:
        counts = materialize(frontier.groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("least"))
                                     .where("c > 1"), "path-counts")
        last = depth >= max_depth
        # 8 bytes a node: the frontier itself is not shuffled as long as they fit a checked broadcast
        small = broadcast_if_small(counts.where(F.col("c") <= leaf_rows).select("node"), NARROW_ROWS)
        leaves.append(frontier.join(small, "node").select("node", "rep"))
        heavy = counts.where(F.col("c") > leaf_rows)
        if heavy.isEmpty():
            break
        if last:
            tied, blocks = _heavy_nodes(frontier, heavy, classes, leaf_rows, loose)
            ties.append(tied)
            leaves.append(blocks)
            break
        again = frontier.join(broadcast_if_small(heavy.select("node")), "node")
        split = classes.select("rep", "sketch").join(broadcast_if_small(again, NARROW_ROWS), "rep")
        frontier = materialize(split.select("node", "rep", "sketch").mapInArrow(tidy(_deeper_task), kind), "path-nodes")
        depth += 1
    rows = leaves[0]
    for more in leaves[1:]:
        rows = rows.unionByName(more)
    dealt = rows.join(classes.select("rep", "small"), "rep").repartition("node").sortWithinPartitions("node")
    found = dealt.mapInArrow(tidy(_leaf_task(loose)), "a long, b long")
    for more in ties:
        found = found.unionByName(more)
    return materialize(found.distinct(), "path-ties")


def jaccard_groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8,
                   runs: int = 12, levels: int = 2, max_depth: int = 4, leaf_rows: int = 200, loose: float = 0.62,
                   block_rows: int = 256) -> DataFrame:
    """One row per document: ``key``, ``class_id`` (smallest id reachable by
    links, itself included), ``copy_id`` (smallest id with an equal set) and
    ``n_links`` (other documents at or above the threshold)."""
    ship_package(docs.sparkSession)
    named = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = materialize(named.mapInArrow(tidy(_sketch_task(width)), "key long, sig binary, size long, sketch binary"), "path-sketches")
    some = rows.where("sig is not null")
    # the low byte of each value is enough to compare sketches
    low = F.expr("concat(" + ", ".join(f"substring(sketch, {2 * i + 1}, 1)" for i in range(SKETCH)) + ")")
    classes = materialize(some.groupBy("sig").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("n"),
                                                  F.first("sketch").alias("sketch")).withColumn("small", low), "path-classes")
    ties = candidate_links(classes, runs=runs, levels=levels, max_depth=max_depth, leaf_rows=leaf_rows, loose=loose)
    member = components(ties)
    sizes = member.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    wanted = materialize(
        member.join(sizes, "component").join(classes.select(F.col("rep").alias("node"), "sig", "n"), "node")
              .select(F.col("node").alias("rep"), "component", "blocks", "sig", "n",
                      F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")), "path-wanted")
    sets = (named.join(broadcast_if_small(wanted), named["key"] == wanted["rep"])
                 .select("rep", "component", "blocks", "block", "n", "sig", "text")
                 .mapInArrow(tidy(_set_task(width)), "rep long, component long, blocks int, block int, n long, set binary"))
    dealt = (sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("component", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                         "rep", "block", "n", "set")
                 .repartition("component", "bi", "bj").sortWithinPartitions("component", "bi", "bj"))
    found = materialize(dealt.mapInArrow(tidy(_verify_task(threshold)), "rep long, links long, root long"), "path-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    result = materialize(
        classes.select("sig", "rep", "n").join(links, "rep", "left")
               .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
               .select("sig", F.col("rep").alias("copy_id"), F.coalesce("component", "rep").alias("class_id"),
                       (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "path-result")
    linked = some.select("key", "sig").join(result, "sig").select("key", "class_id", "copy_id", "n_links")
    alone = rows.where("sig is null").select("key", F.col("key").alias("class_id"), F.col("key").alias("copy_id"),
                                             F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(alone).withColumnRenamed("key", key)


def one_per_group(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document (the smallest id) of each group of linked
    documents; of repeated rows of that id one stays."""
    found = materialize(jaccard_groups(docs, key=key, text=text, **options), "path-groups")
    drop = found.where(~F.col(key).eqNullSafe(F.col("class_id"))).select(F.col(key).alias("_dk")).distinct()
    kept = docs.join(broadcast_if_small(drop), docs[key] == F.col("_dk"), "left_anti")
    again = found.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_rk")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = materialize(again.select("_rk"), "path-repeated")
    if again.isEmpty():
        return kept
    mark = broadcast_if_small(again)
    once = kept.join(mark, kept[key] == F.col("_rk"), "left_anti")
    more = kept.join(mark, kept[key] == F.col("_rk"), "left_semi").dropDuplicates([key, text])
    return once.unionByName(more)

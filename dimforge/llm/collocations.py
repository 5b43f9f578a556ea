"""Phrase collocations: frequent word n-grams that are more than their parts.

Texts are lower-cased (A-Z), split into pieces at punctuation and line ends and
those into words at blanks and tabs.  Everything is per group (a language).  A
phrase of ``min_words`` to ``max_words`` words that occurs at least
``threshold`` times is a candidate; cut after its first words it scores
``floor(10**6 * a * a / (l * r))`` (a, l, r: occurrences of phrase, first part,
rest), and its lowest-scoring cut counts.  Candidates that lie mostly inside one
longer candidate are dropped, the best of each group are returned.

Two passes over the texts:

1. *Which n-grams can be frequent.*  N-grams of one word to ``max_words`` are
   hashed; the hash names one of ``parts`` partitions and a 32-bit key in it.
   Every chunk of a task sends each partition one summary: the keys, their
   counts, and their mass.  A partition merges its summaries in Misra-Gries
   fashion (add, then subtract the value of rank ``capacity + 1`` from all).
   The capacity exceeds the partition's mass divided by the threshold, so what
   merging takes from any count is below the threshold, and every frequent
   n-gram survives.  Keys that meet in one hash only make more survive.  The
   number of partitions follows the size of the texts, so a partition's mass
   does not; an n-gram that is everywhere sends one entry per chunk.
2. *How frequent they are.*  The survivors' keys become a Bloom filter, a slice
   per partition, of at most ``FILTER_BITS`` in all (beyond it more n-grams
   pass, and the result stays exact).  N-grams that pass are told apart by
   their words, counted within the chunk and summed with a shuffle.

Counts are exact, and so are scores: products are decimals of 38 digits.

Defined results: NULL text is empty; NULL group is ``und``; repeated rows count
each; ties end by the phrase's bytes; an empty table gives an empty result; only
the text and group columns are read.

Words, phrases and counts stay distributed.  The joins of a phrase with its parts
shuffle by the part (AQE splits a part that is in very many phrases); the best of
a group are found per salted slice first.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.chosen_path import mix
from dimforge.llm.storage import forget, materialize, release, ship_package, tidy

CHUNK = 600_000              # words; below 2**21, so that three word numbers fit 64 bits
PART_BYTES = 6_000_000       # of texts per partition of the n-grams
MERGED = 1_000_000           # counters that are merged at once
FILTER_BITS = 1 << 28
PROBES = 3
BREAK = b"."                 # no word holds it
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)


def tokens(data: bytes) -> list[bytes]:
    """Words, with a BREAK between pieces and one at the end."""
    ws = data.lower().translate(_BREAKS).replace(BREAK, b" . ").split()
    ws.append(BREAK)
    return ws


class Chunk:
    """The words of some texts as numbers; words of different groups differ."""

    def __init__(self):
        self.next = count(1)                                       # 0 is the break
        self.numbers: dict = {}
        self.parts, self.n = [], 0

    def add(self, group: str, data: bytes) -> None:
        known = self.numbers.get(group)
        if known is None:
            known = self.numbers[group] = _Numbers(self.next)
        ws = tokens(data)
        self.parts.append(np.fromiter(map(known.__getitem__, ws), np.int64, len(ws)))
        self.n += len(ws)

    def close(self) -> None:
        """Words, groups and hashes by number."""
        size = next(self.next)
        self.ids = np.concatenate(self.parts)
        self.word, self.group = [b""] * size, np.zeros(size, np.int64)
        self.groups = list(self.numbers)
        for g, group in enumerate(self.groups):
            for w, i in self.numbers[group].items():
                if i:
                    self.word[i] = w
                    self.group[i] = g
        seeds = [xxhash.xxh3_64_intdigest(g.encode()) for g in self.groups]
        self.hash = np.fromiter(map(xxhash.xxh3_64_intdigest, self.word), np.uint64, size)
        self.hash = mix(self.hash ^ np.array(seeds, np.uint64)[self.group])

    def totals(self) -> np.ndarray:
        """Words per group."""
        return np.bincount(self.group[self.ids[self.ids > 0]], minlength=len(self.groups))

    def grams(self, longest: int):
        """Per length: the distinct n-grams as rows of word numbers, their
        counts and hashes."""
        ids, size = self.ids, len(self.word)
        key, inside = ids, ids > 0
        for n in range(1, longest + 1):
            if n > 1:
                if n > 3:                                          # three numbers fit 64 bits, more do not
                    key = np.unique(key, return_inverse=True)[1]
                key = key[:-1] * size + ids[n - 1:]
                inside = inside[:-1] & (ids[n - 1:] > 0)
            at = np.flatnonzero(inside)
            if not len(at):
                return
            order = at[np.argsort(key[at])]
            ordered = key[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            del ordered
            words = ids[order[first][:, None] + np.arange(n)].astype(np.int32)
            h = self.hash[words[:, 0]]
            with np.errstate(over="ignore"):
                for k in range(1, n):
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + self.hash[words[:, k]])
            yield words, np.diff(np.append(first, len(order))), h


class _Numbers(dict):
    """Numbers words as they come."""

    def __init__(self, numbers):
        super().__init__({BREAK: 0})
        self.numbers = numbers

    def __missing__(self, word):
        number = self[word] = next(self.numbers)
        return number


def _chunks(batches):
    forget()
    chunk = Chunk()
    for batch in batches:
        for group, t in zip(batch.column("grp").to_pylist(), batch.column("text")):
            chunk.add(group, t.as_py() or b"")
            if chunk.n >= CHUNK:
                chunk.close()
                yield chunk
                chunk = Chunk()
    if chunk.n:
        chunk.close()
        yield chunk


def place(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Partition and 32-bit key of a hash."""
    return ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int32), h.astype(np.uint32)


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class MisraGries:
    """A summary of at most ``capacity`` counters.  The true count of a key lies
    between its counter (0 if absent) and that plus ``error``, and ``error`` is
    at most the mass divided by ``capacity + 1``."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, keys: list[np.ndarray], counts: list[np.ndarray], error: int = 0) -> None:
        """Several summaries at once, with the sum of their errors."""
        self.keys, self.counts = add_up(np.concatenate([self.keys, *keys]), np.concatenate([self.counts, *counts]))
        self.error += error
        if len(self.keys) > self.capacity:
            at = len(self.counts) - 1 - self.capacity
            less = int(np.partition(self.counts, at)[at])          # the value of rank capacity + 1
            keep = self.counts > less
            self.keys, self.counts, self.error = self.keys[keep], self.counts[keep] - less, self.error + less

    def may_reach(self, threshold: int) -> np.ndarray:
        """Keys whose true count can be ``threshold``: all that have it, as
        long as the error is below it."""
        return self.keys[self.counts + self.error >= threshold]


def _pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Keys, one byte per count, and in full the counts that do not fit it."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return keys.tobytes(), small.tobytes(), counts[counts >= 255].astype("<i8").tobytes()


def _unpack(keys: bytes, small: bytes, large: bytes) -> tuple[np.ndarray, np.ndarray]:
    counts = np.frombuffer(small, np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(large, "<i8")
    return np.frombuffer(keys, np.uint32), counts


def _summaries(parts: int, longest: int):
    def run(batches):
        for chunk in _chunks(batches):
            found = [(*place(h, parts), c.astype(np.int32)) for _, c, h in chunk.grams(longest)]
            if not found:
                continue
            part, key, counts = map(np.concatenate, zip(*found))
            del found, chunk
            order = np.argsort(part, kind="stable")
            part, key, counts = part[order], key[order], counts[order]
            some, first = np.unique(part, return_index=True)
            edges = np.append(first, len(part))
            rows = [_pack(*add_up(key[a:b], counts[a:b])) for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int64)), pa.array(np.add.reduceat(counts, first, dtype=np.int64)), *(pa.array(c, pa.binary()) for c in zip(*rows))],
                names=["part", "mass", "keys", "small", "large"])
    return run


def _survivors(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        mass = int(np.sum(table.column("mass").to_numpy()))
        summary = MisraGries(mass // threshold + 1)
        held, n = [], 0
        for k, s, g in zip(*(table.column(c) for c in ("keys", "small", "large"))):
            held.append(_unpack(k.as_py(), s.as_py(), g.as_py()))
            n += len(held[-1][0])
            if n > MERGED:
                summary.merge(*zip(*held))
                held, n = [], 0
        if held:
            summary.merge(*zip(*held))
        assert summary.error < threshold
        left = summary.may_reach(threshold)
        del held, summary
        release()
        return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int64()), "n": pa.array([len(left)], pa.int64()),
                         "keys": pa.array([left.tobytes()], pa.binary())})
    return run


def probes(part: np.ndarray, key: np.ndarray, width: int):
    """Bit positions of keys in the filter; ``width`` bits per partition."""
    base = part.astype(np.uint64) * np.uint64(width)
    for k in range(PROBES):
        yield base + mix(key.astype(np.uint64) + np.uint64((k + 1) << 32)) % np.uint64(width)


def _slices(width: int):
    def run(batches):
        for batch in batches:
            part, out = batch.column("part").to_pylist(), []
            for raw in batch.column("keys"):
                bits, key = np.zeros(width, np.uint8), np.frombuffer(raw.as_py(), np.uint32)
                for at in probes(np.zeros(len(key), np.uint64), key, width):
                    bits[at.astype(np.int64)] = 1
                out.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(out, pa.binary())], names=["part", "bits"])
    return run


def survivors_filter(survivors: DataFrame, parts: int) -> tuple[np.ndarray, int]:
    """The Bloom filter of all survivors, at most ``FILTER_BITS`` and a byte per
    partition, and its bits per partition."""
    n = survivors.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    width = 8 * max(1, min(12 * n, FILTER_BITS // parts) // 8)
    bits = np.zeros(parts * width // 8, np.uint8)
    for batch in survivors.mapInArrow(tidy(_slices(width)), "part long, bits binary").toArrow().to_batches():
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("bits")):
            bits[part * width // 8:(part + 1) * width // 8] = np.frombuffer(raw.as_py(), np.uint8)
    return bits, width


def _exact(shared, parts: int, longest: int):
    """Counts per chunk of the n-grams that pass the filter (a superset of the
    frequent ones), and the words of each group (``words`` 0)."""
    def run(batches):
        bits, width = shared.value
        for chunk in _chunks(batches):
            groups = pa.array(chunk.groups, pa.string())
            yield pa.RecordBatch.from_arrays(
                [groups, pa.array([0] * len(groups), pa.int32()), pa.array([""] * len(groups), pa.string()),
                 pa.array(chunk.totals())], names=["grp", "words", "phrase", "c"])
            for words, counts, h in chunk.grams(longest):
                part, key = place(h, parts)
                passed = np.ones(len(h), bool)
                for at in probes(part, key, width):
                    passed &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                words, counts = words[passed], counts[passed]
                spelled = [b" ".join([chunk.word[i] for i in row]) for row in words.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [groups.take(pa.array(chunk.group[words[:, 0]])), pa.array([words.shape[1]] * len(words), pa.int32()),
                     pa.array(spelled, pa.binary()).cast(pa.string()), pa.array(counts)],
                    names=["grp", "words", "phrase", "c"])
    return run


def frequent(docs: DataFrame, *, text: str = "text", group: str = "lang", max_words: int = 3,
             threshold: int = 10) -> DataFrame:
    """``grp, words, phrase, f``: exact counts of all n-grams of one word to
    ``max_words`` that occur at least ``threshold`` times in their group, and
    per group a row of 0 words with the number of its words."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.coalesce(F.col(group), F.lit("und")).alias("grp"), F.col(text).cast("binary").alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    parts = 1 + size // PART_BYTES
    made = rows.mapInArrow(tidy(_summaries(parts, max_words)), "part long, mass long, keys binary, small binary, large binary")
    kept = materialize(made.groupBy("part").applyInArrow(_survivors(threshold), "part long, n long, keys binary"), "phrases-survivors")
    shared = spark.sparkContext.broadcast(survivors_filter(kept, parts))
    counted = rows.mapInArrow(tidy(_exact(shared, parts, max_words)), "grp string, words int, phrase string, c long")
    total = counted.groupBy("grp", "words", "phrase").agg(F.sum("c").alias("f"))
    return materialize(total.where((F.col("words") == 0) | (F.col("f") >= threshold)), "phrases-frequent")


def _scored(found: DataFrame, min_words: int) -> DataFrame:
    """Candidates with the parts of their lowest-scoring cut (the first of
    several): ``grp, phrase, a, l, r, score``."""
    candidates = found.where(F.col("words") >= max(2, min_words))
    w = F.split("phrase", " ")
    cuts = (candidates.select("grp", "phrase", "words", F.col("f").alias("a"),
                              F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
                      .select("grp", "phrase", "a", "k", F.array_join(F.slice(w, F.lit(1), F.col("k")), " ").alias("left"),
                              F.array_join(F.slice(w, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right")))
    part = found.where("words > 0")
    cuts = (cuts.join(part.select("grp", F.col("phrase").alias("left"), F.col("f").alias("l")), ["grp", "left"])
                .join(part.select("grp", F.col("phrase").alias("right"), F.col("f").alias("r")), ["grp", "right"]))
    # up to 10**16 occurrences of a phrase and 10**19 of a part: products of 38 digits are exact
    score = F.expr("1000000BD * cast(a as decimal(16,0)) * cast(a as decimal(16,0)) "
                   "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cuts.withColumn("score", score).groupBy("grp", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("grp", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _absorbed(found: DataFrame, min_words: int) -> DataFrame:
    """Per phrase the highest count of a longer candidate that holds it:
    ``grp, phrase, longer``."""
    low = max(2, min_words)
    w, size = F.split("phrase", " "), F.col("size")
    inside = (found.where(F.col("words") > low)
                   .select("grp", "phrase", "words", "f", F.explode(F.sequence(F.lit(low), F.col("words") - 1)).alias("size"))
                   .select("grp", "phrase", "f", "size", F.explode(F.sequence(F.lit(1), F.col("words") - size + 1)).alias("at")))
    return (inside.select("grp", F.array_join(F.slice(w, F.col("at"), size), " ").alias("phrase"), "f")
                  .groupBy("grp", "phrase").agg(F.max("f").alias("longer")))


def mine(docs: DataFrame, *, text: str = "text", group: str = "lang", min_words: int = 2, max_words: int = 3,
         threshold: int = 10, absorb_percent: int = 50, top: int = 2000) -> DataFrame:
    """The best ``top`` phrases of each group: ``grp, rank, phrase, a, l, r, n,
    score``, by score and count descending, then the phrase's bytes."""
    found = frequent(docs, text=text, group=group, max_words=max_words, threshold=threshold)
    kept = _scored(found, min_words).join(_absorbed(found, min_words), ["grp", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < absorb_percent * F.col("a")))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    slices = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(32)))
    slices = slices.withColumn("rank", F.row_number().over(Window.partitionBy("grp", "slice").orderBy(*order)))
    ranked = slices.where(F.col("rank") <= top).withColumn(                 # at most 32 * top rows a group
        "rank", F.row_number().over(Window.partitionBy("grp").orderBy(*order))).where(F.col("rank") <= top)
    totals = found.where("words = 0").select("grp", F.col("f").alias("n"))
    return ranked.join(totals, "grp").select("grp", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

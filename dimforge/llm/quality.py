"""Quality classifier from weak labels.

Labellers vote on every document (bad, good, or no opinion), in two heads:
junk and toxic.  Most are heuristics on the text; judgements from a table are
one more labeller, whose accuracy is estimated like any other's.  The votes of
all documents are counted by pattern; expectation-maximisation on the pattern
counts estimates each labeller's accuracy and the share of bad documents, which
gives every pattern a posterior probability.

A sample of at most about ``sample`` documents, judged ones first (two thirds
at most) and a hash sample of the rest, is labelled by these posteriors, and a
hashed linear scorer is fitted to it per head (logistic loss, L1 penalty by
coordinate descent, so that the many rare words of a long text carry no
weight).  A document weighs what its votes tell: 1 for a certain posterior, 0
for one that is as uncertain as the class shares; beside judgements, all
unjudged documents together weigh at most half as much as the judged ones (or
``UNJUDGED`` documents, if that is more), since the heuristics are silent on what
only judges know.  The scorer, not the votes,
decides: a document is kept if both scores are below ``threshold``.

Whole texts are read, in two passes, and never shuffled.  Pattern counts are
bounded by 3 to the number of labellers, the model by the sample: one document
per judged id and one per sampled text, chosen before features leave Spark.

Defined results: NULL and empty texts draw no votes and are kept unless the
model says otherwise; repeated rows are judged separately and alike, and trained
on once; an id judged twice takes the worse judgement; a NULL judgement is no
opinion; judgements that are empty or of no document's id change nothing
(as without the table); an empty table gives an empty result; the added columns
replace clashing input columns.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimforge.llm.storage import forget, materialize, ship_package, tidy

BAD, GOOD, NONE = 1, 0, -1
SAMPLE = 12_000
JUDGED = 2 / 3               # of the sample, at most
UNJUDGED = 500
ADDED = ("junk_score", "toxic_score", "keep")

# Insults, in overlapping lists, one labeller each.
INSULTS = {
    "mind": ("idiot", "stupid", "moron", "dumb", "imbecile", "clown", "fool"),
    "waste": ("trash", "garbage", "scum", "filth", "vermin", "worthless", "disgusting"),
    "rank": ("loser", "pathetic", "worthless", "clown", "failure", "useless"),
    "scorn": ("pathetic", "disgusting", "stupid", "trash", "scum", "ugly", "jerk"),
}
_SYMBOLS = b"|*#$%&!@^~<>{}[]\\/=+_"
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC3, 0xF5))
_UPPER = bytes(range(65, 91))
_SPACE = b" \t\n\r\x0b\x0c"
# lower-cased words without punctuation
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# character classes of a token's shape
_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))

_RUNS = [(c, re.compile(re.escape(c) + b"{2,}")) for c in (b"a", b"A", b"0")]


def _count(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def _vote(value: float, bad: float, good: float) -> int:
    """Bad at or beyond ``bad``, good at or below ``good``."""
    return BAD if value >= bad else GOOD if value <= good else NONE


class Text:
    """What labellers and scorer look at."""

    def __init__(self, data: bytes):
        self.data = data
        self.raw = data.split()
        self.n = len(self.raw)
        self.words = set(data.translate(_WORDS).split())
        self.solid = max(1, len(data) - _count(data, _SPACE))
        self.symbols = _count(data, _SYMBOLS) / self.solid
        letters = max(1, _count(data, _LETTERS))
        self.upper = _count(data, _UPPER) / letters
        n = max(1, self.n)
        self.repeats = sum(map(operator.eq, self.raw, self.raw[1:])) / n
        self.variety = len(set(self.raw)) / n
        self.bangs = data.count(b"!") / n
        self.short = sum(len(w) == 1 for w in self.raw) / n
        self.odd = sum(w[-1] in _SYMBOLS for w in self.raw) / n

    def junk_votes(self) -> list[int]:
        """Detectors of one kind of junk say bad or nothing; the last two also
        know what good prose looks like."""
        if self.n < 5:
            return [NONE] * 8
        bad = [self.symbols > 0.06, self.upper > 0.5, self.odd > 0.3, self.repeats > 0.2,
               self.variety < (0.15 if self.n < 5000 else 0.08), self.bangs > 0.2, self.short > 0.25]
        votes = [BAD if x else NONE for x in bad]
        ends = sum(w[-1:] in (b".", b"?") for w in self.raw) / self.n
        votes.append(GOOD if 0.02 < ends < 0.4 and self.symbols < 0.01 and self.repeats < 0.05 and self.upper < 0.2 else NONE)
        return votes

    def toxic_votes(self) -> list[int]:
        hits = [sum(w.encode() in self.words for w in ws) for ws in INSULTS.values()]
        every = len({w for ws in INSULTS.values() for w in ws if w.encode() in self.words})
        return [*(BAD if x else NONE for x in hits), BAD if every > 1 else NONE if every or not self.n else GOOD]

    def features(self) -> np.ndarray:
        """Hashed features: words and word beginnings present, and how common
        each coarse token shape, doubling and lack of variety are (in tenths)."""
        if not self.n:
            return np.zeros(0, np.uint32)
        coarse = self.data.translate(_SHAPE)
        for once, many in _RUNS:
            coarse = many.sub(once, coarse)
        shapes, n = Counter(coarse.split()), self.n
        marks = [b"s:%s:%d" % (s, 10 * c // n) for s, c in shapes.items() if 10 * c >= n]
        marks += [b"r:%d" % int(10 * self.repeats), b"v:%d" % int(10 * self.variety),
                  b"u:%d" % int(10 * self.upper), b"y:%d" % int(10 * min(1, self.symbols))]
        begins = {w[:4] for w in self.words} | {w[:5] for w in self.words}
        return np.fromiter(map(zlib.crc32, [*self.words, *map(b" ".__add__, begins), *marks]), np.uint32)


def _texts(batch, text: str):
    column = batch.column(text)
    for t in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield Text(t.as_py() or b"")


HEADS = ("junk", "toxic")


def _votes(batches):
    """Vote patterns with their counts, and the features of chosen documents
    (with their two patterns joined), one per id or text and batch."""
    forget()
    for batch in batches:
        seen, chosen = Counter(), {}
        extra = [batch.column(c).to_pylist() for c in ("chosen", "hash", "junk", "toxic")]
        for x, pick, h, junk, toxic in zip(_texts(batch, "text"), *extra):
            j, t = (*x.junk_votes(), junk), (*x.toxic_votes(), toxic)
            seen["junk", j] += 1
            seen["toxic", t] += 1
            if pick is not None and (pick not in chosen or h < chosen[pick][0]):
                chosen[pick] = h, j + t, x.features().tobytes()
        votes = [list(v) for _, v in seen] + [list(v) for _, v, _ in chosen.values()]
        yield pa.RecordBatch.from_pydict({
            "head": pa.array([h for h, _ in seen] + ["both"] * len(chosen), pa.string()),
            "votes": pa.array(votes, pa.list_(pa.int64())),
            "n": pa.array([*seen.values()] + [1] * len(chosen), pa.int64()),
            "chosen": pa.array([None] * len(seen) + list(chosen), pa.string()),
            "hash": pa.array([None] * len(seen) + [h for h, _, _ in chosen.values()], pa.int64()),
            "features": pa.array([None] * len(seen) + [f for _, _, f in chosen.values()], pa.binary())})


# Rates at which a labeller has no opinion, says good, says bad: of good and of
# bad documents.  EM starts from them.
DETECTOR = ((0.6, 0.39, 0.01), (0.6, 0.05, 0.35))
WORD_LIST = ((0.3, 0.69, 0.01), (0.3, 0.35, 0.35))         # says good of texts without the words it knows
JUDGE = ((0.6, 0.398, 0.002), (0.6, 0.002, 0.398))
STARTS = {"junk": {-1: JUDGE}, "toxic": {-1: JUDGE, -2: WORD_LIST}}


class LabelModel:
    """Two-class EM over vote patterns.  Labellers are conditionally
    independent given the class; "no opinion" lowers a labeller's rate of
    votes but is no evidence itself (detectors are silent together).
    Pseudo-counts (``strength`` documents) start every labeller better than
    chance, so the bad class stays the bad one; from there the votes decide,
    for judgements as for heuristics."""

    def __init__(self, votes: np.ndarray, n: np.ndarray, starts: dict | None = None, rounds: int = 50,
                 strength: float = 20.0):
        seen = np.stack([votes == NONE, votes == GOOD, votes == BAD], 2).astype(float)   # pattern, labeller, outcome
        p = np.repeat(np.array(DETECTOR)[:, None], votes.shape[1], 1)                    # class, labeller, outcome
        for labeller, rates in (starts or {}).items():
            p[:, labeller] = rates
        prior = strength * p
        share = np.array([0.9, 0.1])
        for _ in range(rounds):
            post = self._posterior(seen, p, share)
            weight = post * n[:, None]
            share = (weight.sum(0) + np.array([9.0, 1.0])) / (n.sum() + 10.0)
            p = np.einsum("pc,pko->cko", weight, seen) + prior
            p /= p.sum(2, keepdims=True)
        self.outcome, self.share = p, share
        self.accuracy = p[1, :, 2] / (p[1, :, 2] + p[0, :, 2])
        self.of = {tuple(v): float(b) for v, b in zip(votes.tolist(), self._posterior(seen, p, share)[:, 1])}

    def weight(self, posterior: np.ndarray) -> np.ndarray:
        """What is known beyond the class shares: 1 minus the ratio of
        entropies, 0 at least."""
        return np.clip(1 - _entropy(posterior) / _entropy(self.share[1]), 0.0, 1.0)

    @staticmethod
    def _posterior(seen, p, share):
        log = np.einsum("pko,cko->pc", seen[:, :, 1:], np.log(p[:, :, 1:])) + np.log(share)
        log -= log.max(1, keepdims=True)
        e = np.exp(log)
        return e / e.sum(1, keepdims=True)


def _entropy(p):
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return -(p * np.log(p) + (1 - p) * np.log(1 - p))


class Scorer:
    """Hashed linear scorer: bias and the non-zero weights."""

    def __init__(self, docs: list[bytes], y: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1e-3,
                 rounds: int = 60):
        size = max(1, len(docs))
        weight = np.ones(len(docs)) if weight is None else weight
        n = float(weight.sum())
        mean = float(np.clip((y * weight).sum() / n if n > 0 else 0.0, 1e-4, 1 - 1e-4))
        self.bias, self.weights = float(np.log(mean / (1 - mean))), {}
        if n <= 0:
            return
        hashed = np.frombuffer(b"".join(docs), np.uint32)
        row = np.repeat(np.arange(len(docs), dtype=np.int32), [len(d) // 4 for d in docs])
        # features whose gradient at zero stays below the penalty keep weight 0;
        # the gradient cannot exceed the share of documents that have the feature
        feature, count = np.unique(hashed, return_counts=True)
        feature = feature[count > penalty / 2 * n]          # no document weighs more than 1
        at = np.minimum(np.searchsorted(feature, hashed), max(0, len(feature) - 1)).astype(np.int32)
        use = feature[at] == hashed if len(feature) else np.zeros(len(hashed), bool)
        row, at = row[use], at[use]
        start = np.bincount(at, ((mean - y) * weight)[row], len(feature)) / n
        live = np.flatnonzero(np.abs(start) > penalty / 2)
        new = np.full(len(feature), -1, np.int32)
        new[live] = np.arange(len(live))
        use = new[at] >= 0
        row, col = row[use], new[at[use]]
        order = np.argsort(col, kind="stable")
        columns = np.split(row[order], np.cumsum(np.bincount(col, minlength=len(live)))[:-1])
        w, b = np.zeros(len(live)), self.bias
        margin = np.full(size, b)
        for strength in (penalty, penalty / 10):            # select features, then fit them with less shrinkage
            everything = np.arange(len(live)) if strength == penalty else np.flatnonzero(w)
            active = everything
            for _ in range(rounds):
                largest = 0.0
                for j in (-1, *active.tolist()):
                    rows = columns[j] if j >= 0 else slice(None)
                    residual = (1 / (1 + np.exp(-np.clip(margin[rows], -30, 30))) - y[rows]) * weight[rows]
                    curve = 0.25 * weight[rows].sum() / n            # bound of the second derivative
                    if curve <= 0:
                        continue
                    old = b if j < 0 else w[j]
                    new = old - residual.sum() / n / curve
                    if j >= 0:
                        new = np.sign(new) * max(abs(new) - strength / curve, 0.0)
                    if new != old:
                        margin[rows] += new - old
                        largest = max(largest, abs(new - old))
                        if j < 0:
                            b = new
                        else:
                            w[j] = new
                # sweep the non-zero weights until they settle, then all once more
                settled = largest < 1e-3
                if settled and len(active) == len(everything):
                    break
                active = everything if settled else np.flatnonzero(w)
        self.bias = float(b)
        self.weights = {int(feature[live[j]]): float(w[j]) for j in np.flatnonzero(w)}

    def __call__(self, features: np.ndarray) -> float:
        get = self.weights.get
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(get(f, 0.0) for f in features.tolist()), -30, 30))))


def _judgements(labels: DataFrame, key: str, most: int) -> DataFrame:
    """``lk, junk, toxic`` of a hash sample of at most ``most`` judged ids."""
    vote = lambda c: F.coalesce(c.cast("long"), F.lit(NONE).cast("long"))
    return (labels.select(F.col(key).alias("lk"), "quality", "toxic").where("lk is not null")
                  .groupBy("lk").agg(vote(1 - F.min("quality")).alias("junk"), vote(F.max("toxic")).alias("toxic"))
                  .orderBy(F.xxhash64("lk"), "lk").limit(most))


def fit(docs: DataFrame, labels: DataFrame | None = None, *, text: str = "text", key: str = "doc_id",
        sample: int = SAMPLE) -> dict:
    """Label models and scorers of both heads.  ``labels``: judgements ``(key,
    quality, toxic)``, of which at most two thirds of ``sample`` are used."""
    spark = docs.sparkSession
    ship_package(spark)
    only = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    none, matched = F.lit(NONE).cast("long"), 0
    total = max(1, docs.count())
    if labels is not None:
        judged = materialize(_judgements(labels, key, int(JUDGED * sample)), "quality-judged")
        matched = (docs.select(F.col(key).alias("lk")).join(F.broadcast(judged.select("lk")), "lk", "left_semi")
                       .distinct().count())
    share = min(1.0, (sample - matched) / total)
    drawn = F.when(F.pmod("hash", F.lit(1 << 30)) < share * (1 << 30), F.concat(F.lit("text "), F.col("hash").cast("string")))
    if matched:
        joined = only.join(F.broadcast(judged), F.col("key") == F.col("lk"), "left")    # fewer rows than `sample`
        chosen = F.when(F.col("lk").isNotNull(), F.concat(F.lit("id "), F.col("lk").cast("string"))).otherwise(drawn)
        rows = joined.select("text", "hash", chosen.alias("chosen"), F.coalesce("junk", none).alias("junk"),
                             F.coalesce("toxic", none).alias("toxic"))
    else:
        rows = only.select("text", "hash", drawn.alias("chosen"), none.alias("junk"), none.alias("toxic"))
    raw = materialize(rows.mapInArrow(tidy(_votes), "head string, votes array<long>, n long, chosen string, hash long, "
                                                    "features binary"), "quality-votes")
    counted = raw.where("head <> 'both'").groupBy("head", "votes").agg(F.sum("n").alias("n")).collect()
    one = raw.where("head = 'both'").groupBy("chosen").agg(F.min_by(F.struct("votes", "features"), "hash").alias("x"))
    got = one.select("x.votes", "x.features").toArrow()                              # about `sample` rows
    # a fixed order: the sums of the fit do not depend on how rows arrive
    chosen = sorted(zip(got.column("features").to_pylist(), map(tuple, got.column("votes").to_pylist())))
    del got
    model, width = {}, 0
    for head in HEADS:
        patterns = sorted((tuple(r["votes"]), r["n"]) for r in counted if r["head"] == head)
        if not patterns:
            model[head], model[head + "_scorer"] = None, Scorer([], np.zeros(0))
            continue
        m = LabelModel(np.array([v for v, _ in patterns]), np.array([n for _, n in patterns], float), STARTS[head])
        k = len(patterns[0][0])
        y = np.array([m.of[v[width:width + k]] for _, v in chosen])
        judged_rows = np.array([v[width + k - 1] != NONE for _, v in chosen], bool)
        width += k
        n_judged, n_other = int(judged_rows.sum()), int((~judged_rows).sum())
        part = min(1.0, max(UNJUDGED, n_judged / 2) / max(1, n_other)) if n_judged else 1.0
        model[head] = m
        model[head + "_scorer"] = Scorer([f for f, _ in chosen], y, m.weight(y) * np.where(judged_rows, 1.0, part))
    return model


def classify(docs: DataFrame, labels: DataFrame | None = None, *, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, threshold: float = 0.5,
             sample: int = SAMPLE, only_kept: bool = False) -> DataFrame:
    """The ``keep`` columns (all by default) plus ``junk_score``,
    ``toxic_score`` and ``keep``.  ``only_kept`` returns just the kept rows,
    without the added columns."""
    keep = [c for c in (keep or docs.columns) if only_kept or c not in ADDED]
    model = fit(docs, labels, text=text, key=key, sample=sample)
    shared = docs.sparkSession.sparkContext.broadcast((model["junk_scorer"], model["toxic_scorer"]))
    source = docs.select(*dict.fromkeys([*keep, text]))
    fields = [source.schema[c] for c in keep]
    if not only_kept:
        fields += [T.StructField("junk_score", T.DoubleType()), T.StructField("toxic_score", T.DoubleType()),
                   T.StructField("keep", T.BooleanType())]

    def run(batches):
        forget()
        junk, toxic = shared.value
        for batch in batches:
            found = [x.features() for x in _texts(batch, text)]
            j, t = np.array([junk(f) for f in found]), np.array([toxic(f) for f in found])
            good = pa.array((j < threshold) & (t < threshold), pa.bool_())
            out = batch.select(keep)
            if only_kept:
                yield out.filter(good)
            else:
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(j, pa.float64()), pa.array(t, pa.float64()), good],
                                                 names=[*keep, *ADDED])

    return source.mapInArrow(tidy(run), T.StructType(fields))

"""Links that must not be lost, unrelated texts that must not meet, and what the
label model makes of judgements."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dimforge.llm import chosen_path, embeddings, quality

N = quality.NONE


# --- n-gram Jaccard join ------------------------------------------------------------

def test_sketches_of_unrelated_large_sets_differ():
    rng = np.random.default_rng(1)
    for size in (10_000, 200_000):
        a, b = (chosen_path.sketch(np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))) for _ in range(2))
        assert (a == b).mean() < 0.01 and ((a & 255) == (b & 255)).mean() < 0.05


def family(size, seed=2):
    """Texts that share half their words, in pairs of near copies."""
    rng = random.Random(seed)
    shared = [f"s{i}" for i in range(120)]
    rows = []
    for i in range(size):
        own = [f"o{i}x{j}" for j in range(60)]
        rows.append((2 * i, " ".join(shared + own)))
        own[rng.randrange(len(own))] = "changed"
        rows.append((2 * i + 1, " ".join(shared + own)))
    return rows


def brute_groups(rows, threshold=0.8):
    sets = {k: set(chosen_path.shingles(t.encode()).tolist()) for k, t in rows}
    links = {k: [j for j in sets if j != k and len(sets[k] & sets[j]) >= threshold * len(sets[k] | sets[j]) - 1e-9] for k in sets}
    out = {}
    for k in sorted(sets):
        if k not in out:
            todo, group = [k], set()
            while todo:
                x = todo.pop()
                if x not in group:
                    group.add(x)
                    todo += links[x]
            out.update((x, (min(group), len(links[x]))) for x in group)
    return out


@pytest.mark.parametrize("options", [{"leaf_rows": 8, "max_depth": 2, "runs": 3}, {"leaf_rows": 6, "max_depth": 3, "runs": 12}])
def test_heavy_last_nodes_are_compared_completely(spark, options):
    rows = family(70)
    got = chosen_path.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute_groups(rows)


def test_every_pair_of_a_heavy_node_meets_unless_both_agree_with_its_head(spark):
    rng = np.random.default_rng(3)
    n = 60
    sketches = rng.integers(0, 256, (n, chosen_path.SKETCH)).astype(np.uint8)
    sketches[:20] = sketches[0]                                        # tie to the smallest member
    classes = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sketches)], "rep long, small binary")
    frontier = spark.createDataFrame([(7, i) for i in range(n)], "node long, rep long")
    heavy = spark.createDataFrame([(7, n, 0)], "node long, c long, least long")
    ties, leaves = chosen_path._heavy_nodes(frontier, heavy, classes, 10, 0.62)
    assert {(r.a, r.b) for r in ties.collect()} == {(i, 0) for i in range(1, 20)}
    met, at = set(), {}
    for r in leaves.collect():
        at.setdefault(r.node, []).append(r.rep)
    for members in at.values():
        met |= {(a, b) for a in members for b in members if a < b}
    assert {(a, b) for a in range(n) for b in range(a + 1, n) if b >= 20} <= met


# --- embeddings ---------------------------------------------------------------------

def compared(cell, rows):
    frame = pd.DataFrame([{"rep": i, "n": 1, "vec": v, "cells": np.array(c), "home": c[0], "cell": cell, "bi": 0, "bj": 0, "block": 0}
                          for i, (v, c) in enumerate(rows)])
    return dict(embeddings._compare(0.93)(frame)[["rep", "links"]].itertuples(index=False))


def test_two_guests_of_a_cell_are_linked_there():
    a, b = [1.0, 0.28], [1.0, 0.0]                                     # cosine 0.963
    assert compared(1, [(a, [0, 1]), (b, [1, 2])]) == {0: 1, 1: 1}


def test_a_pair_counts_in_the_smallest_cell_that_both_share():
    a, b = [1.0, 0.1], [1.0, 0.0]
    assert compared(1, [(a, [1, 4]), (b, [1, 4])]) == {0: 1, 1: 1}
    assert compared(4, [(a, [1, 4]), (b, [1, 4])]) == {}
    assert compared(4, [(a, [1, 4]), (b, [2, 4])]) == {0: 1, 1: 1}


# --- quality ---------------------------------------------------------------------------

def plain_em(votes, starts, rounds=50, strength=20.0):
    """The same model, document by document."""
    k = len(votes[0])
    rate = [[list(quality.DETECTOR[c]) for _ in range(k)] for c in (0, 1)]
    for j, rows in starts.items():
        for c in (0, 1):
            rate[c][j] = list(rows[c])
    prior = [[[strength * x for x in r] for r in rate[c]] for c in (0, 1)]
    share, column = [0.9, 0.1], {N: 0, quality.GOOD: 1, quality.BAD: 2}

    def posterior(v):
        log = [math.log(share[c]) + sum(math.log(rate[c][j][column[x]]) for j, x in enumerate(v) if x != N) for c in (0, 1)]
        return 1 / (1 + math.exp(log[0] - log[1]))

    for _ in range(rounds):
        post = [posterior(v) for v in votes]
        share = [(sum(1 - p for p in post) + 9) / (len(votes) + 10), (sum(post) + 1) / (len(votes) + 10)]
        for c in (0, 1):
            for j in range(k):
                seen = list(prior[c][j])
                for v, p in zip(votes, post):
                    seen[column[v[j]]] += p if c else 1 - p
                rate[c][j] = [x / sum(seen) for x in seen]
    return [posterior(v) for v in votes], share


def some_votes(n=300, wrong=0.1, seed=6):
    """Three detectors, the last of which also says good, and a judge of half
    the documents who errs."""
    rng = random.Random(seed)
    bad, votes = [], []
    for _ in range(n):
        b = rng.random() < 0.25
        v = [quality.BAD if rng.random() < (0.8 if b else 0.03) else N for _ in range(3)]
        if v[2] == N and rng.random() < 0.9:
            v[2] = quality.GOOD
        judged = (b != (rng.random() < wrong)) if rng.random() < 0.5 else None
        bad.append(b)
        votes.append((*v, N if judged is None else int(judged)))
    return bad, votes


def model_of(votes, starts):
    patterns, n = np.unique(np.array(votes), axis=0, return_counts=True)
    return quality.LabelModel(patterns, n.astype(float), starts)


def test_label_model_equals_plain_em():
    _, votes = some_votes()
    starts = {-1: quality.JUDGE, -2: quality.WORD_LIST}
    post, share = plain_em(votes, starts)
    m = model_of(votes, starts)
    assert m.share[1] == pytest.approx(share[1], abs=1e-9)
    assert [m.of[v] for v in votes] == pytest.approx(post, abs=1e-9)


def test_heuristics_can_overrule_a_judgement():
    _, votes = some_votes(4000)
    m = model_of(votes, {-1: quality.JUDGE})
    assert m.of[1, 1, 1, 0] > 0.5 and m.of[N, N, 0, 0] < 0.5          # a judge who errs in one of ten
    missed, found = m.outcome[1, -1, 1:]
    assert missed / (missed + found) > 0.03                            # its start: 0.005


def test_judgements_are_believed_where_detectors_are_blind():
    rng = random.Random(8)
    votes = []
    for i in range(4000):
        hidden, listed = i % 20 == 0, i % 20 == 1                       # no list knows the words of hidden ones
        judged = int(hidden or listed) if rng.random() < 0.4 else N
        votes.append((1, 1, 1, judged) if listed else (N, N, quality.GOOD, judged))
    m = model_of(votes, {-1: quality.JUDGE, -2: quality.WORD_LIST})
    assert m.of[N, N, 0, 1] > 0.9 and m.of[N, N, 0, N] < 0.1
    assert m.weight(np.array([m.of[N, N, 0, 1], m.share[1]])) == pytest.approx([1, 0], abs=0.4)


@pytest.fixture(scope="module")
def some_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def scores(df):
    return sorted((r.doc_id, round(r.junk_score, 9), round(r.toxic_score, 9)) for r in df.collect())


def test_judgements_of_no_document_change_nothing(spark, some_docs):
    want = scores(quality.classify(some_docs))
    kind = "doc_id long, quality long, toxic long"
    assert scores(quality.classify(some_docs, spark.createDataFrame([], kind))) == want
    strangers = spark.createDataFrame([(10**9 + i, 0, 1) for i in range(50)] + [(None, 0, 1)], kind)
    assert scores(quality.classify(some_docs, strangers)) == want
    assert 0 < sum(j >= 0.5 or t >= 0.5 for _, j, t in want) < len(want) / 2


def test_a_hot_text_and_a_hot_judged_id_are_trained_on_once(spark, some_docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    hot = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("a hot text, and no other. It is there.").alias("text"))
    many = spark.range(2000).select(F.lit(0).cast("long").alias("doc_id"), F.concat(F.lit("words of row "), F.col("id").cast("string")).alias("text"))
    model = quality.fit(some_docs.unionByName(hot).unionByName(many), labels.withColumn("doc_id", F.col("doc_id").cast("long")), sample=90)
    assert model["junk"].share.sum() == pytest.approx(1.0)
    got = quality.classify(some_docs.unionByName(hot), labels).where("doc_id = 5").select("junk_score", "keep").distinct().count()
    assert got <= 2


def test_judgements_not_trained_on_are_met(spark, some_docs, sf_dir):
    """Held out: every third judged id."""
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/labels.parquet")
    got = quality.classify(docs, labels.where("doc_id % 3 <> 0"), keep=["doc_id"])
    out = got.join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    junk, toxic = [r for r in out if r.quality == 0], [r for r in out if r.toxic == 1]
    clean = [r for r in out if r.quality == 1 and r.toxic == 0]
    assert len(junk) > 10 and len(toxic) > 5
    assert sum(not r.keep for r in junk) / len(junk) > 0.9
    assert sum(not r.keep for r in toxic) / len(toxic) > 0.55
    assert sum(r.keep for r in clean) / len(clean) > 0.98


# --- WARC: damage inside a member --------------------------------------------------------

def several(n=5):
    """Records of one gzip member, and their plain bytes."""
    from dimforge.llm import warc
    return [warc.build_record(i, f"http://x/{i}", (f"page {i} " * 400 + str(random.Random(i).random())).encode()) for i in range(n)]


def ids(records):
    return [r["warc-record-id"] for _, r in records]


def test_a_damaged_record_costs_its_member_nothing_else():
    from dimforge.llm import warc
    made = several()
    at = len(made[0]) + len(made[1])
    broken = bytearray(b"".join(made))
    broken[at + 600] ^= 1                                             # the payload of record 2: its digest fails
    records, gaps = warc.salvage(warc.gzip_member(bytes(broken)) + warc.gzip_member(made[4]))
    assert ids(records) == [warc._uri(i) for i in (0, 1, 3, 4, 4)]
    assert [r["inner"] for _, r in records] == [0, len(made[0]), at + len(made[2]), at + len(made[2]) + len(made[3]), 0]
    end = len(warc.gzip_member(bytes(broken)))
    assert gaps == [(0, end, at, at + len(made[2]))] and records[-1][0] == end


def test_a_cut_or_damaged_member_gives_what_precedes_the_damage():
    from dimforge.llm import warc
    rng = random.Random(3)
    made = [warc.build_record(i, "u", rng.randbytes(50_000)) for i in range(5)]      # hardly compressible
    member, after = warc.gzip_member(b"".join(made)), warc.gzip_member(warc.build_record(9, "u", b"later"))
    cut = int(len(member) * 0.7)
    records, gaps = warc.salvage(member[:cut] + after)
    assert ids(records) == [warc._uri(i) for i in (0, 1, 2, 9)]
    assert len(gaps) == 1 and gaps[0][:3] == (0, cut, sum(map(len, made[:3])))
    records, gaps = warc.salvage(member[:cut])
    assert ids(records) == [warc._uri(i) for i in (0, 1, 2)] and gaps[0][:2] == (0, cut)


def test_inner_gaps_are_rows(spark):
    from dimforge.llm import warc
    made = several(3)
    broken = made[0] + made[1][:-40] + made[2]
    files = spark.createDataFrame([("f", bytearray(warc.gzip_member(broken)))], "path string, content binary")
    got = {r["record_type"]: r for r in warc.read_warc(files).collect()}
    assert (got["quarantined"]["inner_offset"], got["quarantined"]["inner_end"]) == (len(made[0]), len(broken) - len(made[2]))
    assert got["response"]["inner_offset"] in (0, len(broken) - len(made[2]))


# --- chat: ranked before texts are joined -----------------------------------------------------

def test_only_chosen_branches_are_written(spark):
    from dimforge.llm import chat
    wide = [("t", 0, None, "user", "ask", 0.0)] + [("t", i, 0, "assistant", f"answer {i}", float(i % 7)) for i in range(1, 60)]
    rows = wide + [(None, 0, None, "user", "x", None), (None, 1, 0, "assistant", None, None), ("u", 5, None, "user", "", 1.0)]
    messages = spark.createDataFrame(rows, "conv_id string, node long, parent long, role string, text string, score double")
    everything = {(r["conv_id"], r["leaf"]): r for r in chat.format_trees(messages).collect()}
    assert len(everything) == 61
    best = chat.format_trees(messages, best=2)
    assert {(r["conv_id"], r["leaf"], r["rank"]) for r in best.collect()} == {("t", 6, 1), ("t", 13, 2), (None, 1, 1), ("u", 5, 1)}
    assert all(everything[r["conv_id"], r["leaf"]] == r for r in best.collect())

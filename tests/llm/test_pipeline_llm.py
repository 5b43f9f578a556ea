"""The pipeline end to end, and the SQL twins of the queries."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tokenizers

import corpus_pipeline
from dimforge.llm.oracle import ORACLE
from dimforge.llm.queries import END_ID, QUERIES, tokenizer_path
from dimforge.plans.harness import compare, duckdb_connection


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).checkpoint()
        assert docs.columns == columns or name == "token_files"
        assert 0 < docs.count() <= 2 * n
    assert docs.agg({"n_tokens": "sum"}).first()[0] == docs.selectExpr("max(start + n_tokens)").first()[0]


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).checkpoint()
        assert docs.count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_one_per_group(rows):
    """The smallest id of each group linked at 0.8 on five-word shingles."""
    sets = []
    for r in rows:
        ws = plain_words(r["text"])
        sets.append({tuple(ws[k:k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9 and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    least = {}
    for r, g in zip(rows, root):
        least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    return [r for r, g in zip(rows, root) if least[g] == r["doc_id"]]


def plain_decontaminated(rows, benchmark):
    windows = set()
    for item in benchmark:
        ws = plain_words(item["text"])
        windows |= {tuple(ws[k:k + 10]) for k in range(max(1, len(ws) - 9))} if ws else set()
    sizes, out = sorted({len(w) for w in windows}), []
    for r in rows:
        text = r["text"]
        at, ws = [m.span() for m in WORD.finditer((text or "").translate(LOWER))], plain_words(text)
        hit = {p for n in sizes for k in range(len(ws) - n + 1) if tuple(ws[k:k + n]) in windows for p in range(k, k + n)}
        left, last = [], 0
        for p in sorted(hit):
            if p - 1 not in hit:
                left.append(text[last:at[p][0]])
            last = at[p][1]
        if len(hit) < len(ws) or not hit:
            out.append({**r, "text": "".join(left) + text[last:] if hit else text})
    return out


def plain_copies(rows):
    """Copies per document id: weights 5, 2, 1, a share of 150 %, at most twice."""
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows}
    have = Counter()
    for r in rows:
        have[r["source"]] += size[r["doc_id"]]
    names = sorted(have, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, budget, free = {}, 1.5 * sum(have.values()), set(names)
    while True:
        level = budget / sum(weight[s] for s in free) if free else 0
        full = {s for s in free if level * weight[s] >= 2 * have[s]}
        if not full:
            break
        for s in full:
            target[s] = 2 * have[s]
            budget -= target[s]
        free -= full
    target.update({s: level * weight[s] for s in free})
    copies = {}
    for s in names:
        rate = target[s] / have[s] if have[s] else 0
        tries = []
        for k in range(8):
            chosen = {}
            for i in (r["doc_id"] for r in rows if r["source"] == s):
                u = int(hashlib.sha256(f"mix:{i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) / 2**32
                chosen[i] = int(rate) + (u < rate - int(rate))
            tries.append((abs(sum(c * size[i] for i, c in chosen.items()) - target[s]), k, chosen))
        copies.update(min(tries, key=lambda x: x[:2])[2])
    return copies


def test_run_equals_plain_python_after_the_classifier(spark, sf_dir):
    """``run()`` against stages 2 to 5 in plain Python over what stage 1 keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = [r.asDict() for r in corpus_pipeline.STAGES[0][1](spark, docs, sf_dir).collect()]
    ids = {r["doc_id"] for r in kept}
    clean = {i for i, r in labels.items() if r.quality == 1 and r.toxic == 0}
    assert len(clean & ids) >= 0.98 * len(clean & {r.doc_id for r in docs.select("doc_id").collect()})
    benchmark = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    single = plain_one_per_group(kept)
    cut = plain_decontaminated(single, benchmark)
    assert len(single) < len(kept) and [r["text"] for r in cut] != [r["text"] for r in single]      # the stages have work
    copies = plain_copies(cut)
    model, want = tokenizers.Tokenizer.from_file(str(tokenizer_path())), Counter()
    for r in cut:
        made = np.array([*model.encode(r["text"] or "", add_special_tokens=False).ids, END_ID], "<u4")
        if copies[r["doc_id"]]:
            want[(r["doc_id"], len(made), zlib.crc32(made.tobytes()))] = copies[r["doc_id"]]
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert Counter(r[1:] for r in got) == want
    assert [r[1] for r in got] == sorted(r[1] for r in got)
    assert [r[0] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf_dir, name):
    info = compare(spark, duckdb_connection(sf_dir), name, QUERIES[name], ORACLE[name], sf_dir)
    assert info["ok"], info

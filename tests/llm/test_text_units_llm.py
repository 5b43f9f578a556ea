"""Fill-in-the-middle, collocations and fingerprints."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimforge.llm import collocations, fill_middle, fingerprints
from dimforge.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, n_chars string, form string, _x int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fill-in-the-middle -------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 300_000), min_size=1, max_size=300), st.integers(0, 290_000), st.integers(0, 9000))
def test_boundary_set_selects_and_ranks(points, start, run):
    offsets = np.array(sorted(points | set(range(start, start + run))))
    some = fill_middle.BoundarySet(offsets)
    assert len(some) == len(offsets)
    for k in {0, len(offsets) // 3, len(offsets) // 2, len(offsets) - 1}:
        assert some.select(k) == offsets[k]
        assert some.rank(int(offsets[k])) == k + 1
    for x in (0, start - 1, start + run // 2, 65535, 65536, 400_000):
        assert some.rank(x) == int(np.searchsorted(offsets, x, "right"))


def test_all_kinds_of_containers():
    every_other = np.arange(0, 65536, 2)                   # 32,768 offsets, no runs
    some = fill_middle.BoundarySet(np.concatenate([every_other, np.arange(65536, 131072), [200_000, 200_007]]))
    assert [type(c).__name__ for c in some.containers] == ["BitmapContainer", "RunContainer", "ArrayContainer"]
    assert [some.select(k) for k in (0, 32767, 32768, 98303, 98304, 98305)] == [0, 65534, 65536, 131071, 200_000, 200_007]
    with pytest.raises(IndexError):
        some.select(98306)


def test_fill_middle_equals_plain_python(spark):
    rng = random.Random(3)
    texts = [None, "", "\n", "\n\n\n", "one line", "a\nb", "ü😀\n\nß\r\nx", "has <M> inside\nx", "<\n<P\n>", "x\n" * 70_000,
             "long " * 200_000 + "\nend"] + ["".join(rng.choice("ab \né<>PSM") for _ in range(rng.randrange(60))) for _ in range(80)]
    rows = [(None if i == 7 else i - 3, t, "en", "clash", "clash", 1) for i, t in enumerate(texts)] + [(0, "a\nb", "en", "c", "c", 2)] * 2
    docs = spark.createDataFrame(rows, DOCS)
    made = fill_middle.transform(docs)
    assert made.columns == ["doc_id", "text", "lang", "n_chars", "_x", *fill_middle.ADDED]
    got = made.withColumn("back", fill_middle.restore()).collect()
    assert len(got) == len(rows)
    for r in got:
        t = r["text"] or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", t)
        h = [int(sha(f"7:{'' if r['doc_id'] is None else r['doc_id']}")[8 * i:8 * i + 8], 16) for i in range(4)]
        n = len(units)
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        form = "plain" if not t or re.search("<[PSM]>", t) else "spm" if h[3] % 100 < 50 else "psm"
        out = {"plain": t, "psm": f"<P>{x}<S>{z}<M>{y}", "spm": f"<S>{z}<P>{x}<M>{y}"}[form]
        chars = (None, None) if form == "plain" else (len(x), len(y))
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) == (n, form, *chars, out, t)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_fill_middle_shares_and_empty_table(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat(id, '\\nsecond\\nthird') as text")
    forms = Counter(r["form"] for r in fill_middle.transform(docs, fim_percent=30, spm_percent=0).collect())
    assert set(forms) == {"plain", "psm"} and 80 < forms["psm"] < 160
    assert fill_middle.transform(docs.where("false")).count() == 0


# --- collocations ---------------------------------------------------------------------

def brute_collocations(rows, min_words=2, max_words=3, threshold=10, absorb=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, max(max_words, 1) + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    frequent = {(g, p): a for (g, p), a in f.items() if len(p) >= min_words and a >= threshold}
    out = {}
    for (g, p), a in frequent.items():
        score, k = min((10**6 * a * a // (f[g, p[:k]] * f[g, p[k:]]), k) for k in range(1, len(p)))
        inside = any(h == g and len(q) > len(p) and 100 * b >= absorb * a
                     and any(q[i:i + len(p)] == p for i in range(len(q))) for (h, q), b in frequent.items())
        if not inside:
            out.setdefault(g, []).append((-score, -a, " ".join(p).encode(), f[g, p[:k]], f[g, p[k:]]))
    return sorted((g, i + 1, p.decode(), -a, left, right, n[g], -s) for g, found in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def collocation_rows(seed=1, docs=120):
    rng = random.Random(seed)
    common = ["the", "Of", "ÉTÉ", "été", "new", "york", "city", "a\x00b", "x\x85y", "　"]
    rows = [("en", None), ("en", ""), (None, "New York city. new york\tcity " * 15), ("en", "the of! " * 400), (None, "y z," * 3)]
    rows += [(rng.choice(["en", "en", "de", None]), "".join(
        rng.choice(common) + rng.choice([" ", " ", " ", " ", "\t", ". ", ", ", "\n", "  ", "\r", "!"]) for _ in range(rng.randrange(120))))
        for _ in range(docs)]
    return rows + [rows[-1]] * 30


@pytest.mark.parametrize("options", [{}, {"max_words": 5, "threshold": 4}, {"min_words": 3, "max_words": 4}, {"top": 3}])
def test_collocations_equal_plain_python(spark, options):
    rows = collocation_rows()
    docs = spark.createDataFrame([(i, t, g, "c", "c", 1) for i, (g, t) in enumerate(rows)], DOCS)
    got = sorted(map(tuple, collocations.mine(docs.withColumnRenamed("form", "grp"), **options).collect()))
    assert got and got == brute_collocations(rows, **options)


def test_collocations_of_an_empty_table_and_of_no_words(spark):
    docs = spark.createDataFrame([(1, " .\n", "en", "c", "c", 1), (2, None, None, "c", "c", 1)], DOCS)
    assert collocations.mine(docs).count() == 0
    assert collocations.mine(docs.where("false")).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=200), min_size=1, max_size=8), st.integers(2, 12))
def test_summaries_keep_every_frequent_key(parts, threshold):
    true = Counter(x for p in parts for x in p)
    mass = sum(true.values())
    summary = collocations.MisraGries(mass // threshold + 1)
    for p in parts:
        keys, counts = collocations.add_up(np.array(p, np.uint32), np.ones(len(p), np.int64))
        summary.merge([keys], [counts])
    assert len(summary.keys) <= summary.capacity and summary.error < threshold
    kept = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    assert all(kept.get(x, 0) <= c <= kept.get(x, 0) + summary.error for x, c in true.items())
    assert {x for x, c in true.items() if c >= threshold} <= set(summary.may_reach(threshold).tolist())


def test_grams_of_a_chunk_equal_plain_python_and_hash_alike_in_any_chunk():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randrange(30))) + rng.choice([".", ""]) for _ in range(20)]
    hashes = {}
    for order in (texts, texts[::-1]):
        chunk = collocations.Chunk()
        for t in order:
            chunk.add("en", t.encode())
        chunk.close()
        seen = Counter()
        for words, counts, h in chunk.grams(6):
            for row, c, x in zip(words.tolist(), counts.tolist(), h.tolist()):
                gram = tuple(chunk.word[i] for i in row)
                seen[gram] += c
                assert hashes.setdefault(gram, x) == x
        want = Counter(tuple(w.encode() for w in ws[i:i + n]) for t in order for ws in [re.findall("[a-e]+", t)]
                       for n in range(1, 7) for i in range(len(ws) - n + 1))
        assert seen == want


# --- fingerprints ----------------------------------------------------------------------

def shingle_set(text, width=5):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_beside_the_next_document(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    order = sorted(docs, reverse=True)
    got = {r["doc_id"]: r for r in QUERIES["op13_fingerprints"](spark, sf_dir).collect()}
    assert sorted(got, reverse=True) == order
    errors, by_text = [], {}
    for i, d in enumerate(order):
        text, following, r = docs[d], docs[order[(i + 1) % len(order)]], got[d]
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(changed))
        assert r["fingerprint"] == fingerprints.pack(fingerprints.sketch(text.encode())).hex()
        assert r["edited_fingerprint"] == fingerprints.pack(fingerprints.sketch(changed.encode())).hex()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        errors += [abs(r["near_edited"] - jaccard(text, changed)), abs(r["near_next"] - jaccard(text, following))]
    assert max(errors) < 0.25 and sum(errors) / len(errors) < 0.03


def test_fingerprints_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(3, None), (None, "null id"), (3, "abc"), (2, "a b c d e f g"), (2, "a b c d e f g"), (-5, long), (1, ""), (0, "ü😀x")]
    docs = spark.createDataFrame([(i, t, "en", "clash", "clash", 1) for i, t in rows], DOCS).repartition(5)
    found = fingerprints.compare_with_next(docs)
    assert found.columns == ["doc_id", "text", "lang", "form", "_x", *fingerprints.ADDED]
    got = found.collect()
    assert len(got) == len(rows)
    at = {r["text"]: r for r in got}
    assert at["ü😀x"]["edited_sha256"] == sha("ü😀" + long[:1])
    assert at[long]["edited_sha256"] == sha(long[:len(long) - len(long) // 2] + "null id")
    assert (at[None]["n_chars"], at[None]["edited_sha256"], at[None]["fingerprint"], at[None]["near_edited"]) == (0, sha(""), b"", 1.0)
    twins = [r for r in got if r["doc_id"] == 2]
    assert sorted(r["edited_sha256"] for r in twins) == sorted([sha("a b c da b c "), sha("a b c d")])
    assert {r["near_next"] for r in twins} == {1.0, 0.0}
    assert fingerprints.compare_with_next(docs.where("false")).count() == 0
    alone = fingerprints.compare_with_next(docs.where("doc_id = 0")).first()
    assert (alone["edited_sha256"], alone["near_next"]) == (sha("ü😀ü"), 1.0)


def test_sketches_merge_and_estimate():
    words = [f"w{i}" for i in range(4000)]
    a, b, c = (" ".join(ws).encode() for ws in (words[:2500], words[1500:], words[:1000]))
    x, y, z = map(fingerprints.sketch, (a, b, c))
    whole = fingerprints.sketch(b"\n".join([a, b]))
    assert set(fingerprints.merge(x, y).tolist()) >= set(whole.tolist()) - set(fingerprints.sketch(b" ".join(
        [*(w.encode() for w in words[2490:2500]), *(w.encode() for w in words[1500:1510])])).tolist())
    assert abs(fingerprints.resemblance(x, y) - 0.25) < 0.2
    assert fingerprints.containment(z, x) > 0.75 and fingerprints.containment(x, z) < 0.65
    assert abs(fingerprints.distinct(x) / 2496 - 1) < 0.4
    small = fingerprints.sketch(b"one two three four five six seven")
    assert len(small) == 3 and fingerprints.distinct(small) == 3.0
    assert fingerprints.resemblance(small, fingerprints.sketch(b"two three four five six seven eight")) == 0.5


def test_merged_parts_are_the_whole(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["hot", "hot", "b", None]), " ".join(rng.choice("abcdefgh") for _ in range(40))) for _ in range(300)]
    parts = fingerprints.fingerprint(spark.createDataFrame(rows, "src string, text string").repartition(7))
    got = {r["src"]: r["fingerprint"] for r in fingerprints.merge_parts(parts, "src").collect()}
    for src in ("hot", "b", None):
        every = np.zeros(0, np.uint32)
        for s, t in rows:
            if s == src:
                every = np.union1d(every, fingerprints.sketch(t.encode(), 10**6))
        assert got[src] == fingerprints.pack(every[:fingerprints.K])
    assert len(got) == 3
    pair = parts.limit(1).select("fingerprint")
    row = pair.select(fingerprints.resemblance_of("fingerprint", "fingerprint").alias("r"),
                      fingerprints.containment_of("fingerprint", "fingerprint").alias("c"),
                      fingerprints.distinct_of("fingerprint").alias("d")).first()
    assert (row["r"], row["c"], row["d"]) == (1.0, 1.0, 36.0)

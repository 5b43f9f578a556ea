"""Small cases of the training-data operators: nulls, empty and long texts,
ties, repeated rows, empty tables, clashing column names."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimforge.llm import (brown, chat, chosen_path, components, decontaminate, embeddings, licenses, mixing, quality,
                          token_files, warc)
from dimforge.llm.queries import tokenizer_path

DOC = "doc_id long, text string, source string"


def docs(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


# --- 1 mixing -----------------------------------------------------------------

def test_mix_targets_fill_by_weight_and_reshare(spark):
    sizes = spark.createDataFrame([("a", "a", 100), ("b", "b", 1000), ("c", "c", 1000), ("d", None, 0)], "key string, src string, size long")
    got = {r.src: r.target for r in mixing.targets(sizes).collect()}
    # a is capped at 200; b and c share the rest by 2 : 1
    assert got["a"] == 200 and got[None] == 0
    assert got["b"] == pytest.approx(2950 * 2 / 3) and got["c"] == pytest.approx(2950 / 3)


def test_mix_handles_nulls_repeats_and_clashes(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 3}") for i in range(200)] + [(5, None, None), (5, None, None), (None, "x y", None)]
    d = docs(spark, rows).withColumn("copies", F.lit("clash")).withColumn("size", F.lit(-1))
    plan = mixing.mix_plan(d).collect()
    assert len(plan) == len(rows)
    for r in plan:
        assert r["size"] == (0 if r.text is None else len(r.text.split())) and 0 <= r.copies <= 2
    again = Counter((r.doc_id, r.copies) for r in mixing.mix_plan(d).collect())
    assert again == Counter((r.doc_id, r.copies) for r in plan)
    mixed = mixing.mix(docs(spark, rows))
    assert mixed.columns == ["doc_id", "text", "source"]
    assert mixed.count() == sum(r.copies for r in plan)
    for s in {r.source for r in plan}:
        taken, target = sum(r["size"] * r.copies for r in plan if r.source == s), next(r.target for r in plan if r.source == s)
        assert abs(taken - target) <= max(12, 0.1 * target)


def test_mix_of_an_empty_table(spark):
    assert mixing.mix_plan(docs(spark, [])).count() == 0


# --- 2 decontamination ----------------------------------------------------------

def brute_hits(text, windows):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    hit, items = set(), set()
    for p, its in windows.items():
        for k in range(len(ws) - len(p) + 1):
            if tuple(ws[k:k + len(p)]) == p:
                hit.update(range(k, k + len(p)))
                items |= its
    return len(ws), len(hit), items


def test_decontaminate_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vocab = ["der", "Die", "das", "été", "x1", "ß", "and"]
    bench = [(i, " ".join(rng.choice(vocab, rng.integers(1, 14)))) for i in range(12)] + [(50, None), (51, "..."), (52, "und"), (52, "und")]
    rows = [(i, " ".join(rng.choice(vocab, rng.integers(0, 60))), "s") for i in range(60)]
    rows += [(100, None, "s"), (101, "", "s"), (102, "!!", "s"), (103, (bench[0][1] + ". ") * 400, "s"), (103, "und", None)]
    windows = {}
    for i, t in bench:
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        for k in range(max(1, len(ws) - 9) if ws else 0):
            windows.setdefault(tuple(ws[k:k + 10]), set()).add(i)
    b = spark.createDataFrame(bench, "item_id long, text string")
    d = docs(spark, rows).withColumn("items", F.lit("clash"))
    for options in ({}, {"shard_words": 50}, {"block_bytes": 100}):
        found = decontaminate.find_spans(d, b, **options).collect()
        assert len(found) == len(rows)
        for r in found:
            n, hit, items = brute_hits(r.text, windows)
            assert (r.n_words, sum(s["end"] - s["start"] for s in r.spans), set(r["items"])) == (n, hit, items)
    cut = decontaminate.remove_spans(decontaminate.find_spans(docs(spark, rows), b))
    assert {r.doc_id for r in cut.collect()} >= {100, 101, 102}          # clean documents stay


def test_decontaminate_empty_sides(spark):
    b = spark.createDataFrame([], "item_id long, text string")
    assert [r.spans for r in decontaminate.find_spans(docs(spark, [(1, "a b", "s")]), b).collect()] == [[]]
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.find_spans(docs(spark, []), b).count() == 0


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(1)
    text = np.concatenate([np.append(rng.integers(1, 5, rng.integers(1, 40)), 0) for _ in range(30)]).astype(np.int32)
    index = decontaminate.FMIndex(text, 4, sample=4)
    for n in (1, 2, 3, 5):
        p = rng.integers(1, 5, (20, n)).astype(np.int32)
        lo, hi = index.search(p)
        for i in range(20):
            want = [k for k in range(len(text) - n + 1) if (text[k:k + n] == p[i]).all()]
            assert sorted(index.locate(np.arange(lo[i], max(lo[i], hi[i]))).tolist()) == want


# --- 3 token files ------------------------------------------------------------------

def test_variable_length_codes_round_trip():
    r = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.uint32)
    control, data = token_files.encode_ranks(r)
    back = token_files.decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(r))
    assert back.tolist() == r.tolist()
    ids, parts = token_files.unpack_file(token_files.pack_file([3, None], [np.array([9, 9, 4], np.uint32), np.zeros(0, np.uint32)]))
    assert ids == [3, None] and [p.tolist() for p in parts] == [[9, 9, 4], []]
    with pytest.raises(ValueError):
        token_files.unpack_file(token_files.pack_file([1], [np.array([5], np.uint32)])[:-1] + b"\0")


HARD = ["", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "\n", "x<|endoftext|>y", "it's 'tis don't", "a\tb c", "é ü",
        "1 2  3", "a b c ", "　x y", "end.\nNext one", "… — ok", "a\r\n b", "Wort, Wort;\nWort:", "z" * 300 + " q", "a\x00 b", "go!! x*** y' z_ don't' é… a²",
        "STOP!! THE!!", "x’s y'S", "a\u0301 b\u0301."]


def test_encoder_equals_the_library():
    enc = token_files.Encoder(tokenizer_path())
    for _ in range(2):
        want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in HARD]
        assert [enc.encode(t).tolist() for t in HARD] == want


def test_token_files_follow_doc_ids(spark):
    rows = [(i, t, "s") for i, t in enumerate(HARD)] + [(None, "null id", "s"), (4, "again", "s"), (7, None, "s"), (90, "lang " * 30000, "s")]
    manifest = token_files.write_files(docs(spark, rows), tokenizer_path(), 2, file_ids=50)
    got = token_files.read_files(manifest).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert len(got) == len(rows) and ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at, enc = 0, token_files.Encoder(tokenizer_path())
    texts = Counter((i, t or "") for i, t, _ in rows)
    for r in got:
        back = np.frombuffer(bytes(r["ids"]), "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(back), zlib.crc32(back.tobytes())) and back[-1] == 2
        texts[r.doc_id, enc.tokenizer.decode(back[:-1].tolist(), skip_special_tokens=False)] -= 1
        at += r.n_tokens
    assert not any(texts.values())
    assert token_files.read_files(token_files.write_files(docs(spark, []), tokenizer_path(), 2)).count() == 0


# --- 4 Jaccard join ---------------------------------------------------------------------

def brute_links(rows, width=5, threshold=0.8):
    sets = []
    for _, t, _ in rows:
        ws = [w.decode() for w in decontaminate.words((t or "").encode())]
        sets.append({tuple(ws[k:k + width]) for k in range(max(1, len(ws) - width + 1))} if ws else set())
    n = len(rows)
    links, root = [0] * n, list(range(n))
    for i in range(n):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j] \
                    and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    low = {r: min(rows[i][0] for i in range(n) if root[i] == r and rows[i][0] is not None) for r in set(root)
           if any(rows[i][0] is not None for i in range(n) if root[i] == r)}
    return Counter((rows[i][0], None if rows[i][0] is None else low[root[i]], links[i]) for i in range(n))


def near_rows():
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(300)]
    rows, k = [], 0
    for g in range(12):
        base = list(rng.choice(vocab, rng.integers(4, 120)))
        for _ in range(rng.integers(1, 14)):
            ws = list(base)
            for _ in range(rng.integers(0, 4)):
                ws[rng.integers(0, len(ws))] = str(rng.choice(vocab))
            rows.append((k, " ".join(ws), "s"))
            k += 1
    return rows + [(900, None, "s"), (901, "", "s"), (902, "...", "s"), (903, "two words", "s"), (904, "Two, words!", "s"),
                   (3, rows[3][1], "s"), (None, rows[0][1], "s")]


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 4, "block_rows": 3, "max_depth": 3}])
def test_jaccard_join_equals_brute_force(spark, options):
    rows = near_rows()
    got = chosen_path.jaccard_groups(docs(spark, rows).withColumn("class_id", F.lit("clash")), **options).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == brute_links(rows)


def test_one_per_group_keeps_the_smallest_and_all_clean_rows(spark):
    rows = near_rows()
    kept = chosen_path.one_per_group(docs(spark, rows))
    want = {(i, c) for (i, c, _) in brute_links(rows)}
    got = Counter(r.doc_id for r in kept.collect())
    assert got == Counter(i for i, c in want if i is None or i == c)
    assert kept.columns == ["doc_id", "text", "source"]
    assert chosen_path.one_per_group(docs(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 299), (300, 299)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[300] == got[299] == 299
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 5 WARC ------------------------------------------------------------------------------

def test_salvage_recovers_and_logs_gaps():
    records = [warc.build_record(i, f"http://x/{i}\n", b"payload %d " % i * 50) for i in range(6)]
    for pack in (warc.gzip_member, bytes):
        parts = [pack(r) for r in records]
        whole = b"".join(parts)
        good, gaps = warc.salvage(whole)
        assert len(good) == 6 and gaps == []
        at = [sum(map(len, parts[:i])) for i in range(7)]
        broken = bytearray(whole)
        broken[at[2] + len(parts[2]) // 2] ^= 0xFF                    # inside record 2
        broken = bytes(broken[:at[4]]) + b"garbage" + bytes(broken[at[4]:-5])   # before 4; 5 cut short
        good, gaps = warc.salvage(broken)
        assert [r["warc-record-id"] for _, r in good] == [f"<urn:x-page:{i}>" for i in (0, 1, 3, 4)]
        assert gaps == [(at[2], at[3]), (at[4], at[4] + 7), (at[5] + 7, len(broken))]
    assert warc.salvage(b"") == ([], [])
    assert warc.salvage(b"nothing here") == ([], [(0, 12)])


def test_warc_round_trip(spark):
    rows = [(1, "u", "<a>"), (2, "u", "<a>"), (3, None, None), (4, "u", ""), (5, "u", "é" * 5000), (5, "u", "é" * 5000), (None, "u", "<a>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("revisit", F.lit(1))
    for compress in (True, False):
        files = warc.open_archives(warc.write_warc(pages, file_bytes=2000, compress=compress))
        got = warc.read_warc(files, with_payload=True).collect()
        assert Counter((r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in got) == Counter([
            ("<urn:x-page:1>", "revisit", "<urn:x-page:2>", 3), ("<urn:x-page:2>", "response", None, 3),
            ("<urn:x-page:>", "revisit", "<urn:x-page:2>", 3), ("<urn:x-page:3>", "revisit", "<urn:x-page:4>", 0),
            ("<urn:x-page:4>", "response", None, 0), ("<urn:x-page:5>", "response", None, 10000),
            ("<urn:x-page:5>", "response", None, 10000)])
    assert warc.open_archives(warc.write_warc(pages.where("false"))) is None


# --- 6 licences --------------------------------------------------------------------------

MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation "
       'files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, '
       "merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\n"
       "furnished to do so, subject to the following conditions.\n\nThe above copyright notice and this permission notice shall be included in "
       'all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\n'
       "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")


def test_license_rules(spark):
    rows = [(1, MIT, "s"), (2, "Text.\nReleased under the MIT License.", "s"), (3, "a |\nLicensed under CC BY-NC 4.0.", "s"),
            (4, None, "s"), (5, "", "s"), (6, "No licence. Licensed under the Apache License, Version 2.0. All rights reserved.", "s"),
            (7, MIT.split("\n\n")[1], "s"), (8, "word " * 50000 + ".", "s"), (8, "Licensed under the Apache License, Version 2.0", None)]
    got = Counter((r.doc_id, tuple(r.licenses)) for r in licenses.recognise(docs(spark, rows).withColumn("licenses", F.lit(1))).collect())
    assert got == Counter([(1, ("MIT",)), (2, ("MIT",)), (3, ("CC-BY-NC-4.0",)), (4, ()), (5, ()),
                           (6, ("Apache-2.0", "all-rights-reserved")), (7, ("fragment",)), (8, ()), (8, ("Apache-2.0",))])
    assert licenses.recognise(docs(spark, [])).count() == 0


WRAPPED = {
    "MIT": """MIT License

Copyright (c) 2021 Jane A. Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""",
    "Apache-2.0": """Copyright 2019 The Authors

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
""",
    "BSD-3-Clause": """Copyright (c) 2018, Some Holder

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
""",
    "GPL-3.0-or-later": """frob - a program
Copyright (C) 2020  Some Holder

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
""",
}


def test_wrapped_licence_texts(spark):
    forms = {"plain": "{}", "slashes": "// {}", "hash": "# {}", "dashes": "-- {}", "star": " * {}", "indent": "    {}"}
    rows = [(i, "\n".join(form.format(line) for line in text.split("\n")), f"{name} {kind}")
            for i, (name, text, kind, form) in enumerate((n, t, k, f) for n, t in WRAPPED.items() for k, f in forms.items())]
    rows += [(100, "/*\n" + rows[4][1] + "\n */\nint main;", "MIT block"), (101, rows[0][1].replace("\n", "\r\n"), "MIT crlf"),
             (102, WRAPPED["BSD-3-Clause"].replace("1. ", "(a) ").replace("2. ", "(b) ").replace("3. ", "(c) "), "BSD-3-Clause letters"),
             (103, " ".join(WRAPPED["BSD-3-Clause"].split("\n\n", 1)[1].split()), "BSD-3-Clause one")]
    got = {r.source: list(r.licenses) for r in licenses.recognise(docs(spark, rows)).collect()}
    assert got == {source: [source.split()[0]] for _, _, source in rows}


# --- 7 chat -------------------------------------------------------------------------------

def test_trees_rank_and_format_branches(spark):
    rows = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "good", 1.0), (1, 2, 0, "assistant", "bad", -1.0),
            (1, 3, 1, "user", "more", 0.0), (1, 4, 3, "assistant", "<|im_end|>&lt;|", 1.0), (1, 5, 99, "user", "stray", 0.0),
            (2, 7, 8, "user", "cycle", 0.0), (2, 8, 7, "user", "cycle", 0.0), (None, 1, None, "a\nb", None, None)]
    m = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    out = chat.parse(chat.format_trees(m))
    got = {(r.conv_id, r.leaf): r for r in out.collect()}
    assert set(got) == {(1, 4), (1, 2), (1, 5), (None, 1)}
    assert [got[1, x]["rank"] for x in (4, 5, 2)] == [1, 2, 3]
    assert [(t.role, t.text) for t in got[1, 4].turns] == [("user", "q"), ("assistant", "good"), ("user", "more"), ("assistant", "<|im_end|>&lt;|")]
    assert got[1, 4].learned == ["good", "<|im_end|>&lt;|"] and got[None, 1].turns[0].role == "a\nb"
    assert chat.format_trees(m, best=1).count() == 2
    assert chat.format_trees(m.where("false")).count() == 0


def test_long_conversations_and_repeated_rows(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(37)] + [(2, 0, "user", "x"), (2, 0, "user", "x"), (2, None, None, "y")]
    m = chat.chains(spark.createDataFrame(rows, "c long, t long, r string, x string"), conv="c", turn="t", role="r", text="x")
    got = {r.conv_id: r for r in chat.parse(chat.format_trees(m)).collect()}
    assert [t.text for t in got[1].turns] == [f"t{i}" for i in range(37)]
    assert [t.text for t in got[2].turns] == ["y", "x", "x"]


# --- 8 quality -----------------------------------------------------------------------------

def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    bad = rng.random(4000) < 0.2
    hit, false = np.array([0.8, 0.6, 0.7]), np.array([0.05, 0.02, 0.1])
    votes = np.where(bad[:, None], rng.random((4000, 3)) < hit, rng.random((4000, 3)) < false).astype(int)
    votes = np.hstack([votes, np.full((4000, 1), quality.NONE)])          # no judgements
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    m = quality.LabelModel(patterns, n.astype(float))
    post = np.array([m.of[tuple(v)] for v in votes.tolist()])
    assert abs(m.share[1] - 0.2) < 0.06 and ((post > 0.5) == bad).mean() > 0.93


def test_scorer_is_fitted_to_the_end_on_the_whole_sample():
    assert quality.SAMPLE == 12_000
    rng = np.random.default_rng(4)
    shared = rng.random(600) < 0.5                                    # makes the features depend on each other
    x = rng.random((600, 40)) < np.where(shared[:, None], 0.7, 0.2)
    y = (rng.random(600) < 1 / (1 + np.exp(-(x[:, :6].sum(1) - 3.0)))).astype(float)
    s = quality.Scorer([np.flatnonzero(r).astype(np.uint32).tobytes() for r in x], y)
    w = np.array([s.weights.get(j, 0.0) for j in range(40)])
    off = 1 / (1 + np.exp(-(s.bias + x @ w))) - y
    step = [(off @ x[:, j] / 600 + 1e-4 * np.sign(w[j])) / (0.25 * x[:, j].sum() / 600) for j in np.flatnonzero(w)]
    assert np.abs(step).max() < 4e-3 and abs(4 * off.mean()) < 4e-3


def test_quality_on_labelled_rows_and_edges(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    edge = spark.createDataFrame([(-1, None), (-2, ""), (-3, "x"), (None, "x y"), (-4, "Gut, das ist gut. " * 5000)], "doc_id long, text string")
    got = quality.classify(d.unionByName(edge).withColumn("keep", F.lit(3)), labels).collect()
    keep = {r.doc_id: r.keep for r in got}
    assert len(got) == d.count() + 5 and keep[-1] and keep[-2]
    judged = [(keep[r.doc_id], r.quality == 1 and r.toxic == 0) for r in labels.collect() if r.doc_id in keep]
    assert sum(a == b for a, b in judged) / len(judged) > 0.9
    assert quality.classify(d.where("false"), labels).count() == 0
    assert quality.classify(d, only_kept=True).columns == ["doc_id", "text"]


# --- 9 Brown ---------------------------------------------------------------------------------

def test_brown_base_and_held_out_gain(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", (F.col("doc_id") % 5 == 0).alias("held_out"), "text")
    d = d.unionByName(spark.createDataFrame([(-1, True, None), (-2, False, ""), (None, False, "a A \x0b b")], "doc_id long, held_out boolean, text string"))
    counts, model = brown.fit(d.where("not held_out"), known_words=500, top_words=100, suffixes=50, classes=12)
    got = {r.doc_id: r for r in brown.score(d, counts, model).collect()}
    rows = d.collect()
    tok = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)})) if w] + [None]
    c = Counter(w for r in rows if not r.held_out for w in tok(r.text))
    n, v = sum(c.values()), len(c)
    for r in rows:
        ws, g = tok(r.text), got[r.doc_id]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert g.base_score == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in ws))
    held = [g for g in got.values() if g.held_out]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)


def test_brown_model_is_a_distribution():
    v = brown.Vocabulary([brown.END, b"aa", b"bb", b"ccxyz"], [3, 5, 2, 1], 3, [b"xyz"])
    big = np.random.default_rng(0).integers(0, 5, (v.n_items, v.n_items)).astype(float)
    m = brown.Model(v, brown.exchange_clusters(big, 3), big, np.ones(v.n_items), 11, 4)
    assert np.allclose((10 ** m.transition).sum(1), 1)


def test_brown_classes_cover_the_whole_vocabulary(spark):
    # words in zzz stand in the places of those in aaa or those in bbb, and no word is among the top or known words
    rng = np.random.default_rng(5)
    a, b = ([f"{k}{i:03d}{'zzz' if i < 100 else 3 * k}" for i in range(300)] for k in "ab")
    rows = [(i, i % 5 == 0, " ".join(w for _ in range(20) for w in ("the", a[rng.integers(300)], "of", b[rng.integers(300)]))) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")
    options = {"known_words": 20, "top_words": 3, "suffixes": 3, "classes": 5}
    words, model = brown.fit(d.where("not held_out"), **options)
    got = {bytes(r["word"]).decode(): r for r in words.collect()}
    counted = Counter(w for _, held, t in rows if not held for w in t.split())
    assert {w: r["c"] for w, r in got.items() if w != "\n"} == counted
    classes = [{got[w]["class"] for w in ws if w in got} for ws in (a, b)]
    assert len(classes[0]) == len(classes[1]) == 1 and classes[0] != classes[1]
    # scores are those of a plain loop over the tokens
    of = {w: r["class"] for w, r in got.items()}
    trans = np.zeros((5, 5))
    for _, held, t in rows:
        if not held:
            s = [of["\n"], *(of[w] for w in t.split()), of["\n"]]
            np.add.at(trans, (s[:-1], s[1:]), 1)
    unigram = (trans.sum(0) + 0.5) / (trans.sum() + 2.5)
    p = 0.95 * trans / np.maximum(trans.sum(1, keepdims=True), 1) + 0.05 * unigram
    p[trans.sum(1) == 0] = unigram
    size, kinds = trans.sum(0), np.bincount(list(of.values()), minlength=5)
    scores = {r.doc_id: r.score for r in brown.score(d, words, model).collect()}
    for i, _, t in rows:
        ws = [*t.split(), "\n"]
        if all(w in of for w in ws):
            cls = [of["\n"], *(of[w] for w in ws)]
            assert scores[i] == pytest.approx(sum(np.log10(p[x, y] * (got[w]["c"] + 1) / (size[y] + kinds[y] + 1))
                                                  for x, y, w in zip(cls, cls[1:], ws)))
    assert {r.doc_id: r.score for r in brown.fit_score(d, **options).collect()} == pytest.approx(scores)


def test_brown_without_training_texts(spark):
    d = spark.createDataFrame([(1, True, "a b")], "doc_id long, held_out boolean, text string")
    counts, model = brown.fit(d.where("not held_out"))
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in brown.score(d, counts, model).collect()] == [(3, 0, 0)]


# --- 10 embeddings --------------------------------------------------------------------------

@pytest.mark.parametrize("options", [{}, {"cell_rows": 20, "block_rows": 8}])
def test_near_vectors_equal_brute_force(spark, options):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    vec = np.concatenate([base, base[:25] + rng.normal(scale=0.03, size=(25, 16)), np.repeat(base[:1], 30, 0) + rng.normal(scale=0.02, size=(30, 16))])
    rows = [(i, [float(x) for x in v], int(i % 2)) for i, v in enumerate(vec)]
    rows += [(500, rows[0][1], 0), (501, None, 0), (502, [0.0] * 16, 0), (503, [float("nan")] + [1.0] * 15, 0), (504, [None] + [1.0] * 15, 0),
             (505, rows[0][1], None), (506, rows[0][1][:8], 0), (3, rows[3][1], rows[3][2]), (507, [float("inf")] * 16, 0)]
    good = [i for i, (k, v, g) in enumerate(rows) if g is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = [0] * len(rows), list(range(len(rows)))
    for i in good:
        for j in good:
            if j < i and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1]), np.array(rows[j][1])
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    x, y = root[i], root[j]
                    root = [y if r == x else r for r in root]
    low = {r: min(rows[i][0] for i in range(len(rows)) if root[i] == r) for r in set(root)}
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("clash"))
    got = embeddings.near_vectors(t, **options).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == Counter(
        (k, links[i], low[root[i]], k == low[root[i]]) for i, (k, _, _) in enumerate(rows))
    assert embeddings.near_vectors(t.where("false")).count() == 0


def test_digest_of_no_items_is_the_empty_digest():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")

"""Benchmark decontamination with an FM-index per training shard.

Benchmark texts are cut into phrases (windows of ``width`` consecutive words;
a shorter item is one phrase).  Every task collects its documents into shards
of a bounded number of words and indexes each shard: suffix array by prefix
doubling, Burrows-Wheeler transform, a wavelet matrix for ranks, and sampled
suffix positions.  All phrases are searched backwards at once; occurrences are
located by walking to a sampled position; overlapping occurrences are merged
to removal spans.

A word that occurs in no phrase cannot lie inside an occurrence, and a run of
phrase words shorter than the shortest phrase cannot hold one, so the index
holds only the other runs, each ended by a separator.  This loses nothing and
keeps the index small.

Phrases reach the tasks as a broadcast of a bounded block (``block_bytes`` of
benchmark text); a larger benchmark is searched block by block, each pass
adding to the same row's spans.  Documents are never shuffled.

Defined results: NULL and wordless texts have no spans; an item without words
has no phrase; a NULL item id is searched but not listed; repeated documents
or items are each searched; an empty benchmark or table gives no spans; input
columns that clash with the added ones (``n_words spans items``) are replaced.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from dimforge.llm.storage import forget, ship_package, tidy

ADDED = ("n_words", "spans", "items")
SHARD_WORDS = 1_500_000
SAMPLE = 8
BLOCK_BYTES = 4_000_000

# Words: ASCII letters (lower-cased), digits and everything beyond ASCII.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(data: bytes) -> list[bytes]:
    return data.translate(_TABLE).split()


class WaveletMatrix:
    """Ranks and accesses on a sequence of small integers, for whole arrays of
    positions at once."""

    def __init__(self, seq: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        s = seq
        for b in range(self.bits - 1, -1, -1):
            bit = ((s >> b) & 1).astype(bool)
            count = np.zeros(len(s) + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(s) - int(count[-1]))
            s = np.concatenate([s[~bit], s[bit]])
        symbols = np.arange(top + 1)
        self.start = self._down(symbols, np.zeros(top + 1, np.int64))

    def _down(self, symbol, i):
        for level, (count, z) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - level)) & 1
            one = count[i]
            i = np.where(bit == 1, z + one, i - one)
        return i

    def rank(self, symbol, i):
        """Occurrences of ``symbol`` before position ``i``."""
        return self._down(symbol, i) - self.start[symbol]

    def access_rank(self, i):
        """Symbol at ``i`` and its rank there."""
        symbol = np.zeros(len(i), np.int64)
        for count, z in zip(self.ones, self.zeros):
            one = count[i]
            bit = count[i + 1] - one
            symbol = symbol * 2 + bit
            i = np.where(bit == 1, z + one, i - one)
        return symbol, i - self.start[symbol]


def suffix_array(order: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling.  ``order`` holds the symbols'
    comparison ranks; separators have ranks of their own, so every comparison
    ends within a run."""
    n = len(order)
    rank = order.astype(np.int64)
    step = 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[:-step or None] = rank[step:] + 1 if step < n else 0
        key = rank * (n + len(order) + 2) + nxt
        sa = np.argsort(key, kind="stable")
        sorted_key = key[sa]
        fresh = np.ones(n, np.int64)
        fresh[1:] = sorted_key[1:] != sorted_key[:-1]
        dense = np.cumsum(fresh) - 1
        rank = np.empty(n, np.int64)
        rank[sa] = dense
        if dense[-1] == n - 1:
            return sa
        step *= 2


class FMIndex:
    """``text``: symbols 1..top in runs, each run ended by a 0."""

    def __init__(self, text: np.ndarray, top: int, sample: int = SAMPLE):
        n = len(text)
        sep = text == 0
        n_sep = int(sep.sum())
        order = np.where(sep, np.cumsum(sep) - 1, text.astype(np.int64) - 1 + n_sep)
        order = np.unique(order, return_inverse=True)[1]
        sa = suffix_array(order)
        bwt = text[sa - 1]                       # the row of suffix 0 gets the last separator
        self.wavelet = WaveletMatrix(bwt.astype(np.int64), top)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        # every `sample`-th position, and every start of a run, where walks end
        keep = np.zeros(n, bool)
        keep[::sample] = True
        keep[0] = True
        keep[1:] |= sep[:-1]
        marked = keep[sa]
        self.marked, self.mark_rank, self.position = marked, np.cumsum(marked) - 1, sa[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long phrases (one per row)."""
        last = phrases[:, -1].astype(np.int64)
        lo, hi = self.first[last].copy(), self.first[last + 1].copy()
        for j in range(phrases.shape[1] - 2, -1, -1):
            on = np.flatnonzero(lo < hi)
            if not len(on):
                break
            c = phrases[on, j].astype(np.int64)
            lo[on] = self.first[c] + self.wavelet.rank(c, lo[on])
            hi[on] = self.first[c] + self.wavelet.rank(c, hi[on])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), np.int64)
        todo, row, walked = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            done = self.marked[row]
            out[todo[done]] = self.position[self.mark_rank[row[done]]] + walked
            todo, row = todo[~done], row[~done]
            symbol, rank = self.wavelet.access_rank(row)
            row = self.first[symbol] + rank
            walked += 1
        return out


class Phrases:
    """A block of distinct phrases: vocabulary, word-id matrices by length, and
    the items of each phrase."""

    def __init__(self, items, width: int):
        vocab, found = {}, {}
        for item, text in items:
            ws = [vocab.setdefault(w, len(vocab) + 1) for w in words((text or "").encode())]
            for i in range(max(1, len(ws) - width + 1) if ws else 0):
                found.setdefault(tuple(ws[i:i + width]), set()).add(item)
        self.vocab = vocab
        self.by_length = {}
        for p in found:
            self.by_length.setdefault(len(p), []).append(p)
        self.items = {n: [sorted(x for x in found[p] if x is not None) for p in ps] for n, ps in self.by_length.items()}
        self.by_length = {n: np.array(ps, np.int32) for n, ps in self.by_length.items()}
        self.shortest = min(self.by_length, default=0)


def shard_hits(docs: list[np.ndarray], phrases: Phrases):
    """Hits of a shard.  ``docs``: word ids per document (0: not in any
    phrase).  Returns per document the merged spans (start, end) and items."""
    spans = [[] for _ in docs]
    items = [set() for _ in docs]
    if not docs or not phrases.shortest:
        return spans, items
    text = np.concatenate([x for d in docs for x in (d, np.zeros(1, np.int32))])
    start = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    inside = text != 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= phrases.shortest
    begin, end = begin[long], end[long]
    if not len(begin):
        return spans, items
    delta = np.zeros(len(text) + 1, np.int64)
    np.add.at(delta, begin, 1)
    np.add.at(delta, end + 1, -1)              # with the separator after each run
    kept = np.flatnonzero(np.cumsum(delta[:-1]) > 0)
    index = FMIndex(text[kept], len(phrases.vocab))
    hit = np.zeros(len(text) + 1, np.int64)
    for n, matrix in phrases.by_length.items():
        lo, hi = index.search(matrix)
        count = np.maximum(hi - lo, 0)
        some = np.flatnonzero(count)
        if not len(some):
            continue
        which = np.repeat(some, count[some])
        rows = np.repeat(lo[some], count[some]) + np.arange(len(which)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
        at = kept[index.locate(rows)]
        np.add.at(hit, at, 1)
        np.add.at(hit, at + n, -1)
        doc = np.searchsorted(start, at, "right") - 1
        for d, p in {*zip(doc.tolist(), which.tolist())}:
            items[d].update(phrases.items[n][p])
    covered = np.cumsum(hit[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        d = int(np.searchsorted(start, a, "right")) - 1
        spans[d].append((a - int(start[d]), b - int(start[d])))
    return spans, items


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _searcher(text: str, out: list[str], item_type: pa.DataType, phrases, shard_words: int):
    """Task body: shards of bounded size, rows passed through with the added
    columns; spans and items found by earlier blocks are merged in."""

    def flush(held):
        spans, items = shard_hits([ids for _, docs in held for ids in docs], phrases.value)
        k = 0
        for batch, docs in held:
            n = len(docs)
            cols = {name: batch.column(name) for name in out if name not in ADDED}
            cols["n_words"] = pa.array([len(d) for d in docs], pa.int64())
            new_spans, new_items = spans[k:k + n], items[k:k + n]
            if "spans" in batch.schema.names:
                new_spans = [merge([(s["start"], s["end"]) for s in old] + new)
                             for old, new in zip(batch.column("spans").to_pylist(), new_spans)]
                new_items = [new | set(old) for old, new in zip(batch.column("items").to_pylist(), new_items)]
            cols["spans"] = pa.array([[{"start": a, "end": b} for a, b in s] for s in new_spans], _SPANS)
            cols["items"] = pa.array([sorted(i) for i in new_items], pa.list_(item_type))
            yield pa.RecordBatch.from_pydict(cols)
            k += n

    def run(batches):
        forget()
        get = phrases.value.vocab.get
        held, total = [], 0
        for batch in batches:
            col = batch.column(text)
            texts = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
            first, docs = 0, []
            for i in range(len(texts)):
                ws = words(texts[i].as_py() or b"")
                docs.append(np.fromiter(map(get, ws, repeat(0)), np.int32, len(ws)))
                total += len(ws)
                if total >= shard_words:
                    yield from flush([*held, (batch.slice(first, i + 1 - first), docs)])
                    held, total, first, docs = [], 0, i + 1, []
            if docs:
                held.append((batch.slice(first), docs))
        if held:
            yield from flush(held)

    return run


def merge(spans):
    """Union of half-open spans, sorted; touching spans are joined."""
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_spans(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
               item_text: str = "text", keep: list[str] | None = None, width: int = 10,
               shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) plus ``n_words``,
    ``spans`` (merged word spans inside occurrences) and ``items`` (ids of the
    items with an occurring phrase, sorted)."""
    spark = docs.sparkSession
    ship_package(spark)
    keep = [c for c in (keep or docs.columns) if c not in ADDED]
    bench = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text"))
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = docs.select(*dict.fromkeys([*keep, text]))
    added = [T.StructField("n_words", T.LongType()), T.StructField("spans", SPAN),
             T.StructField("items", T.ArrayType(bench.schema["item"].dataType))]
    for b in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        phrases = spark.sparkContext.broadcast(Phrases([(r["item"], r["text"]) for r in rows], width))
        names = keep if b == blocks - 1 else [*dict.fromkeys([*keep, text])]
        schema = T.StructType([out.schema[c] for c in names] + added)
        out = out.mapInArrow(_searcher(text, names, to_arrow_type(bench.schema["item"].dataType), phrases, shard_words),
                             schema)
    return out


def _cut(data: str | None, spans) -> str | None:
    if data is None or spans is None or not len(spans):
        return data
    raw = data.encode()
    at = [m.span() for m in _WORD.finditer(raw)]
    out, last = [], 0
    for s in spans:
        out.append(raw[last:at[s["start"]][0]])
        last = at[s["end"] - 1][1]
    out.append(raw[last:])
    return b"".join(out).decode()


def remove_spans(found: DataFrame, *, text: str = "text") -> DataFrame:
    """Cut the spans out of the texts and drop documents left without words.
    Words that only become neighbours by a cut are not searched again."""
    ship_package(found.sparkSession)
    keep = [c for c in found.columns if c not in ADDED]

    def run(batches):
        for batch in batches:
            out = batch.select(keep)
            spans = batch.column("spans").to_pylist()
            if any(spans):
                old = out.column(text)
                hit = [sum(s["end"] - s["start"] for s in ss) for ss in spans]
                new = [_cut(t.as_py(), ss) if ss else t.as_py() for t, ss in zip(old, spans)]
                left = pa.array([h == 0 or h < n for h, n in zip(hit, batch.column("n_words").to_pylist())])
                out = out.set_column(keep.index(text), text, pa.array(new, old.type)).filter(left)
            yield out

    return found.mapInArrow(tidy(run), T.StructType([found.schema[c] for c in keep]))

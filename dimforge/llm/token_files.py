"""Token ids in binary files: frequency-ranked, byte-aligned, variable length.

File format (little-endian), one file per range of documents:

    8 bytes   magic ``DFTOK01\\n``
    u32 u32   number of documents, number of ranks
    u64       number of ids
    u32[]     id of every rank (rank 0 is the file's most frequent id)
    u8[]      1 if the document has an id, else 0
    i64[]     document ids (0 where there is none)
    u32[]     ids per document
    u8[]      control bytes: 2 bits per id, four ids a byte, lowest bits first;
              the value is the number of data bytes minus 1
    u8[]      data bytes: the ranks, 1 to 4 bytes each
    u32       crc32 of all that precedes

Control and data bytes are decoded by numpy with one table lookup per control
byte (the four lengths) and one mask lookup per id.

Documents are range-partitioned by id and sorted, so files follow each other
in ascending id order; ids repeated without end are split too, as the text's
hash and the row's position follow in the sort key.  A task writes a file
whenever ``file_ids`` ids are buffered.  File names are unique per attempt;
the manifest, written through Spark, names those that count.

Tokenising: a text is encoded by the tokenizers library; runs between single
blanks are encoded once and remembered (a boundary before a single blank that
follows and precedes visible characters always separates pre-tokens).  Texts
for which that does not hold go to the library whole.

Defined results: NULL text is empty (only the end id); NULL ids come first;
repeated rows are separate documents; an empty table gives no files and an
empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.storage import REMEMBERED as CACHES
from dimforge.llm.storage import materialize, scratch, ship_package, tidy, write_bytes
from dimforge.operators.joins import broadcast_if_small

MAGIC = b"DFTOK01\n"
FILE_IDS = 4_000_000
REMEMBERED = 250_000
PASSING = 200_000

_WORD_AND_MARKS = re.compile(r"([^\W\d_]+)([^\w\s]+)")

# How byte-level BPE writes bytes as characters: printable Latin-1 as itself,
# the other bytes from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}

_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    r = ranks.astype("<u4")
    n = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    padded = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    padded[:len(r)] = n
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    most = int(n.max(initial=0)) + 1
    used = r.view(np.uint8).reshape(-1, 4)[:, :most]
    data = used[np.arange(most, dtype=np.uint8) <= n[:, None]]
    return control.tobytes(), data.tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    lengths = _LENGTHS[control].reshape(-1)[:n]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    d = np.concatenate([data, np.zeros(3, np.uint8)])
    value = d[at].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        value |= d[at + k].astype(np.uint32) << np.uint32(8 * k)
    return value & _MASKS[lengths]


def pack_file(doc_ids: list, docs: list[np.ndarray]) -> bytes:
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    if len(ids) and ids.max() < 1 << 20:
        present, where = np.arange(int(ids.max()) + 1, dtype=np.uint32), ids
        counts = np.bincount(ids)
    else:
        present, where, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((present, -counts))
    rank = np.empty(len(present), np.uint32)
    rank[order] = np.arange(len(present), dtype=np.uint32)
    order = order[:int((counts > 0).sum())]
    control, data = encode_ranks(rank[where])
    body = b"".join([
        MAGIC, struct.pack("<IIQ", len(docs), len(order), len(ids)), present[order].astype("<u4").tobytes(),
        np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([len(d) for d in docs], "<u4").tobytes(), control, data])
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_file(raw: bytes) -> tuple[list, list[np.ndarray]]:
    if raw[:8] != MAGIC or zlib.crc32(memoryview(raw)[:-4]) != struct.unpack("<I", raw[-4:])[0]:
        raise ValueError("not a token file, or damaged")
    n_docs, n_ranks, n_ids = struct.unpack_from("<IIQ", raw, 8)
    at = 24
    parts = []
    for kind, n in (("<u4", n_ranks), ("u1", n_docs), ("<i8", n_docs), ("<u4", n_docs), ("u1", -(-n_ids // 4))):
        parts.append(np.frombuffer(raw, kind, n, at))
        at += parts[-1].nbytes
    id_of, has, doc_ids, sizes, control = parts
    data = np.frombuffer(raw, "u1", len(raw) - 4 - at, at)
    ids = id_of[decode_ranks(control, data, n_ids)] if n_ids else np.zeros(0, np.uint32)
    docs = np.split(ids, np.cumsum(sizes.astype(np.int64))[:-1]) if n_docs else []
    return [int(d) if h else None for d, h in zip(doc_ids, has)], docs


def _safe(run: str) -> bool:
    """Whether a text may be cut before and after this run: no white space or
    control character at its edges."""
    return bool(run) and run[0].isprintable() and run[-1].isprintable() and run[0] != " " and run[-1] != " "


class _Runs(dict):
    """Encodings of the runs between blanks, all with the same lead.  A run is
    remembered for the life of the worker (at most ``REMEMBERED``) once it has
    come twice among ``PASSING`` new ones; most new runs never come again."""

    def __init__(self, encoder: "Encoder", lead: str):
        super().__init__()
        self.encoder, self.lead, self.passing = encoder, lead, {}

    def resolve(self, run: str) -> bytes | None:
        """Ids of a run that is not remembered; None where a text cannot be
        cut."""
        value = self.again(run)
        if value is None:
            value = self.encoder.simple(run, self)
            if value is None and _safe(run):
                value = self.encoder.whole(self.lead + run)
                self.put(run, value)
        return value

    def again(self, run: str) -> bytes | None:
        """Ids of a run that has passed; from now on it is remembered."""
        value = self.passing.get(run)
        if value is not None and len(self) < REMEMBERED and len(run) < 64:
            self[run] = value
            del self.passing[run]
        return value

    def put(self, run: str, value: bytes) -> None:
        if len(self.passing) >= PASSING:
            self.passing.clear()
        self.passing[run] = value

    def known(self, run: str) -> bytes | None:
        return self.get(run) or self.again(run)


class Encoder:
    """``encode(text)`` -> array of ids, equal to the library's own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [str(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first, self.rest = _Runs(self, ""), _Runs(self, " ")
        # byte-level BPE without a normaliser: a run of letters is one pre-token
        kind = self.tokenizer.pre_tokenizer
        self.plain = (type(kind).__name__ == "ByteLevel" and kind.use_regex and not kind.add_prefix_space
                      and self.tokenizer.normalizer is None)
        self.marks: dict[str, bytes] = {}
        self.feed = self.whole("\n") if self.plain else b""
        self.model_encode = self.tokenizer.model.tokenize

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def simple(self, run: str, runs: _Runs) -> bytes | None:
        """Ids of letters, letters and marks, or two such runs around a line
        feed: there the pre-tokens are certain, and only new letters need the
        library's model.  None for all other runs."""
        if not self.plain:
            return None
        if run.isalpha():
            text = runs.lead + run
            if run.isascii():
                text = text.replace(" ", "\u0120")
            else:
                text = text.encode().decode("latin-1").translate(_BYTE_CHARS)
            value = array("I", [t.id for t in self.model_encode(text)]).tobytes()
            runs.put(run, value)
            return value
        word = _WORD_AND_MARKS.fullmatch(run)
        if word and word[1].isalpha() and not any(c.isalnum() for c in word[2]):
            marks = self.marks.get(word[2])
            if marks is None:
                marks = self.whole(word[2])
                if len(self.marks) < 10_000:
                    self.marks[word[2]] = marks
            value = runs.known(word[1])
            if value is None:                              # a new word's marks are not worth remembering
                return self.simple(word[1], runs) + marks
            runs.put(run, value + marks)
            return value + marks
        before, feed, after = run.partition("\n")
        if feed and _safe(before) and _safe(after):
            a, b = self.part(before, runs), self.part(after, self.first)
            if a is not None and b is not None:
                return a + self.feed + b
        return None

    def part(self, run: str, runs: _Runs) -> bytes | None:
        return runs.known(run) or self.simple(run, runs)

    def encode(self, text: str) -> np.ndarray:
        runs = text.split(" ")
        ids = [*map(self.rest.get, runs)]
        ids[0] = self.first.get(runs[0])
        if None in ids:
            for i, value in enumerate(ids):
                if value is None:
                    ids[i] = (self.rest if i else self.first).resolve(runs[i])
        if None in ids or any(s in text for s in self.special):
            return np.frombuffer(self.whole(text), np.uint32)
        return np.frombuffer(b"".join(ids), np.uint32)


_ENCODERS: dict[str, Encoder] = {}
CACHES.append(_ENCODERS)


def encoder(path: str) -> Encoder:
    """One per Python worker: its memory of runs serves later tasks too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_files(docs: DataFrame, tokenizer: str, end_id: int, *, key: str = "doc_id", text: str = "text",
                file_ids: int = FILE_IDS) -> DataFrame:
    """Write the token files; returns their manifest ``part, seq, name, path,
    n_docs, n_ids``."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = scratch(spark, "tokens")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    order = ["id", "h", "pos"]
    rows = (rows.withColumn("h", F.xxhash64("text")).withColumn("pos", F.monotonically_increasing_id())
                .repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text"))

    def task(batches):
        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        ids, held, total = [], [], 0

        def flush():
            name = write_bytes(folder, f"part-{part:06d}-{seq:04d}", pack_file(ids, held)).rsplit("/", 1)[1]
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "name": [name],
                                               "path": [f"{folder}/{name}"], "n_docs": [len(ids)], "n_ids": [total]})

        for batch in batches:
            for doc, t in zip(batch.column("id").to_pylist(), batch.column("text")):
                ids.append(doc)
                held.append(np.concatenate([enc.encode(t.as_py() or ""), end]))
                total += len(held[-1])
                if total >= file_ids:
                    yield flush()
                    ids, held, total, seq = [], [], 0, seq + 1
        if ids:
            yield flush()

    schema = "part long, seq long, name string, path string, n_docs long, n_ids long"
    return materialize(rows.mapInArrow(tidy(task), schema), "token-manifest")


def read_files(manifest: DataFrame, *, with_ids: bool = True) -> DataFrame:
    """Read the files back: ``doc_id, start`` (ids of all documents before
    it), ``n_tokens``, ``ids_crc32`` (of the ids as little-endian unsigned
    32-bit integers) and, if wanted, those ``ids`` as binary."""
    spark = manifest.sparkSession
    ship_package(spark)
    first = manifest.first()
    out = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "name string, doc_id long, local long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    if first is None:
        return spark.createDataFrame([], schema).withColumn("start", F.col("local")).select(*out)
    folder = first["path"].rsplit("/", 1)[0]
    # ids before a file: those of the parts before its own, and of its part's files before it
    upto = Window.unboundedPreceding, -1
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))             # one row per partition
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*upto)), F.lit(0)).alias("above"))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(*upto)), F.lit(0))
    base = manifest.withColumn("inside", inside).join(broadcast_if_small(parts), "part").select(
        "name", (F.col("above") + F.col("inside")).alias("base"))

    def task(batches):
        for batch in batches:
            for name, raw in zip(batch.column("name").to_pylist(), batch.column("content")):
                doc_ids, docs = unpack_file(raw.as_py())
                sizes = np.array([len(d) for d in docs], np.int64)
                plain = [d.astype("<u4").tobytes() for d in docs]
                cols = {"name": pa.array([name] * len(docs), pa.string()), "doc_id": pa.array(doc_ids, pa.int64()),
                        "local": pa.array(np.cumsum(sizes) - sizes), "n_tokens": pa.array(sizes),
                        "ids_crc32": pa.array([zlib.crc32(p) for p in plain], pa.int64())}
                if with_ids:
                    cols["ids"] = pa.array(plain, pa.binary())
                yield pa.RecordBatch.from_pydict(cols)

    files = (spark.read.format("binaryFile").load(folder)
                  .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))
    counted = files.join(broadcast_if_small(base.select("name")), "name", "left_semi")
    docs = counted.mapInArrow(tidy(task), schema).join(broadcast_if_small(base), "name")
    return docs.withColumn("start", F.col("base") + F.col("local")).select(*out)

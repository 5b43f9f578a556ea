"""Fill-in-the-middle training texts, cut at line boundaries.

A text of ``n`` lines is cut at two of its ``n + 1`` line boundaries, drawn from
a digest of seed and id, and its parts are put out in the order prefix, suffix,
middle (or suffix, prefix, middle) behind a marker each.  A share of the texts,
and every text that is empty or holds a marker, stays plain.

The boundaries of a text (code point offsets of the ends of its lines) are a
:class:`BoundarySet`: containers of 2**16 offsets each, kept as a sorted array,
a bitmap or runs, whichever is smallest, with their cumulative cardinalities.
The offset of the k-th boundary is found by a search among the cumulative
cardinalities and a select inside one container.

Defined results: NULL text is empty, and plain; a NULL id hashes like an empty
one; repeated rows are cut alike; an empty table gives an empty result; the
added columns replace clashing input columns.

Plan: one narrow pass, no shuffle; a text depends on itself and its id only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimforge.llm.storage import forget, ship_package

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")
ARRAY_MOST = 4096            # offsets; beyond, a bitmap is smaller than an array


class ArrayContainer:
    """Sorted low halves of the offsets, two bytes each."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)
        self.nbytes = self.low.nbytes

    def select(self, j: int) -> int:
        return int(self.low[j])

    def rank(self, low: int) -> int:
        return int(np.searchsorted(self.low, low, "right"))


class BitmapContainer:
    """One bit per possible offset."""

    nbytes = 8192

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        self.bytes = np.packbits(bits, bitorder="little")
        self.before = np.cumsum(np.bitwise_count(self.bytes), dtype=np.int64)        # bits up to and in each byte

    def select(self, j: int) -> int:
        at = int(np.searchsorted(self.before, j, "right"))
        inside = j - (int(self.before[at - 1]) if at else 0)
        return at * 8 + int(np.flatnonzero(np.unpackbits(self.bytes[at:at + 1], bitorder="little"))[inside])

    def rank(self, low: int) -> int:
        at, bit = low >> 3, low & 7
        before = int(self.before[at - 1]) if at else 0
        return before + int(self.bytes[at] & ((2 << bit) - 1)).bit_count()


class RunContainer:
    """First offset and length of each run of consecutive offsets."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=low[0] - 2) != 1)
        self.start = low[first].astype(np.uint16)
        self.before = np.append(first, len(low)).astype(np.int64)                    # offsets before each run
        self.nbytes = 4 * len(first)

    def select(self, j: int) -> int:
        run = int(np.searchsorted(self.before, j, "right")) - 1
        return int(self.start[run]) + j - int(self.before[run])

    def rank(self, low: int) -> int:
        run = int(np.searchsorted(self.start, low, "right")) - 1
        if run < 0:
            return 0
        return int(min(self.before[run] + low - int(self.start[run]) + 1, self.before[run + 1]))


def container(low: np.ndarray):
    """The smallest container for ascending offsets below 2**16."""
    runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
    if 4 * runs < min(2 * len(low), BitmapContainer.nbytes):
        return RunContainer(low)
    return ArrayContainer(low) if len(low) <= ARRAY_MOST else BitmapContainer(low)


class BoundarySet:
    """Ascending distinct offsets with select and rank."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        first = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[first]
        self.containers = [container(part & 0xFFFF) for part in np.split(offsets, first[1:])] if len(offsets) else []
        self.before = np.append(first, len(offsets))                                # cumulative cardinalities

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The k-th smallest offset, counted from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.keys[at]) << 16) + self.containers[at].select(k - int(self.before[at]))

    def rank(self, offset: int) -> int:
        """How many offsets are at most ``offset``."""
        if offset < 0:
            return 0
        at = int(np.searchsorted(self.keys, offset >> 16))
        inside = self.containers[at].rank(offset & 0xFFFF) if at < len(self.keys) and self.keys[at] == offset >> 16 else 0
        return int(self.before[at]) + inside


def line_ends(text: str) -> BoundarySet:
    """Where the lines of a text end, in code points; a last line needs no
    line feed."""
    if text.isascii():
        points = np.frombuffer(text.encode("ascii"), np.uint8)
    else:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points == 10) + 1
    if len(points) and points[-1] != 10:
        ends = np.append(ends, len(points))
    return BoundarySet(ends)


def draws(seed: int, key) -> list[int]:
    """Four 32-bit numbers from a digest of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def cut(text: str, key, seed: int, fim_percent: int, spm_percent: int) -> tuple[int, str, int | None, int | None]:
    """Lines, form, and the ends of prefix and middle (None if plain)."""
    ends = line_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(seed, key)
    if not text or h3 % 100 >= fim_percent or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    at = [ends.select(k - 1) if k else 0 for k in (a, b)]
    return n, "spm" if h4 % 100 < spm_percent else "psm", *at


def transform(docs: DataFrame, *, key: str = "doc_id", text: str = "text", keep: list[str] | None = None,
              seed: int = 7, fim_percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """The ``keep`` columns (all by default) plus ``n`` (lines), ``form``
    (``plain psm spm``), ``prefix_chars``, ``middle_chars`` (NULL if plain) and
    ``output``, the training text."""
    ship_package(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    source = docs.select(*[F.col(c) for c in keep], F.col(key).alias("_fim_key"), F.col(text).alias("_fim_text"))
    fields = [source.schema[c] for c in keep] + [
        T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]

    def run(batches):
        forget()
        for batch in batches:
            out = [[] for _ in ADDED]
            for k, t in zip(batch.column("_fim_key").to_pylist(), batch.column("_fim_text")):
                t = t.as_py() or ""
                n, form, a, b = cut(t, k, seed, fim_percent, spm_percent)
                if form == "psm":
                    made = f"{PREFIX}{t[:a]}{SUFFIX}{t[b:]}{MIDDLE}{t[a:b]}"
                elif form == "spm":
                    made = f"{SUFFIX}{t[b:]}{PREFIX}{t[:a]}{MIDDLE}{t[a:b]}"
                else:
                    made = t
                for column, value in zip(out, (n, form, a, None if a is None else b - a, made)):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *map(pa.array, out, kinds)],
                                             names=[*keep, *ADDED])

    return source.mapInArrow(run, T.StructType(fields))


def restore(output: str = "output", form: str = "form") -> Column:
    """The exact text, from output and form alone.  Parts hold no marker, and
    no marker can begin inside one and end in the next."""
    whole, kind = F.col(output), F.col(form)

    def after(marker):
        return F.substring(whole, F.locate(marker, whole) + len(marker), F.length(whole))

    def between(left, right):
        start = F.locate(left, whole) + len(left)
        return F.substring(whole, start, F.locate(right, whole) - start)

    middle = after(MIDDLE)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(kind == "psm", psm).when(kind == "spm", spm).otherwise(whole)

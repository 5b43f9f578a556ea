"""Language-model scoring with Brown class-based n-grams.

Training words are counted with a shuffle over the whole vocabulary.  The
clustering starts from a bounded set of *items*: the ``top_words`` most frequent
words, the ``suffixes`` most frequent endings (last three bytes) that tie the
remaining words, and one item for all others.  Item bigrams are counted over
all training texts; exchange clustering then moves items between ``classes``
as long as the class bigram likelihood rises.  Then every other training word
leaves its ending: the classes before and after it are counted with a shuffle
over the whole vocabulary, and it takes the class that makes them likeliest.
Class sizes and class bigrams are counted again with these classes; only words
never seen in training keep the class of their ending.  A text's probability is
the product over its tokens of class transition times word emission::

    P(w | v) = P(class(w) | class(v)) * (count(w) + 1) / (N_class + V_class + 1)

Transitions are interpolated with the class unigram.

Texts are read and split once, into *chunks* of about ``CHUNK`` tokens: the
chunk's distinct words, and every token as a number among them.  Chunks are
written to the shared folder; all later passes look words up once per chunk and
count on arrays.  Counts and classes of the ``known_words`` most frequent words
travel by broadcast (a fixed bound), and their neighbours are counted in one
matrix per task; other words are shuffled, one row per chunk and word, and what
a word gathers is summed as its rows stream by.  So no list grows with the
corpus, and no word is hot.

Tokens: white-space separated words, ASCII lower-cased, then one end token.
Defined results: NULL and empty texts consist of the end token; a NULL id is
trained on; repeated rows are separate documents; without training texts every
count is 0 and both scores are uniform; clashing extra columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.storage import materialize, ship_package, tidy

END = b"\n"          # cannot be a word
CHUNK = 400_000      # tokens
FILE_CHUNKS = 8      # rows per file: readers hold a file's rows at once
BACKOFF = 0.05       # weight of the class unigram in a transition


def tokens(data: bytes | None) -> list[bytes]:
    ws = (data or b"").lower().split()
    ws.append(END)
    return ws


def _binary(column):
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


class _Numbers(dict):
    """Numbers words as they come; END is 0."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


CHUNKS = ("chunk long, doc_id array<long>, held_out array<boolean>, n_tokens array<int>, words binary, ids binary")


def _encode_chunks(batches):
    part, made = TaskContext.get().partitionId(), 0
    numbers, docs, ids, total = _Numbers(), [], [], 0

    def out():
        doc, held, n = zip(*docs)
        row = [pa.array([(part << 32) + made], pa.int64()), pa.array([doc], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
               pa.array([n], pa.list_(pa.int32())), pa.array([b"\n".join(w for w in numbers if w != END)], pa.binary()),
               pa.array([np.concatenate(ids).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(row, names=["chunk", "doc_id", "held_out", "n_tokens", "words", "ids"])

    for batch in batches:
        for doc, held, t in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), _binary(batch.column("text"))):
            ws = tokens(t.as_py())
            ids.append(np.fromiter(map(numbers.__getitem__, ws), np.int32, len(ws)))
            docs.append((doc, held, len(ws)))
            total += len(ws)
            if total >= CHUNK:
                yield out()
                numbers, docs, ids, total, made = _Numbers(), [], [], 0, made + 1
    if docs:
        yield out()


def _words(raw: bytes) -> list[bytes]:
    """A chunk's words by number."""
    return [END, *raw.split(b"\n")] if raw else [END]


class Chunk:
    """A row of the chunk table."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.words = _words(batch.column("words")[i].as_py()) if "words" in batch.schema.names else None
        self.ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int32)
        self.n = np.array(batch.column("n_tokens")[i].as_py(), np.int64)
        self.held = np.array(batch.column("held_out")[i].as_py(), bool)
        self.start = np.cumsum(self.n) - self.n

    def training(self) -> np.ndarray:
        """Words of the training texts, one text after the other; every text
        ends with END, which is also what precedes the next one."""
        return self.ids if not self.held.any() else self.ids[np.repeat(~self.held, self.n)]


def _each_chunk(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk(batch, i)


def _count_words(batches):
    for chunk in _each_chunk(batches):
        c = np.bincount(chunk.training(), minlength=len(chunk.words))
        some = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([chunk.words[i] for i in some.tolist()], pa.binary()), pa.array(c[some])],
                                         names=["word", "c"])


class Vocabulary:
    """Broadcast part of the model: known words, and items for all others."""

    def __init__(self, known: list[bytes], counts: list[int], n_top: int, suffixes: list[bytes]):
        self.known = {w: i for i, w in enumerate(known)}
        self.counts = np.array(counts, np.int64)
        self.n_known, self.n_top = len(known), min(n_top, len(known))
        self.suffix = {s: self.n_top + i for i, s in enumerate(suffixes)}
        self.n_items = self.n_top + len(suffixes) + 1
        # item of every known word
        self.item = np.array([i if i < self.n_top else self.item_of(w) for i, w in enumerate(known)], np.int64)

    def item_of(self, word: bytes) -> int:
        return self.suffix.get(word[-3:], self.n_items - 1)

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Position among the known words, or ``n_known`` + item."""
        known, suffix, other = self.known, self.suffix, self.n_items - 1
        return np.fromiter((known[w] if w in known else self.n_known + suffix.get(w[-3:], other) for w in words), np.int64, len(words))


def _count_bigrams(shared):
    def run(batches):
        v = shared.value
        item = np.concatenate([v.item, np.arange(v.n_items)])
        end = v.item[v.known[END]] if END in v.known else v.n_items - 1
        total = np.zeros(v.n_items * v.n_items, np.int64)
        for chunk in _each_chunk(batches):
            seq = item[v.codes(chunk.words)][chunk.training()]
            if len(seq):
                total += np.bincount(np.concatenate([[end], seq[:-1]]) * v.n_items + seq, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"a": pa.array(some // v.n_items), "b": pa.array(some % v.n_items),
                                          "n": pa.array(total[some])})
    return run


def exchange_clusters(bigrams: np.ndarray, classes: int, rounds: int = 6) -> np.ndarray:
    """Class of every item, by moving one item at a time to the class that
    raises the class bigram likelihood most."""
    n = len(bigrams)
    classes = min(classes, n)
    freq = bigrams.sum(0) + bigrams.sum(1)
    of = np.empty(n, np.int64)
    of[np.argsort(-freq, kind="stable")] = np.arange(n) % classes

    def h(x):
        return x * np.log(np.maximum(x, 1))

    one = np.zeros((n, classes))
    one[np.arange(n), of] = 1
    trans = one.T @ bigrams @ one
    to_class, from_class = bigrams @ one, (one.T @ bigrams).T   # items x classes
    for _ in range(rounds):
        moved = 0
        for w in np.argsort(-freq, kind="stable"):
            if not freq[w]:
                continue
            old, self_n = of[w], bigrams[w, w]
            r, left = to_class[w].copy(), from_class[w].copy()
            r[old] -= self_n
            left[old] -= self_n
            trans[old, :] -= r
            trans[:, old] -= left
            trans[old, old] -= self_n
            base = h(trans)
            gain_r, gain_l = h(trans + r[None, :]) - base, h(trans + left[:, None]) - base
            diag = np.diagonal(trans)
            gain = (gain_r.sum(1) - np.diagonal(gain_r) + gain_l.sum(0) - np.diagonal(gain_l)
                    + h(diag + r + left + self_n) - h(diag))
            rows, cols = trans.sum(1), trans.sum(0)
            gain -= h(rows + r.sum() + self_n) - h(rows) + h(cols + left.sum() + self_n) - h(cols)
            new = int(np.argmax(gain)) if gain.max() > gain[old] + 1e-9 else old
            trans[new, :] += r
            trans[:, new] += left
            trans[new, new] += self_n
            if new != old:
                of[w] = new
                moved += 1
                to_class[:, old] -= bigrams[:, w]
                to_class[:, new] += bigrams[:, w]
                from_class[:, old] -= bigrams[w, :]
                from_class[:, new] += bigrams[w, :]
        if not moved:
            break
    return of


class Model:
    """Everything a task needs to score, of bounded size."""

    def __init__(self, vocabulary: Vocabulary, of: np.ndarray, bigrams: np.ndarray, distinct: np.ndarray,
                 n_tokens: int, n_words: int):
        classes = int(of.max()) + 1
        one = np.zeros((len(of), classes))
        one[np.arange(len(of)), of] = 1
        trans = one.T @ bigrams @ one
        self.set_transitions(trans)
        size, kinds = trans.sum(0), distinct @ one
        self.vocabulary, self.n_tokens, self.n_words = vocabulary, n_tokens, n_words
        item = np.concatenate([vocabulary.item, np.arange(vocabulary.n_items)])
        self.class_of = of[item]                                     # by lookup value
        self.denominator = np.log10(size + kinds + 1)
        self.log_count = np.concatenate([np.log10(vocabulary.counts + 1), np.zeros(vocabulary.n_items)])
        self.start = self.class_of[vocabulary.known.get(END, len(item) - 1)]
        self.dtype = np.uint8 if classes <= 256 else np.int32        # of a class in a text's row

    def reassign(self, known: np.ndarray, size: np.ndarray, kinds: np.ndarray) -> None:
        """New classes of the known words, tokens and words of every class."""
        self.class_of[:self.vocabulary.n_known] = known
        self.start = self.class_of[self.vocabulary.known.get(END, len(self.class_of) - 1)]
        self.denominator = np.log10(size + kinds + 1)

    def set_transitions(self, trans: np.ndarray) -> None:
        classes = len(trans)
        unigram = (trans.sum(0) + 0.5) / (trans.sum() + 0.5 * classes)
        rows = trans.sum(1, keepdims=True)
        direct = np.where(rows > 0, trans / np.maximum(rows, 1), unigram[None, :])
        self.transition = np.log10((1 - BACKOFF) * direct + BACKOFF * unigram[None, :])


def _packed(words: list[bytes], row: np.ndarray, code: np.ndarray, n: np.ndarray, codes: int) -> pa.RecordBatch:
    """One row per word: its codes, each packed with its count.  ``row``:
    ascending position among ``words``."""
    some, first = np.unique(row, return_index=True)
    offsets = np.append(first, len(row)).astype(np.int32) * 8
    packed = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(n.astype(np.int64) * codes + code)])
    return pa.RecordBatch.from_arrays([pa.array([words[i] for i in some.tolist()], pa.binary()), packed], names=["word", "packed"])


def _count_neighbours(shared):
    """Per word outside the top words: the classes before it (codes from 0) and
    after it (codes from the number of classes), each packed with its count;
    known words once per task, others once per chunk."""
    def run(batches):
        m = shared.value
        v, classes = m.vocabulary, len(m.transition)
        codes = 2 * classes
        matrix = np.zeros((v.n_known, codes), np.int32)                # tokens of one task
        for chunk in _each_chunk(batches):
            at = v.codes(chunk.words)
            seq = chunk.training()
            cls = m.class_of[at][seq]
            tail = np.flatnonzero((at >= v.n_top)[seq])                # END, a top word, ends every text
            if not len(tail):
                continue
            word, before = seq[tail].astype(np.int64) * codes, np.where(tail > 0, cls[tail - 1], m.start)
            key, n = np.unique(np.concatenate([word + before, word + classes + cls[tail + 1]]), return_counts=True)
            row, code = key // codes, key % codes
            known = (at < v.n_known)[row]
            matrix[at[row[known]], code[known]] += n[known]
            rare = ~known
            if rare.any():
                yield _packed(chunk.words, row[rare], code[rare], n[rare], codes)
        names = list(v.known)
        for low in range(0, v.n_known, 1000):
            part = matrix[low:low + 1000]
            row, code = np.nonzero(part)
            if len(row):
                yield _packed(names[low:low + 1000], row, code, part[row, code], codes)
    return run


def _best_classes(shared):
    """Rows sorted by word -> each word with its count and best class."""
    def run(batches):
        m = shared.value
        classes = len(m.transition)
        codes = 2 * classes
        gain = np.vstack([m.transition, m.transition.T])               # code x class of the word
        held, held_sums = None, None                                   # the last word, which may go on in the next batch

        def out(words, sums):
            c = sums[:, :classes].sum(1)
            best = np.argmax(sums @ gain - c[:, None] * m.denominator[None, :], 1)
            return pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary()), "c": pa.array(c.astype(np.int64)),
                                               "class": pa.array(best, pa.int32())})

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                words = batch.column("word").slice(at, 4096).to_pylist()
                data = batch.column("packed").slice(at, 4096).to_pylist()
                new = np.array([i == 0 or words[i] != words[i - 1] for i in range(len(words))])
                packed = np.frombuffer(b"".join(data), np.int64)
                of = np.repeat(np.cumsum(new) - 1, [len(d) // 8 for d in data])
                sums = np.bincount(of * codes + packed % codes, packed // codes, int(new.sum()) * codes).reshape(-1, codes)
                names = [w for w, first in zip(words, new) if first]
                if held is not None:
                    if names[0] == held:
                        sums[0] += held_sums
                    else:
                        names, sums = [held, *names], np.vstack([held_sums, sums])
                if len(names) > 1:
                    yield out(names[:-1], sums[:-1])
                held, held_sums = names[-1], sums[-1]
        if held is not None:
            yield out([held], held_sums[None, :])
    return run


def _most_frequent(words: DataFrame, n: int) -> DataFrame:
    """The n most frequent words, END first, whatever its rank.  A histogram of
    the counts (bounded: exact to 1,024, then 16 steps per doubling) gives a
    count that at least n words reach; only those are sorted."""
    step = F.when(F.col("c") <= 1024, F.col("c")).otherwise(F.floor(864 + 16 * F.log2("c")).cast("long"))
    steps = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")).collect()
    reach, low = 0, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        reach, low = reach + r["k"], r["step"]
        if reach >= n:
            break
    some = words.where((step >= low) | (F.col("word") == F.lit(END)))
    return some.orderBy((F.col("word") != F.lit(END)).cast("int"), F.desc("c"), "word").limit(n)


def _encode(docs: DataFrame) -> DataFrame:
    """The chunk table of ``(doc_id, held_out, text)`` rows, written once."""
    ship_package(docs.sparkSession)
    rows = docs.select("doc_id", "held_out", "text")
    return materialize(rows.mapInArrow(tidy(_encode_chunks), CHUNKS), "brown-chunks", FILE_CHUNKS, "zstd")


def _classify(chunks: DataFrame, classes: int, top_words: int, suffixes: int,
              known_words: int) -> tuple[DataFrame, Model]:
    """All training words (``word, c, class``), and the model but for its
    transitions, which are still those between items."""
    spark = chunks.sparkSession
    need = chunks.select("held_out", "n_tokens", "words", "ids")
    counts = materialize(need.mapInArrow(tidy(_count_words), "word binary, c long")
                             .groupBy("word").agg(F.sum("c").alias("c")), "brown-counts")
    n_words, n_tokens = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    top = _most_frequent(counts, known_words).toArrow()
    known, known_counts = top.column("word").to_pylist(), top.column("c").to_pylist()
    names = spark.createDataFrame([(bytearray(w),) for w in known[:top_words]], "word binary")
    tail = counts.join(F.broadcast(names), "word", "left_anti").groupBy(F.expr("substring(word, -3)").alias("s"))
    tail = materialize(tail.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("kinds")), "brown-suffixes")
    best = tail.orderBy(F.desc("n"), "s").limit(suffixes).collect()
    vocabulary = Vocabulary(known, known_counts, top_words, [bytes(r["s"]) for r in best])
    shared = spark.sparkContext.broadcast(vocabulary)
    pairs = (need.mapInArrow(tidy(_count_bigrams(shared)), "a long, b long, n long")
                 .groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow())      # at most items ** 2
    bigrams = np.zeros((vocabulary.n_items, vocabulary.n_items))
    bigrams[pairs.column("a").to_numpy(), pairs.column("b").to_numpy()] = pairs.column("n").to_numpy()
    del pairs
    of = exchange_clusters(bigrams, classes)
    distinct = np.zeros(vocabulary.n_items)
    distinct[:vocabulary.n_top] = 1
    for i, r in enumerate(best):
        distinct[vocabulary.n_top + i] = r["kinds"]
    distinct[-1] = max(0, n_words - distinct.sum())
    model = Model(vocabulary, of, bigrams, distinct, n_tokens, n_words)
    # every other word to its best class
    shared = spark.sparkContext.broadcast(model)
    near = need.mapInArrow(tidy(_count_neighbours(shared)), "word binary, packed binary").repartition("word").sortWithinPartitions("word")
    fixed = [(bytearray(w), c, int(k)) for w, c, k in zip(known[:top_words], known_counts, model.class_of)]
    words = materialize(near.mapInArrow(tidy(_best_classes(shared)), "word binary, c long, class int")
                            .unionByName(spark.createDataFrame(fixed, "word binary, c long, class int")), "brown-classes")
    ours = spark.createDataFrame([(bytearray(w),) for w in known], "word binary")
    got = words.join(F.broadcast(ours), "word", "left_semi").toArrow()          # at most `known_words` rows
    class_of = dict(zip(got.column("word").to_pylist(), got.column("class").to_pylist()))
    size, kinds = np.zeros((2, len(model.transition)))
    for r in words.groupBy("class").agg(F.sum("c").alias("size"), F.count(F.lit(1)).alias("kinds")).collect():
        size[r["class"]], kinds[r["class"]] = r["size"], r["kinds"]
    model.reassign(np.array([class_of[w] for w in known], np.int64), size, kinds)
    return words, model


def _rare_words(shared):
    """The words of a chunk that the broadcast model does not know."""
    def run(batches):
        v = shared.value.vocabulary
        for batch in batches:
            for i, chunk in enumerate(batch.column("chunk").to_pylist()):
                rare = [(n, w) for n, w in enumerate(_words(batch.column("words")[i].as_py())) if w not in v.known]
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(rare), pa.int64()), pa.array([n for n, _ in rare], pa.int32()),
                                                  pa.array([w for _, w in rare], pa.binary())], names=["chunk", "number", "word"])
    return run


def _code_words(shared):
    """Chunks with their words' codes in place of the words."""
    def run(batches):
        v = shared.value.vocabulary
        kind = np.uint16 if v.n_known + v.n_items <= 1 << 16 else np.int32
        names = ["chunk", "doc_id", "held_out", "n_tokens", "ids"]
        for batch in batches:
            codes = [v.codes(_words(raw.as_py())).astype(kind).tobytes() for raw in batch.column("words")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(codes, pa.binary())], names=[*names, "codes"])
    return run


ENCODED = ("doc_id array<long>, held_out array<boolean>, n_tokens array<int>, n_known array<long>, logs array<double>, seq binary")


def _name_classes(shared):
    """Chunks, with what was found of their rare words -> the class of every
    token, and per text its known tokens and the sum of their log counts."""
    def run(batches):
        m = shared.value
        v = m.vocabulary
        kind = np.uint16 if v.n_known + v.n_items <= 1 << 16 else np.int32
        for batch in batches:
            found = batch.column("found")
            for i in range(batch.num_rows):
                chunk = Chunk(batch, i)
                at = np.frombuffer(batch.column("codes")[i].as_py(), kind).astype(np.int64)
                cls, logs, known = m.class_of[at], m.log_count[at], at < v.n_known
                if found[i].is_valid:
                    x = found[i].values
                    number = x.field("number").to_numpy()
                    cls[number], logs[number] = x.field("class").to_numpy(), np.log10(x.field("c").to_numpy() + 1)
                    known[number] = True
                each = [pa.array([batch.column(c)[i].as_py()], k) for c, k in (
                    ("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("n_tokens", pa.list_(pa.int32())))]
                n_known = np.add.reduceat(known[chunk.ids].astype(np.int64), chunk.start)
                total = np.add.reduceat(logs[chunk.ids], chunk.start)
                yield pa.RecordBatch.from_arrays(
                    [*each, pa.array([n_known], pa.list_(pa.int64())), pa.array([total], pa.list_(pa.float64())),
                     pa.array([cls[chunk.ids].astype(m.dtype).tobytes()], pa.binary())],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "seq"])
    return run


def _named(chunks: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """Classes of all tokens by chunk: the words that the broadcast model does
    not know meet the vocabulary in a join, then their chunk."""
    shared = chunks.sparkSession.sparkContext.broadcast(model)
    rare = chunks.select("chunk", "words").mapInArrow(tidy(_rare_words(shared)), "chunk long, number int, word binary")
    found = (rare.join(words, "word").groupBy("chunk")
                 .agg(F.collect_list(F.struct("number", "c", "class")).alias("found")))      # at most a chunk's words
    coded = chunks.mapInArrow(tidy(_code_words(shared)), CHUNKS.replace("words binary, ids binary", "ids binary, codes binary"))
    return coded.join(found, "chunk", "left").mapInArrow(tidy(_name_classes(shared)), ENCODED)


def _count_transitions(n: int, kind):
    def run(batches):
        total = np.zeros(n * n, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                seq = np.frombuffer(batch.column("seq")[i].as_py(), kind).astype(np.int64)
                held = np.array(batch.column("held_out")[i].as_py(), bool)
                seq = seq[np.repeat(~held, np.array(batch.column("n_tokens")[i].as_py(), np.int64))]
                if len(seq):                  # every text ends with END, which is also what precedes the next one
                    total += np.bincount(np.concatenate([seq[-1:], seq[:-1]]) * n + seq, minlength=n * n)
        yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(n * n)), "n": pa.array(total)})
    return run


def _set_transitions(encoded: DataFrame, model: Model) -> None:
    n = len(model.transition)
    got = (encoded.select("held_out", "n_tokens", "seq").mapInArrow(tidy(_count_transitions(n, model.dtype)), "k long, n long")
                  .groupBy("k").agg(F.sum("n").alias("n")).toArrow())
    trans = np.zeros(n * n)
    trans[got.column("k").to_numpy()] = got.column("n").to_numpy()
    model.set_transitions(trans.reshape(n, n))


def fit(train: DataFrame, *, classes: int = 48, top_words: int = 800, suffixes: int = 400,
        known_words: int = 40_000) -> tuple[DataFrame, Model]:
    """All training words with count and class (``word, c, class``) and the
    model, from the ``text`` column of ``train``."""
    chunks = _encode(train.select(F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), "text"))
    words, model = _classify(chunks, classes, top_words, suffixes, known_words)
    _set_transitions(_named(chunks, words, model), model)
    return words, model


def fit_score(docs: DataFrame, *, classes: int = 48, top_words: int = 800, suffixes: int = 400,
              known_words: int = 40_000) -> DataFrame:
    """:func:`score` of all rows by the :func:`fit` to those not held out; the
    texts are split and the classes of rare words joined once for both."""
    chunks = _encode(docs)
    words, model = _classify(chunks, classes, top_words, suffixes, known_words)
    encoded = materialize(_named(chunks, words, model), "brown-encoded")
    _set_transitions(encoded, model)
    return _score(encoded, model)


def _score_classes(shared):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "logs"]

    def run(batches):
        m = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                seq = np.frombuffer(batch.column("seq")[i].as_py(), m.dtype).astype(np.int64)
                n = np.array(batch.column("n_tokens")[i].as_py(), np.int64)
                # what precedes the chunk is END, as before every text
                each = m.transition[np.concatenate([[m.start], seq[:-1]]), seq] - m.denominator[seq]
                total = np.add.reduceat(each, np.cumsum(n) - n)
                columns = [batch.column(c)[i].values for c in names]
                columns[2] = columns[2].cast(pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(total)], names=[*names, "classes"])

    return run


def _score(encoded: DataFrame, model: Model) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    per = encoded.mapInArrow(_score_classes(shared), "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                                     "logs double, classes double")
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(model.n_tokens + model.n_words + 1)))
    return per.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"),
                      base.alias("base_score"), (F.col("logs") + F.col("classes")).alias("score"))


def score(docs: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """Scores of ``(doc_id, held_out, text)`` rows: ``doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score`` (log10)."""
    return _score(_named(_encode(docs), words, model), model)

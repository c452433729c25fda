"""Interpolated modified Kneser-Ney language model, counted in Spark and kept as sorted hash arrays.

Tokens are runs of characters other than white space ([space, tab to CR]), A-Z lower-cased, and one end for each text; a
context that reaches before the text is filled with a begin mark. The highest order counts occurrences, every lower order
the different words seen before a gram, each with discounts of its own for counts of one, two and more; the unigrams
are interpolated with 1 / (V + 1), so an unknown word has a probability too.

Where things are: words are sorted 64-bit hashes in range parts, with counts and ids; ids begin with the frequent words, so
that packed rows are short. The grams of an order lie in
buckets of the last context word, which all orders of a token share; a word with more occurrences than a quarter of a
bucket is split by the word before it. Each bucket is one file of sorted context hashes, words and counts in the shared folder
(`hash_arrays`), written by the task that merges it. Tasks hand packed rows on, so the counting costs one shuffle for each
order, of grams that every task has already added up.

Scoring sends the grams of a text to their buckets, where a task maps the few files it needs, and only sums for each text
come back: a task never reads the whole model, however large. A frequent gram makes more rows, not larger ones, and those of
one bucket are dealt to several tasks. The more buckets, the shorter and more numerous the rows of a block of texts; so a task
scores rows of one bucket together, up to FLUSH grams, and adds the sums of a block up over all of its buckets.

Defined results: null and empty texts are one end token; repeated rows and ids are scored each on its own; a null id
counts as an empty one for the split; without training texts every probability is 1 / (V + 1) = 1; an empty table gives
no rows; extra columns are not read. Texts are used whole (one text is tokenised in one step). Two words share an id if
their 64-bit hashes are equal (expected below one pair up to some 10^9 words).
"""

from __future__ import annotations

import dataclasses
import functools
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showledger.session import delete_below, shared_dir

from . import hash_arrays
from .common import blocks, clean_text, crc_mod, cut_lineage, dropped_shuffles, mix
from .winnowing import words

ORDER = 3
#: Text (bytes) for each bucket of grams, and for each range part of the words.
BUCKET_BYTES, PART_BYTES = 8 << 20, 64 << 20
#: Grams that a task adds up before it hands them on.
FLUSH = 1 << 19
#: Tasks that may share the rows of one bucket, and runs of buckets that tasks work on, where there are more buckets.
SLICES, RUNS = 4, 64
#: Tokens of a block for each bucket, within FLUSH and four times that.
BLOCK_TOKENS = 2048
#: Sums of texts that wait in a task.
WAITING = 1 << 22
#: Hash of the end of a text; no word's bytes are hashed to get it.
END = np.uint64(0x5851F42D4C957F2D)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Discounts where the counts of counts don't give any.
FALLBACK = (0.5, 1.0, 1.5)

_TOKEN = np.arange(256, dtype=np.uint8)
_TOKEN[0x41:0x5B] += 32
_TOKEN[[0x20, *range(0x09, 0x0E)]] = 0
_TOKEN[0] = 0x20  # a NUL is part of a word; the space stands for it

PACKED = "bucket int, payload binary"


# -- packed rows -------------------------------------------------------------------------

def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of equal length and values from 0 on, each with as few bytes a value as it needs, by byte planes."""
    n, parts, sizes = len(columns[0]), [], []
    for c in columns:
        kind = np.min_scalar_type(int(c.max(initial=0)))
        sizes.append(kind.itemsize)
        parts.append(np.ascontiguousarray(c.astype(kind)[:, None].view(np.uint8).T).tobytes())
    return struct.pack(f"<QB{len(columns)}B", n, len(columns), *sizes) + zstandard.compress(b"".join(parts), 1)


def unpack(raw: bytes) -> list[np.ndarray]:
    n, k = struct.unpack_from("<QB", raw)
    sizes = struct.unpack_from(f"<{k}B", raw, 9)
    body = np.frombuffer(zstandard.decompress(raw[9 + k :], max_output_size=max(1, n * sum(sizes))), np.uint8)
    out, at = [], 0
    for s in sizes:
        out.append(np.ascontiguousarray(body[at : at + n * s].reshape(s, n).T).view(f"<u{s}").ravel().astype(np.int64))
        at += n * s
    return out


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of each row."""
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = mix(h * _STEP + c.astype(np.uint64) + np.uint64(1))
    return h


def summed(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Different rows and the sum of `n` over each."""
    order = np.argsort(_hash(columns))  # one sort, of the hashes
    columns = [c[order] for c in columns]
    first = np.ones(len(order), bool)
    first[1:] = functools.reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(first)
    return [c[at] for c in columns], np.add.reduceat(n[order], at) if len(at) else n[:0]


class Adder:
    """Adds rows up in bounded memory: as many rows wait as there are different ones, or FLUSH if that is more."""

    def __init__(self):
        self.parts, self.waiting, self.different = [], 0, 0

    def add(self, columns: list[np.ndarray], n: np.ndarray) -> None:
        self.parts.append((columns, n))
        self.waiting += len(n)
        if self.waiting > max(FLUSH, self.different) and len(self.parts) > 1:
            whole = self.take()
            self.parts, self.waiting, self.different = [whole], 0, len(whole[1])

    def rows(self) -> int:
        return self.waiting + self.different

    def take(self) -> tuple[list[np.ndarray], np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*(p[0] for p in self.parts))]
        made = summed(columns, np.concatenate([p[1] for p in self.parts]))
        self.parts, self.waiting, self.different = [], 0, 0
        return made


def _dealt(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed rows) of each bucket that has rows; rows keep their order."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
    for a, b in zip(at, [*at[1:], len(bucket)]):
        yield int(bucket[a]), pack([c[order[a:b]] for c in columns])


def _rows(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())], ["bucket", "payload"])


def _merged(df: DataFrame, parts: int, done: Callable[[int, list[np.ndarray], np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Add up the packed rows of each bucket (last column: counts) and hand them to `done`, one bucket at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, Adder()
        for batch in batches:
            for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now and now is not None:
                    yield from done(now, *held.take())
                now = bucket
                *columns, n = unpack(payload.as_py())
                held.add(columns, n)
        if now is not None:
            yield from done(now, *held.take())

    return df.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


# -- tokens ------------------------------------------------------------------------------

def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every token of a block of texts, ends included."""
    h, _, _, text, _ = words(raw, offsets, _TOKEN)
    n = np.bincount(text, minlength=len(offsets) - 1) + 1
    own = np.repeat(np.arange(len(n)), n)
    last = np.cumsum(n) - 1
    out = np.empty(len(own), np.uint64)
    inner = np.ones(len(own), bool)
    inner[last] = False
    out[inner], out[last] = h, END
    return out, own


def grams(ids: np.ndarray, own: np.ndarray, order: int, begin: int) -> list[np.ndarray]:
    """The `order` words that end at each token; before the text there are begin marks."""
    out = []
    for back in range(order - 1, 0, -1):
        c = np.full(len(ids), begin, np.int64)
        if len(ids) > back:
            same = own[back:] == own[:-back]
            c[back:][same] = ids[:-back][same]
        out.append(c)
    return [*out, ids]


# -- the model ---------------------------------------------------------------------------

@dataclasses.dataclass(frozen=True)
class Model:
    """What every task needs to know of a model; all else is in the files of `folder`."""

    folder: str
    order: int
    buckets: int
    sizes: tuple[int, ...]  # words in each range part
    tokens: int
    split: tuple[int, ...]  # ids of words whose grams are split by the word before
    discounts: tuple[tuple[float, float, float], ...] = ()  # of orders 1, 2, ...
    unigrams: tuple[float, float] = (0.0, 1.0)  # sum of continuation counts, weight of 1 / (V + 1)

    @property
    def span(self) -> int:
        """Ids in each file of continuation counts."""
        return max(1, -(-self.n_words // len(self.sizes)))

    @property
    def n_words(self) -> int:
        return sum(self.sizes)

    @property
    def unknown(self) -> int:
        return self.n_words

    @property
    def begin(self) -> int:
        return self.n_words + 1

    def bucket(self, columns: list[np.ndarray]) -> np.ndarray:
        """Bucket of grams: by the last word of the context, and by the word before it where that one is frequent."""
        b = columns[-2]
        h = _hash([b])
        if len(columns) > 2 and self.split:
            hot = np.isin(b, np.array(self.split))
            h[hot] = _hash([b[hot], columns[-3][hot]])
        return (h % np.uint64(self.buckets)).astype(np.int64)

    def context(self, columns: list[np.ndarray]) -> np.ndarray:
        """Key of contexts: the words themselves up to two (the last one first), a hash of longer ones."""
        if len(columns) > 2:
            return _hash(columns)
        before = columns[0] if len(columns) == 2 else np.zeros(len(columns[-1]), np.int64)
        return columns[-1].astype(np.uint64) * np.uint64(self.n_words + 2) + before.astype(np.uint64)

    def path(self, kind: str, number: int) -> str:
        return f"{self.folder}/{kind}-{number}"


class Words:
    """Ids and counts of words, from the mapped range parts."""

    def __init__(self, model: Model):
        self.model, self.parts = model, [
            hash_arrays.load(model.path("words", i)) | hash_arrays.load(model.path("ids", i)) if n else None for i, n in enumerate(model.sizes)]

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of each hash: the unknown id and 0 for unseen ones. Every part is searched in order of the hashes."""
        asked, back = np.unique(h, return_inverse=True)
        ids, n = np.full(len(asked), self.model.unknown, np.int64), np.zeros(len(asked), np.int64)
        edge = np.searchsorted(part_of(asked, len(self.parts)), np.arange(len(self.parts) + 1))
        for i, held in enumerate(self.parts):
            if held is None or edge[i] == edge[i + 1]:
                continue
            at, known = hash_arrays.find(asked[edge[i] : edge[i + 1]], held["key"])
            where = np.flatnonzero(known) + edge[i]
            ids[where], n[where] = held["id"][at[known]], held["n"][at[known]]
        return ids[back], n[back]


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Range part of a hash; ascending hashes have ascending parts."""
    return (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


_WORDS: dict[str, Words] = {}


def _words_of(model: Model) -> Words:
    if model.folder not in _WORDS:
        _WORDS.clear()
        _WORDS[model.folder] = Words(model)
    return _WORDS[model.folder]


def _count_words(docs: DataFrame, folder: str, parts: int, frequent: float) -> tuple[list[int], int, list[int]]:
    """Write the range parts; (words in each, tokens, ids of the frequent words)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Adder()

        def out() -> pa.RecordBatch:
            key, n = _by_value(*held.take())
            return _rows([(p, _pack_hashes(key[a:b], n[a:b])) for p, a, b in _runs(part_of(key, parts))])

        for batch in batches:
            for _, _, raw, offs in blocks(batch.column(0)):
                key, n = np.unique(tokens(raw, offs)[0], return_counts=True)
                held.add([key], n)
                if held.rows() > 2 * FLUSH:
                    yield out()
        if held.parts:
            yield out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, Adder()

        def done() -> pa.RecordBatch:
            key, n = _by_value(*held.take())
            hash_arrays.write(f"{folder}/words-{now}", {"key": key, "n": n.astype(np.min_scalar_type(int(n.max())))})
            kinds = np.bincount(_kind(n), minlength=KINDS)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([kinds.tolist()], pa.list_(pa.int64())), pa.array([int(n.sum())], pa.int64())], ["part", "kinds", "tokens"])

        for batch in batches:
            for part, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != now and now is not None:
                    yield done()
                now = part
                key, n = _unpack_hashes(payload.as_py())
                held.add([key], n)
        if now is not None:
            yield done()

    counted = docs.select(clean_text().alias("text")).mapInArrow(count, PACKED)
    made = counted.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(merge, "part int, kinds array<long>, tokens long")
    kinds, total = np.zeros((parts, KINDS), np.int64), 0
    for part, found, seen in made.collect():  # one row a part
        kinds[part] = found
        total += seen
    # ids by kind (frequent words first), then by part, then by hash
    first = (np.cumsum(kinds.T.ravel()) - kinds.T.ravel()).reshape(KINDS, parts)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                held = hash_arrays.load(f"{folder}/words-{part}", missing=True)
                if held is not None:
                    kind = _kind(held["n"])
                    order = np.argsort(kind, kind="stable")
                    ids = np.empty(len(kind), np.int64)
                    ids[order] = np.arange(len(kind)) - (np.cumsum(kinds[part]) - kinds[part])[kind[order]] + first[kind[order], part]
                    hash_arrays.write(f"{folder}/ids-{part}", {"id": ids.astype(np.min_scalar_type(int(kinds.sum())))})
                    yield pa.RecordBatch.from_arrays([pa.array(ids[held["n"] > frequent])], ["id"])

    hot = docs.sparkSession.range(parts).mapInArrow(number, "id long").collect()  # words with a share of the tokens above a bound
    return kinds.sum(axis=1).tolist(), total, sorted(r[0] for r in hot)


#: Kinds of words by the size of their counts in bits, the largest first.
KINDS = 64


def _kind(n: np.ndarray) -> np.ndarray:
    return KINDS - 1 - np.log2(n.astype(float)).astype(np.int64)


def _by_value(columns: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(columns[0])
    return columns[0][order], n[order]


def _runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, begin, end) of runs of equal values."""
    at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return [(int(values[a]), int(a), int(b)) for a, b in zip(at, [*at[1:], len(values)])]


def _pack_hashes(key: np.ndarray, n: np.ndarray) -> bytes:
    return struct.pack("<Q", len(key)) + key.astype("<u8").tobytes() + pack([n])


def _unpack_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = struct.unpack_from("<Q", raw)[0]
    return np.frombuffer(raw, "<u8", n, 8).astype(np.uint64), unpack(raw[8 + 8 * n :])[0]


def _counted_grams(docs: DataFrame, model: Model) -> DataFrame:
    """Packed grams of the highest order with their counts, added up in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = _words_of(model), Adder()

        def out() -> pa.RecordBatch:
            columns, n = held.take()
            return _rows(list(_counted(model, columns, n)))

        for batch in batches:
            for _, _, raw, offs in blocks(batch.column(0)):
                h, own = tokens(raw, offs)
                found = grams(known.look(h)[0], own, model.order, model.begin)
                held.add(found, np.ones(len(h), np.int64))
                if held.rows() > 2 * FLUSH:
                    yield out()
        if held.parts:
            yield out()

    return docs.select(clean_text().alias("text")).mapInArrow(run, PACKED)


def _counted(model: Model, columns: list[np.ndarray], n: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Grams and counts for their buckets, by ascending contexts, which pack well."""
    order = np.argsort(model.context(columns[:-1]))
    columns = [c[order] for c in columns]
    return _dealt(model.bucket(columns), [*columns, n[order]])


def _write_grams(model: Model, order: int, number: int, columns: list[np.ndarray], n: np.ndarray) -> None:
    wide = model.n_words + 2
    context, place = np.unique(model.context(columns[:-1]), return_inverse=True)
    at = np.argsort(place * wide + columns[-1])
    kept = {"context": context} if order > 3 else {"last": (context // np.uint64(wide)).astype(np.min_scalar_type(wide)), "before": (context % np.uint64(wide)).astype(np.min_scalar_type(wide))}
    if order < 4:  # the last word of ascending contexts repeats, and without a word before it is all there is
        last, runs = np.unique(kept["last"], return_counts=True)
        kept = {"last": last, **_short("runs", runs), "before": kept["before"]} if order == 3 else {"last": last}
    hash_arrays.write(model.path(f"grams{order}", number), {
        **kept, **_short("followers", np.bincount(place)), "word": columns[-1][at].astype(np.min_scalar_type(wide)), **_short("n", n[at])})


def _short(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    """Counts as one byte each; 255 stands for those from there on, which are kept apart."""
    big = np.flatnonzero(values >= 255)
    return {name: np.minimum(values, 255).astype(np.uint8), name + "_at": big.astype(np.uint32), name + "_big": values[big].astype(np.int64)}


def _long(held: dict[str, np.ndarray], name: str) -> np.ndarray:
    out = held[name].astype(np.int64)
    out[held[name + "_at"]] = held[name + "_big"]
    return out


def _build(docs: DataFrame, model: Model) -> None:
    """Write the buckets of all orders from the highest down, and the continuation counts of the words."""
    rows = _counted_grams(docs, model)
    for order in range(model.order, 1, -1):
        def done(number: int, columns: list[np.ndarray], n: np.ndarray, order: int = order) -> Iterator[pa.RecordBatch]:
            _write_grams(model, order, number, columns, n)
            shorter, kinds = summed(columns[1:], np.ones(len(n), np.int64))  # words before each shorter gram
            if order > 2:
                yield _rows(list(_counted(model, shorter, kinds)))
            else:
                yield _rows(list(_dealt(shorter[0] // model.span, [shorter[0] % model.span, kinds])))

        rows = _merged(rows, model.buckets, done, PACKED)

    def last(number: int, columns: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(model.span, np.int64)
        whole[columns[0]] = n
        hash_arrays.write(model.path("before", number), {"n": whole.astype(np.min_scalar_type(int(n.max())))})
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32())], ["part"])

    _merged(rows, len(model.sizes), last, "part int").agg(F.count(F.lit(1))).collect()


def _counts_of_counts(spark: SparkSession, model: Model) -> np.ndarray:
    """Grams of each order that have count 1, 2, 3, 4, and (for order 1) the sum of the counts and words of 3 or more."""
    files = [(k, i) for k in range(2, model.order + 1) for i in range(model.buckets)] + [(1, i) for i in range(len(model.sizes))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((model.order + 1, 6), np.int64)
        for batch in batches:
            for at in batch.column(0).to_pylist():
                k, i = files[at]
                held = hash_arrays.load(model.path(f"grams{k}" if k > 1 else "before", i), missing=True)
                if held is not None:
                    n = _long(held, "n") if k > 1 else held["n"]  # places beyond the last word hold 0
                    total[k, :4] += np.bincount(np.minimum(n, 5), minlength=6)[1:5]
                    total[k, 4] += int(n.sum(dtype=np.int64))
                    total[k, 5] += int((n > 2).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(model.order + 1)), pa.array(total.tolist(), pa.list_(pa.int64()))], ["order", "n"])

    found = spark.range(len(files)).mapInArrow(run, "order long, n array<long>").select("order", F.posexplode("n").alias("i", "n")).groupBy("order", "i").agg(F.sum("n")).collect()
    out = np.zeros((model.order + 1, 6), np.int64)
    for k, i, n in found:
        out[k, i] = n
    return out


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more."""
    if not (n1 and n2 and n3 and n4):
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    made = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    # a discount of nothing would leave nothing for words that a context has not seen
    return made if all(0 < d <= i + 1 for i, d in enumerate(made)) else FALLBACK


def train(docs: DataFrame, folder: str, order: int = ORDER, bucket_bytes: int = BUCKET_BYTES, part_bytes: int = PART_BYTES) -> Model:
    """Count the texts of `docs` into the files of `folder` (a new folder that all workers reach)."""
    if order < 2:
        raise ValueError("the order must be at least 2")
    size = docs.agg(F.coalesce(F.sum(F.octet_length(clean_text()) + 1), F.lit(0))).first()[0]
    parts, buckets = max(1, -(-size // part_bytes)), max(1, -(-size // bucket_bytes))
    with dropped_shuffles(docs.sparkSession):  # those of the counting are as large as the texts
        sizes, total, hot = _count_words(docs, folder, parts, bucket_bytes / 6 / 4)  # a token has some six bytes
        model = Model(folder, order, buckets, tuple(sizes), total, tuple(hot))
        if not total:
            return model
        _build(docs, model)
    n = _counts_of_counts(docs.sparkSession, model)
    d = tuple(discounts(*(int(x) for x in n[k, :4])) for k in range(1, order + 1))
    free = sum(a * float(b) for a, b in zip(d[0], (n[1, 0], n[1, 1], n[1, 5])))
    return dataclasses.replace(model, discounts=d, unigrams=(float(n[1, 4]), free / float(n[1, 4])))


class Grams:
    """Probabilities of one order from the mapped buckets; one bucket is held at a time, of split words only where they are."""

    def __init__(self, model: Model, order: int):
        self.model, self.order, self.number, self.held, self.split = model, order, None, None, {}
        self.d = np.array([0.0, *model.discounts[order - 1]])

    def open(self, number: int) -> None:
        if number == self.number:
            return
        self.number, held = number, hash_arrays.load(self.model.path(f"grams{self.order}", number), missing=True)
        self.held = held
        if held is not None:
            self.wide = self.model.n_words + 2
            self.context = held["context"] if "context" in held else held["last"].astype(np.uint64) * np.uint64(self.wide)
            if "before" in held:
                self.context = np.repeat(self.context, _long(held, "runs")) + held["before"]
            followers, self.n = _long(held, "followers"), _long(held, "n")
            start = np.cumsum(followers) - followers
            self.total = np.add.reduceat(self.n, start).astype(float)
            self.free = np.add.reduceat(self.d[np.minimum(self.n, 3)], start) / self.total
            # ascending over the whole bucket: place of the context, then the word
            self.key = np.repeat(np.arange(len(start)), followers) * self.wide + held["word"]

    def refine(self, columns: list[np.ndarray], p: np.ndarray, bucket: int) -> np.ndarray:
        """Interpolate the probabilities of the next lower order for grams of one bucket."""
        self.open(bucket)
        out = p.copy()
        if self.held is not None:
            at, known = hash_arrays.find(self.model.context(columns[:-1]), self.context)
            rows, at = np.flatnonzero(known), at[known]
            place, seen = hash_arrays.find(at * self.wide + columns[-1][rows], self.key)
            n = np.where(seen, self.n[place], 0)
            out[rows] = (n - self.d[np.minimum(n, 3)]) / self.total[at] + self.free[at] * p[rows]
        return out

    def refine_split(self, columns: list[np.ndarray], p: np.ndarray) -> np.ndarray:
        """The same for pairs whose first word is a split one: its followers are looked up in the mapped file, wherever it lies."""
        out = p.copy()
        order = np.argsort(columns[0], kind="stable")
        for b, begin, end in _runs(columns[0][order]):
            rows = order[begin:end]
            word, n, big_at, big_n, start, total, free = self._followers(b)
            at, seen = hash_arrays.find(columns[1][rows], word)
            c = np.where(seen, n[at], 0).astype(np.int64)
            large = np.flatnonzero(c == 255)
            c[large] = big_n[np.searchsorted(big_at, start + at[large])]
            out[rows] = (c - self.d[np.minimum(c, 3)]) / total + free * p[rows]
        return out

    def _followers(self, b: int):
        """(words, counts, places and counts above one byte, begin, sum, weight of the lower order) after a split word."""
        if b not in self.split:
            held = hash_arrays.load(self.model.path("grams2", int(self.model.bucket([np.array([b])] * 2)[0])))
            followers = _long(held, "followers")
            i = int(np.searchsorted(held["last"], b))
            start = int(followers[:i].sum())
            end = start + int(followers[i])
            n = held["n"][start:end]
            big_at, big_n = held["n_at"].astype(np.int64), held["n_big"]
            large = slice(*np.searchsorted(big_at, [start, end]))
            total = float(n.sum(dtype=np.int64) + (big_n[large] - 255).sum())
            free = float(sum(d * int((n == i).sum()) for i, d in ((1, self.d[1]), (2, self.d[2]))) + self.d[3] * int((n > 2).sum())) / total
            self.split[b] = (held["word"][start:end], n, big_at[large], big_n[large], start, total, free)
        return self.split[b]


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.orders = [Grams(model, k) for k in range(2, model.order + 1)]
        self.before = [hash_arrays.load(model.path("before", i), missing=True) for i in range(len(model.sizes))]
        self.d = np.array([0.0, *model.discounts[0]])

    def unigram(self, word: np.ndarray) -> np.ndarray:
        asked, back = np.unique(word, return_inverse=True)
        n = np.zeros(len(asked), np.int64)
        part = np.where(asked < self.model.n_words, asked // self.model.span, -1)
        for i, begin, end in _runs(part):  # ascending, but for words without a count
            if i >= 0 and self.before[i] is not None:
                n[begin:end] = self.before[i]["n"][asked[begin:end] % self.model.span]
        total, free = self.model.unigrams
        return ((n - self.d[np.minimum(n, 3)]) / total + free / (self.model.n_words + 1))[back]

    def logs(self, columns: list[np.ndarray], bucket: int) -> np.ndarray:
        """log10 of the probability of the last word of each gram; `bucket` is that of the highest order."""
        p = self.unigram(columns[-1])
        for k, held in enumerate(self.orders, 2):
            if k == 2 and self.model.order > 2 and self.model.split:
                hot = np.isin(columns[-2], np.array(self.model.split))
                q = p.copy()
                q[hot] = held.refine_split([c[hot] for c in columns[-2:]], p[hot])
                q[~hot] = held.refine([c[~hot] for c in columns[-2:]], p[~hot], bucket)
                p = q
            else:
                p = held.refine(columns[-k:], p, bucket)
        return np.log10(p)


_SCORERS: dict[str, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    if model.folder not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.folder] = Scorer(model)
    return _SCORERS[model.folder]


class Sums:
    """Sums of the texts of blocks over the grams that were sent to buckets; `logs(columns, bucket)` scores grams of one bucket."""

    def __init__(self, logs: Callable[[list[np.ndarray], int], np.ndarray]):
        self.logs, self.bucket, self.parts, self.grams, self.found, self.waiting = logs, None, [], 0, {}, 0

    def add(self, first: int, bucket: int, payload: bytes) -> None:
        """A row of the block `first`; rows of a bucket follow each other."""
        if bucket != self.bucket or self.grams > FLUSH:
            self._score()
        own, *columns = unpack(payload)
        self.bucket, self.grams = bucket, self.grams + len(own)
        self.parts.append((first, own, columns))

    def _score(self) -> None:
        if self.parts:
            p, at = self.logs([np.concatenate(c) for c in zip(*(columns for _, _, columns in self.parts))], self.bucket), 0
            for first, own, _ in self.parts:
                self._keep(first, own, p[at : at + len(own)])
                at += len(own)
        self.parts, self.grams = [], 0

    def _keep(self, first: int, own: np.ndarray, p: np.ndarray) -> None:
        have = self.found.get(first)
        total = np.bincount(own, p, 0 if have is None else len(have[0]))
        seen = np.bincount(own, minlength=len(total)) > 0
        if have is not None:
            total[: len(have[0])] += have[0]
            seen[: len(have[1])] |= have[1]
        self.waiting += len(total) - (0 if have is None else len(have[0]))
        self.found[first] = (total, seen)

    def take(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(block, its texts, their sums) of all that was added."""
        self._score()
        found, self.found, self.waiting = self.found, {}, 0
        for first, (total, seen) in found.items():
            used = np.flatnonzero(seen)
            yield first, used, total[used]


ASKED = "first long, bucket int, slice long, payload binary, ids array<long>, held array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>, sums binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, model: Model, held_out: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; `held_out` names a boolean column."""
    schema = pa.schema([("first", pa.int64()), ("bucket", pa.int32()), ("slice", pa.int64()), ("payload", pa.binary()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                        ("n_tokens", pa.list_(pa.int64())), ("n_known", pa.list_(pa.int64())), ("base", pa.list_(pa.float64())), ("sums", pa.binary())])

    def rows(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(found, schema)

    enough = min(4 * FLUSH, max(FLUSH, BLOCK_TOKENS * model.buckets))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _words_of(model) if model.tokens else None
        ids, held, found, first = [], [], [], 0

        def out() -> pa.RecordBatch:
            """What has been gathered, as one block: a row for its texts and a row for each bucket of their grams."""
            h, own = (np.concatenate(x) for x in zip(*found))
            word, n = known.look(h) if known else (np.zeros(len(h), np.int64), np.zeros(len(h), np.int64))
            base = np.bincount(own, np.log10((n + 1.0) / (model.tokens + 1.0 * (model.n_words + 1))), len(ids))
            made = [{"first": first, "bucket": -1, "slice": first, "ids": list(ids), "held": list(held), "n_tokens": np.bincount(own, minlength=len(ids)).tolist(),
                     "n_known": np.bincount(own[n > 0], minlength=len(ids)).tolist(), "base": base.tolist()}]
            if known:
                columns, piece = grams(word, own, model.order, model.begin), int(mix(np.array([first], np.uint64))[0] % np.uint64(SLICES))
                made += [{"first": first, "bucket": bucket, "slice": piece, "payload": payload} for bucket, payload in _dealt(model.bucket(columns), [own, *columns])]
            for gathered in (ids, held, found):
                gathered.clear()
            return rows(made)

        for batch in batches:
            all_ids, all_held = batch.column("doc_id").to_pylist(), batch.column("held").to_pylist()
            for a, b, raw, offs in blocks(batch.column("text")):
                h, own = tokens(raw, offs)
                first = first if ids else batch.column("at")[a].as_py()
                found.append((h, own + len(ids)))
                ids += all_ids[a:b]
                held += all_held[a:b]
                if sum(len(x) for x, _ in found) > enough:
                    yield out()
        if ids:
            yield out()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Sums(lambda columns, bucket: _scorer(model).logs(columns, bucket))

        def out() -> Iterator[pa.RecordBatch]:
            for first, used, sums in held.take():
                yield rows([{"first": first, "bucket": 0, "payload": pack([used]), "sums": sums.tobytes()}])

        for batch in batches:
            asked = np.asarray(batch.column("bucket")) >= 0
            if not asked.all():
                yield batch.filter(pa.array(~asked))
            for row in batch.filter(pa.array(asked)).select(["first", "bucket", "payload"]).to_pylist():
                held.add(row["first"], row["bucket"], row["payload"])
                if held.waiting > WAITING:
                    yield from out()
        yield from out()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def out() -> pa.RecordBatch:
            n = len(now["ids"])
            return pa.RecordBatch.from_arrays([
                pa.array(now["ids"], pa.int64()), pa.array(now["held"], pa.bool_()), pa.array(now["n_tokens"], pa.int64()), pa.array(now["n_known"], pa.int64()),
                pa.array([model.tokens] * n, pa.int64()), pa.array(now["base"], pa.float64()), pa.array(total)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] < 0:  # the first row of its block
                    if now is not None:
                        yield out()
                    now, total = row, np.zeros(len(row["ids"]))
                else:
                    np.add.at(total, unpack(row["payload"])[0], np.frombuffer(row["sums"]))
        if now is not None:
            yield out()

    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(held_out).alias("held"), clean_text().alias("text"), F.monotonically_increasing_id().alias("at"))
    run = F.floor(F.col("bucket") / F.lit(max(1, model.buckets // RUNS)))
    asked = held.mapInArrow(ask, ASKED).repartition(run, F.col("slice")).sortWithinPartitions("bucket")
    sums = asked.mapInArrow(answer, ASKED)
    return sums.repartition(F.col("first")).sortWithinPartitions("first", "bucket").mapInArrow(gather, SCORED)


def perplexity(score_column: str = "score", n_tokens: str = "n_tokens"):
    """Perplexity a token of a scored row."""
    return F.pow(F.lit(10.0), -F.col(score_column) / F.col(n_tokens))


def report(docs: DataFrame, order: int = ORDER, **sizes) -> DataFrame:
    """Train on the rows that the contract names and score all; the model's files are removed once all rows are scored."""
    spark = docs.sparkSession
    root = shared_dir(spark).rstrip("/")
    folder = f"{root}/kneser-ney-{uuid.uuid4().hex}"
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (crc_mod("doc_id", 7) == 2).alias("held_out"))
    model = train(marked.where(~F.col("held_out")), folder, order, **sizes)
    done = cut_lineage(score(marked, model, "held_out"))
    delete_below(spark, root, folder)
    return done

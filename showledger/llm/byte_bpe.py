"""Byte-level BPE encoding and decoding with public ranks.

A long text is cut into overlapping chunks of CHUNK + OVERLAP characters, which are pre-tokenised apart from each other,
each from its own first character. From the first place on where two neighbours have a boundary in common, the pattern
sees the same text from the same place, so both agree: the text is stitched there. Where an overlap has no common
boundary (one pre-token spans it), the rest of the text is one piece, so the result is exact in every case. The pieces
between stitches are encoded each on its own, in parallel, and the ids joined in order; decoding concatenates the raw
bytes of the ids.

A boundary is used as a stitch only where it stays one when the text ends there: after a character that is no white
space, and not so near the end of a chunk that the pattern could have read on.

Texts of one chunk need no shuffle; only chunks of longer texts are dealt out. `texts` must be UTF-8 (as Spark strings
are); the ranks are a file whose path is a parameter (bounded by its vocabulary, sent to the tasks once).

Defined results: null and empty texts have no ids and decode to no bytes; repeated rows are each encoded; an empty
table gives no rows; extra columns are not read; control strings of other vocabularies are ordinary text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import clean_text, unused

#: Characters of a chunk, and how far the next chunk reaches into it.
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: Chunks handed on at a time; bytes of text that go back at a time.
SOME, SLICE = 64, 1 << 20
#: Characters that the pattern may look at beyond the end of a match.
MARGIN = 3


class Coder:
    """Ranks and pattern, as a tiktoken encoding without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values(), default=-1) + 1
        self.raw = [b""] * size
        for token, rank in ranks.items():
            self.raw[rank] = token
        self.pattern = regex.compile(pattern)

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_ordinary(text), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        raw = self.raw
        return b"".join([raw[i] for i in ids.tolist()])

    def boundaries(self, text: str, first: int, end: int) -> list[int]:
        """Safe boundaries (ends of pre-tokens) in [first, end) of a chunk."""
        out, last = [], len(text) - MARGIN
        for m in self.pattern.finditer(text):
            e = m.end()
            if e >= min(end, last):
                break
            if e >= first and _solid(text[e - 1]) and not "\x1c" <= text[e] <= "\x1f":
                out.append(e)
        return out


def _solid(c: str) -> bool:
    return not c.isspace()


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


_CODERS: dict[str, Coder] = {}


def _coder(name: str, sent) -> Coder:
    """The coder of these ranks and this pattern; a worker process holds one at a time."""
    if name not in _CODERS:
        _CODERS.clear()
        ranks, pattern = sent.value
        _CODERS[name] = Coder(ranks, pattern)
    return _CODERS[name]


class ByteBPE:
    """Encoder over DataFrames: ranks are read once and sent to the tasks."""

    def __init__(self, spark: SparkSession, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        if not 2 * MARGIN < overlap <= chunk:
            raise ValueError("the overlap must be above the margin and at most a chunk")
        ranks = load_ranks(path)
        name = hashlib.sha256(repr((sorted(ranks.items(), key=lambda r: r[1]), pattern)).encode()).hexdigest()
        self.coder = functools.partial(_coder, name, spark.sparkContext.broadcast((ranks, pattern)))
        self.chunk, self.overlap = chunk, overlap

    # -- one chunk ------------------------------------------------------------

    def run(self, df: DataFrame, text: str | None, ids: str, raw: str | None) -> DataFrame:
        """`df` with the ids of `text` (or those there already) and, if named, their raw bytes.

        Ids are little-endian unsigned 32-bit integers in a binary column. Rows go back in slices of SLICE bytes of
        text, so that memory does not follow the size of Arrow's input batches.
        """
        coder = self.coder
        added = [*([ids] if text else []), *([raw] if raw else [])]

        def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = coder()
            for batch in batches:
                source = batch.column(text or ids)
                size = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.binary_length(source), 0)))])
                first = 0
                while first < len(source):
                    end = max(first + 1, int(np.searchsorted(size, size[first] + SLICE, "right")) - 1)
                    part = batch.slice(first, end - first)
                    rows = part.column(text or ids)
                    made = [own.encode(t.as_py() or "") for t in rows] if text else [np.frombuffer(r.as_py(), "<u4") for r in rows]
                    new = [pa.array([x.tobytes() for x in made], pa.binary())] if text else []
                    new += [pa.array([own.decode(x) for x in made], pa.binary())] if raw else []
                    yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *added])
                    first = end

        return df.mapInArrow(encoded, T.StructType([*df.schema.fields, *[T.StructField(c, T.BinaryType()) for c in added]]))

    # -- chunks of long texts -------------------------------------------------

    def pieces(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        """key, piece, text: long texts cut at stitches. `key` must tell rows apart."""
        n, v, coder = self.chunk, self.overlap, self.coder
        def chunked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                for own, whole in zip(rows[key], rows[text]):
                    for at in range(0, max(1, len(whole)), SOME * n):
                        parts = [whole[i : i + n + v] for i in range(at, min(at + SOME * n, max(1, len(whole))), n)]
                        yield pd.DataFrame({key: own, "chunk": np.arange(at // n, at // n + len(parts), dtype=np.int32), "part": parts})

        field = docs.select(key).schema.fields[0]
        fields = [field, T.StructField("chunk", T.IntegerType()), T.StructField("part", T.StringType())]
        chunks = docs.select(key, text).mapInPandas(chunked, T.StructType(fields))

        def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = coder()
            for rows in batches:
                heads, tails = [], []
                for part in rows["part"]:
                    heads.append(own.boundaries(part, 1, v))
                    tails.append([e - n for e in own.boundaries(part, n + 1, n + v)])
                yield rows.assign(head=heads, tail=tails)

        # dealt out by chunk, not by text: the chunks of one text are pre-tokenised in parallel
        cut = chunks.repartition(F.col(key), F.col("chunk")).mapInPandas(edges, T.StructType([*fields, T.StructField("head", T.ArrayType(T.IntegerType())), T.StructField("tail", T.ArrayType(T.IntegerType()))]))
        order = Window.partitionBy(key).orderBy("chunk")
        common = cut.withColumn("stitch", F.when(F.col("chunk") == 0, 0).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(order)))))
        # a chunk without a stitch may be out of step with the text, and so may all that is compared with it
        stitched = common.withColumn("whole", F.min(F.col("stitch").isNotNull()).over(order)).withColumn("stitch", F.when(F.col("whole"), F.col("stitch")).otherwise(0))
        # what a chunk adds to its piece: from its stitch (or its first own character) to the next chunk's
        end = F.least(F.length("part"), F.lit(n) + F.coalesce(F.lead("stitch").over(order), F.lit(0)))
        spans = stitched.select(key, F.sum(F.col("whole").cast("int")).over(order).alias("piece"), "chunk", "part", F.col("stitch").alias("begin"), end.alias("end"))
        bits = spans.select(key, "piece", "chunk", F.substring(F.col("part"), F.col("begin") + 1, F.col("end") - F.col("begin")).alias("bit"))
        return bits.groupBy(key, "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "bit"))), lambda s: s["bit"]), "").alias("text"))

    def encode(self, docs: DataFrame) -> DataFrame:
        """Rows of `docs` with their columns, `ids` (binary) and `raw` (binary, decoded from the ids)."""
        ids, raw, row = unused(docs, "ids"), unused(docs, "raw"), unused(docs, "row_id")
        size = F.length(clean_text())
        whole = self.run(docs.where(size <= self.chunk), "text", ids, raw)
        return whole.unionByName(self.run(self._encode_long(docs.where(size > self.chunk), ids, row), None, ids, raw))

    def _encode_long(self, long: DataFrame, ids: str, row: str) -> DataFrame:
        """Long texts: equal texts are encoded once; the ids of their pieces are joined in order."""
        keyed = long.withColumn(row, F.sha2(clean_text(), 256))
        once = keyed.groupBy(row).agg(F.first(clean_text()).alias("text"))
        parts = self.run(self.pieces(once, row, "text").repartition(F.col(row), F.col("piece")), "text", "part_ids", None).drop("text")
        joined = parts.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("piece", "part_ids"))).alias("parts"))
        whole = joined.select(row, F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["part_ids"])), "")).alias(ids))
        return keyed.join(whole, row).drop(row)


def report(docs: DataFrame, coder: ByteBPE) -> DataFrame:
    """The contract's digest of `encode`: counts and hashes of ids and decoded bytes."""
    done = coder.encode(docs.select("doc_id", clean_text().alias("text")))
    return done.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("raw", 256).alias("decoded_sha256"))

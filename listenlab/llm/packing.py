"""Best-fit packing of tokenized documents into sequences of one length.

Best-fit decreasing looks only at lengths, and there are at most ``limit`` of
them. So the pieces are counted per length by Spark, best-fit decreasing runs
once over these counts (documents of one length go together; a segment tree
over the remaining capacities finds the tightest open bins), and its outcome,
runs of (length, ranks) -> (bins, offset), is applied to every piece by the
rank of the piece among those of its length. The result is that of best-fit
decreasing over all documents, on any number of partitions.

Defined cases: a null or empty text is the end token alone; only documents
longer than ``limit`` are cut; rows that repeat a doc_id are documents of
their own; a null doc_id stays null; an empty table gives no rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlab.llm.bpe_words import token_chunks
from listenlab.llm.shared import keep, map_arrow, parallelism

LIMIT = 4096
END_ID = 1
PIECE = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
           limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids)."""
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField(doc_id, id_type)]
                          + T._parse_datatype_string(PIECE).fields
                          + ([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else []))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, ids, offs in token_chunks(batch.column(1), tokenizer):
                rows, numbers, starts, lengths, crcs, tokens = [], [], [], [], [], []
                for i in range(hi - lo):
                    own = np.append(ids[offs[i]:offs[i + 1]], np.uint32(end_id)).astype("<u4")
                    for number, a in enumerate(range(0, len(own), limit)):
                        part = own[a:a + limit]
                        rows.append(lo + i)
                        numbers.append(number)
                        starts.append(a)
                        lengths.append(len(part))
                        crcs.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            tokens.append(part.astype(np.int64))
                out = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                       pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
                if with_ids:
                    out.append(pa.array(tokens, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return map_arrow(docs.select(doc_id, text), cut, schema)


class OpenBins:
    """Open bins by remaining capacity: a segment tree over the capacities
    0..limit whose nodes say whether any bin of their range is open."""

    def __init__(self, limit: int):
        self.leaves = 1
        while self.leaves <= limit:
            self.leaves *= 2
        self.open = [0] * (2 * self.leaves)
        self.bins: list[list[list[int]]] = [[] for _ in range(limit + 1)]

    def _mark(self, capacity: int, is_open: int) -> None:
        node = self.leaves + capacity
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] | self.open[2 * node + 1]

    def add(self, capacity: int, first: int, count: int) -> None:
        self.bins[capacity].append([first, count])
        if not self.open[self.leaves + capacity]:
            self._mark(capacity, 1)

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` that an open bin has."""
        node = self.leaves + length
        while not self.open[node]:
            while node & 1:  # a right child: the next range is at an ancestor
                node //= 2
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not self.open[node]:
                node += 1
        capacity = node - self.leaves
        return capacity if capacity < len(self.bins) else None

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        """Up to ``most`` adjoining bins of this capacity: (first, count)."""
        stack = self.bins[capacity]
        first, count = stack[-1]
        if count <= most:
            stack.pop()
            if not stack:
                self._mark(capacity, 0)
            return first, count
        stack[-1] = [first + most, count - most]
        return first, most


def best_fit_decreasing(counts: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, end rank, first bin, offset): the documents
    of this length with these ranks go to consecutive bins at this offset."""
    bins, runs, next_bin = OpenBins(limit), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = bins.tightest(length)
            room = limit if capacity is None else capacity
            # a bin that takes one of them is then the tightest: it is filled before the next is touched
            layers = min(room // length, left)
            if capacity is None:
                first, count = next_bin, left // layers
                next_bin += count
            else:
                first, count = bins.take(capacity, left // layers)
            for k in range(layers):
                runs.append((length, rank, rank + count, first, limit - room + k * length))
                rank, left = rank + count, left - count
            if room > layers * length:
                bins.add(room - layers * length, first, count)
    return runs


def place(cut: DataFrame, limit: int = LIMIT, doc_id: str = "doc_id") -> DataFrame:
    """``cut`` (columns doc_id, piece, length and any others) with
    sequence_id and offset. The runs on the driver are bounded by the
    ``limit`` lengths, not by the number of pieces."""
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(best_fit_decreasing(counts, limit) or np.empty((0, 5)), np.int64)
    if len(runs):
        runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    # ranks within a length, counted per (length, bucket) so that a common length is spread
    buckets = 4 * parallelism(spark)
    bucketed = cut.withColumn("bucket", F.pmod(F.xxhash64(doc_id, "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
             .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("length", "bucket").orderBy(doc_id, "piece", "ids_crc32")
    ranked = (bucketed.withColumn("nth", F.row_number().over(inside) - 1)
              .join(bases, ["length", "bucket"])
              .select(*cut.columns, (F.col("base") + F.col("nth")).cast("long").alias("rank")))
    schema = T.StructType(cut.schema.fields + T._parse_datatype_string("sequence_id long, offset long").fields)
    most = max(counts.values(), default=0) + 1
    shared = spark.sparkContext.broadcast(runs)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = table[:, 0] * most + table[:, 1]
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.num_columns - 1).to_numpy()
            run = table[np.searchsorted(keys, length * most + rank, "right") - 1] if len(length) else np.empty((0, 5), np.int64)
            out = [*batch.columns[:-1], pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return map_arrow(ranked, apply, schema)


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
         limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    cut = keep(pieces(docs, tokenizer, doc_id, text, limit, end_id), "pieces")
    return place(cut, limit, doc_id)

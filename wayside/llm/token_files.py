"""Token ids of all documents in a binary format, documents in ascending order of id.

A file is a Parquet table of chunks, so that any store Spark writes to will do. A chunk
holds the ids of consecutive documents, concatenated, two or four bytes each as the
vocabulary needs, and where each document ends in Elias-Fano code: about two bits more
than the logarithm of the mean length for each document, where a table of offsets takes
64. ``Chunk.bounds`` selects one document without decoding the others.

Columns: part and chunk (their order is the order of the documents), before (ids that
the part's earlier chunks hold), n_ids, width, doc_ids, ids, n_docs, low_bits, low, high,
samples.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayside.llm.elias_fano import EliasFano
from wayside.llm.spans import slices
from wayside.llm.subwords import encoder

END_ID = 1
#: A chunk is closed once it holds so many ids; one longer document stays whole.
CHUNK_IDS = 2_000_000
#: Text handled at once.
BYTES = 4 << 20


def _schema(id_type: str) -> str:
    return (
        "part int, chunk int, before long, n_ids long, width int, doc_ids array<%s>, ids binary, "
        "n_docs int, low_bits int, low binary, high binary, samples binary" % id_type
    )


def _chunk(part: int, chunk: int, before: int, width: int, doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    code = EliasFano.encode(ends)
    row = {
        "part": pa.array([part], pa.int32()),
        "chunk": pa.array([chunk], pa.int32()),
        "before": pa.array([before], pa.int64()),
        "n_ids": pa.array([len(ids)], pa.int64()),
        "width": pa.array([width], pa.int32()),
        "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
        "ids": pa.array([ids.astype(f"<u{width}").tobytes()], pa.binary()),
        "n_docs": pa.array([code.n], pa.int32()),
        "low_bits": pa.array([code.low_bits], pa.int32()),
        "low": pa.array([code.low], pa.binary()),
        "high": pa.array([code.high], pa.binary()),
        "samples": pa.array([code.samples], pa.binary()),
    }
    return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> None:
    """Encodes every whole text, appends the end id, and writes the chunks to ``path``.

    A null, empty or blank text has the end id alone. Null ids come first; rows with the
    same id follow each other in the order of their texts. An empty table writes a table
    without chunks. Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = encoder(tokenizer)
        width = 2 if max(sub.size, end_id + 1) <= 1 << 16 else 4
        part, chunk, before = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        ends: list[np.ndarray] = []
        names: list[pa.Array] = []
        total = 0

        def close() -> pa.RecordBatch:
            return _chunk(part, chunk, before, width, pa.concat_arrays(names), np.concatenate(ids), np.concatenate(ends))

        for batch in batches:
            text = batch.column("text")
            for i, j in slices(text, BYTES):
                flat, at = sub.encode(sub.words(text.slice(i, j - i)))
                n = np.diff(at) + 1
                out = np.full(len(flat) + j - i, end_id, np.int32)
                out[np.arange(len(flat)) + np.repeat(np.arange(j - i), n - 1)] = flat
                ids.append(out.astype(f"<u{width}"))
                ends.append(total + np.cumsum(n))
                names.append(batch.column("doc_id").slice(i, j - i))
                total += len(out)
                if total >= CHUNK_IDS:
                    yield close()
                    chunk, before, total = chunk + 1, before + total, 0
                    ids, ends, names = [], [], []
        if total:
            yield close()

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, _schema(id_type)).write.parquet(path)


class Chunk:
    """One row of the table."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], f"<u{row['width']}")
        self.ends = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"])

    def bounds(self, i: int) -> tuple[int, int]:
        """Where document i of the chunk begins and ends."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        a, b = self.bounds(i)
        return self.ids[a:b]


def read_index(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the chunks at ``path``.

    start counts the ids of all documents before; ids_crc32 is the CRC-32 of the ids as
    little-endian 32-bit numbers.
    """
    table = spark.read.parquet(path)
    id_type = table.schema["doc_ids"].dataType.elementType.simpleString()
    # a row for each partition that wrote: as many as the shuffle had, whatever the input
    parts = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part"), F.coalesce(F.sum("n").over(order), F.lit(0)).cast("long").alias("part_start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                row = {c: one.column(c)[0].as_py() for c in one.schema.names if c != "doc_ids"}
                chunk = Chunk(row)
                ends = chunk.ends.values()
                starts = np.concatenate([[0], ends[:-1]])
                wide = memoryview(chunk.ids.astype("<u4").tobytes())
                crc = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ends), row["part"]), pa.int32()),
                        one.column("doc_ids").flatten(),
                        pa.array(row["before"] + starts, pa.int64()),
                        pa.array(ends - starts, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    found = table.mapInArrow(decode, f"part int, doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
    return found.join(F.broadcast(parts), "part").select(
        F.col("doc_id").alias(id_col),
        (F.col("part_start") + F.col("start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )

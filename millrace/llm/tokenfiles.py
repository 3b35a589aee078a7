"""Token ids in files: ids ranked by frequency, coded in whole bytes.

An id is replaced by its rank by frequency over all documents, so frequent ids
are small numbers. A rank takes one to four bytes. The lengths stand apart from
the bytes: two bits an id, four ids to a control byte. A reader looks the four
lengths of a control byte up in a table and places all bytes of a block with
numpy at once.

The files hold blocks of whole documents, in ascending order of ids, in the
folder ``blocks``; a block is a row of Parquet with its control bytes and its
data bytes as separate columns. The folder ``vocabulary`` holds each id's count,
which gives its rank; of equal counts the smaller id comes first. A
reader that wants positions only reads the blocks' numbers of ids and nothing
else, and writing is committed by Spark like any table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import keep, slices
from millrace.llm.tokens import worker_encoder
from millrace.session import Workspace

BLOCK_IDS = 262_144
# Pieces of text a worker keeps the ids of, some 350 bytes each: more than where
# encoding is one stage among others.
KEPT_PIECES = 800_000
# Fixed value: the lengths of the four numbers that a control byte describes.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
_PLACES = np.arange(4, dtype=np.uint8)

BLOCKS = "part int, block int, n_docs int, n_ids long, doc_ids binary, known binary, counts binary, control binary, data binary"


def code(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    numbers = numbers.astype("<u4", copy=False)
    extra = (numbers > 0xFF).astype(np.uint8)
    extra += numbers > 0xFFFF
    extra += numbers > 0xFFFFFF
    padded = np.zeros(-(-len(numbers) // 4) * 4, dtype=np.uint8)
    padded[: len(numbers)] = extra
    fours = padded.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    data = numbers.view(np.uint8).reshape(-1, 4)[_PLACES <= extra[:, None]]
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of a block."""
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:n]
    out = np.zeros((n, 4), dtype=np.uint8)
    out[_PLACES < lengths[:, None]] = np.frombuffer(data, dtype=np.uint8)
    return out.view("<u4").ravel()


def write_tokens(
    docs: DataFrame,
    path: str,
    definition: str,
    work: Workspace,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
) -> None:
    """Writes the ids of every whole text and ``end_id`` to ``path``.

    NULL texts count as empty and have the end id alone. Rows without an id
    come first; rows that repeat an id are written each, in an order that
    depends on their ids only. An empty table gives a file without blocks.
    Other columns of the input are not looked at, whatever their names.
    """
    made = keep(_encoded(docs, definition, id_col, text_col, end_id), work, "encoded")
    encoded = made.where("counts IS NULL")
    each = made.where("counts IS NOT NULL").select("counts").mapInArrow(_unpack_counts, "id long, n long")
    counts = each.groupBy("id").agg(F.sum("n").alias("n"))
    counts.coalesce(1).write.parquet(f"{path}/vocabulary")
    by_rank = _by_rank(docs.sparkSession, path)
    ranks = np.zeros(int(by_rank.max(initial=0)) + 1, dtype="<u4")
    ranks[by_rank] = np.arange(len(by_rank))
    order = [F.col("doc_id").asc_nulls_first(), F.col("ids_crc32"), F.col("row_no")]
    placed = encoded.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = placed.select("doc_id", "ids").mapInArrow(_writer(ranks), BLOCKS)
    # Coded bytes hold little that a second compression could find.
    blocks.write.option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(f"{path}/blocks")


def _encoded(docs: DataFrame, definition: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """``doc_id, row_no, ids_crc32, ids`` with the ids' bytes by place, compressed.

    A task's last row has in ``counts`` how often the task met each id, so that
    nobody reads the ids again to count them.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, squeeze = worker_encoder(definition, KEPT_PIECES), zstandard.ZstdCompressor(level=1)
        counts = np.zeros(0, dtype=np.int64)
        for some in slices(batches):
            ids = [i + end for i in encoder.encode(some.column("text").to_pylist())]
            found = np.bincount(np.frombuffer(b"".join(ids), dtype="<u4"), minlength=len(counts))
            found[: len(counts)] += counts
            counts = found
            crcs = pa.array([zlib.crc32(i) for i in ids], pa.int64())
            packed = pa.array([squeeze.compress(_by_place(i)) for i in ids], pa.binary())
            columns = [some.column("doc_id"), some.column("row_no"), crcs, packed]
            yield pa.record_batch([*columns, pa.nulls(len(ids), pa.binary())], names)
        whole = pa.array([squeeze.compress(counts.tobytes())], pa.binary())
        nothing = [pa.nulls(1, kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        yield pa.record_batch([*nothing, whole], names)

    names = ["doc_id", "row_no", "ids_crc32", "ids", "counts"]
    chosen = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    return chosen.mapInArrow(encode, "doc_id long, row_no long, ids_crc32 long, ids binary, counts binary")


def _by_place(ids: bytes) -> bytes:
    """All first bytes, then all second ones, and so on."""
    return np.frombuffer(ids, dtype=np.uint8).reshape(-1, 4).T.tobytes()


def _from_places(places: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(places, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _unpack_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opener = zstandard.ZstdDecompressor()
    for batch in batches:
        for packed in batch.column("counts"):
            counts = np.frombuffer(opener.decompress(packed.as_py()), dtype=np.int64)
            seen = np.flatnonzero(counts)
            yield pa.record_batch([pa.array(seen), pa.array(counts[seen])], ["id", "n"])


def _writer(ranks: np.ndarray):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener, part, block = zstandard.ZstdDecompressor(), TaskContext.get().partitionId(), 0
        doc_ids, runs, size = [], [], 0
        for batch in batches:
            for doc_id, packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                doc_ids.append(doc_id)
                runs.append(_from_places(opener.decompress(packed)))
                size += len(runs[-1])
                if size >= BLOCK_IDS:
                    yield _block(part, block, doc_ids, runs, ranks)
                    doc_ids, runs, size, block = [], [], 0, block + 1
        if doc_ids:
            yield _block(part, block, doc_ids, runs, ranks)

    return write


def _block(part: int, block: int, doc_ids: list, runs: list[np.ndarray], ranks: np.ndarray) -> pa.RecordBatch:
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], dtype="<i8")
    counts = np.array([len(r) for r in runs], dtype="<u4")
    control, data = code(ranks[np.concatenate(runs)])
    row = [part, block, len(runs), int(counts.sum()), numbers.tobytes(), known.tobytes(), counts.tobytes(), control, data]
    names = [p.split()[0] for p in BLOCKS.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
    return pa.record_batch([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)


def _by_rank(spark: SparkSession, path: str) -> np.ndarray:
    """The ids in the order of their ranks; as many as the tokenizer has at most."""
    counted = spark.read.schema("id long, n long").parquet(f"{path}/vocabulary")
    ranked = counted.orderBy(F.desc("n"), "id").select("id").collect()
    return np.array([row["id"] for row in ranked], dtype="<u4")


def read_tokens(spark: SparkSession, path: str, *, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` from the files at ``path``.

    ``start`` is the number of ids of all documents before. ``ids`` are
    little-endian unsigned 32-bit numbers, NULL unless ``with_ids``.
    """
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    by_rank = _by_rank(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _documents(row, by_rank, with_ids)

    docs = blocks.select("part", "block", "doc_ids", "known", "counts", "control", "data").mapInArrow(
        read, "part int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long, ids binary"
    )
    # Parts are as many as there are files; the blocks of a part are numbered apart.
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("part_start"))
    upto = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "block", F.coalesce(F.sum("n_ids").over(upto), F.lit(0)).alias("block_start"))
    starts = starts.join(parts, "part").select("part", "block", (F.col("part_start") + F.col("block_start")).alias("first"))
    return docs.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def _documents(row: dict, by_rank: np.ndarray, with_ids: bool) -> pa.RecordBatch:
    counts = np.frombuffer(row["counts"], dtype="<u4").astype(np.int64)
    ids = by_rank[decode(row["control"], row["data"], int(counts.sum()))]
    ends = np.cumsum(counts)
    runs = [ids[a:b].tobytes() for a, b in zip(ends - counts, ends, strict=True)]
    n = len(counts)
    doc_ids = np.frombuffer(row["doc_ids"], dtype="<i8")
    unknown = np.frombuffer(row["known"], dtype=np.uint8) == 0
    columns = [
        pa.array(np.full(n, row["part"], dtype=np.int32)),
        pa.array(np.full(n, row["block"], dtype=np.int32)),
        pa.array(doc_ids, mask=unknown),
        pa.array(ends - counts),
        pa.array(counts),
        pa.array([zlib.crc32(r) for r in runs], pa.int64()),
        pa.array(runs if with_ids else [None] * n, pa.binary()),
    ]
    return pa.record_batch(columns, ["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32", "ids"])

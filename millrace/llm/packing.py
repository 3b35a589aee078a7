"""Packing documents into sequences: first-fit decreasing in random groups.

Documents are dealt by a hash into groups of about equal numbers, and every
group is packed on its own. Pieces go in order of falling length into the first
sequence with room. A tournament tree over the rooms finds that sequence in
logarithmic time: each node holds the larger room of its two children, so the
first leaf that is large enough is met by going left wherever the left child is.

Groups are small and bounded, so a lost executor costs a few of them, and what
is shuffled is lengths, not ids.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import hash63, slices
from millrace.llm.tokens import worker_encoder

SEQUENCE = 1024
# Where a group's sequences would stay emptier than this share, tails are cut at
# the sequence's half and quarter: pieces of up to a quarter find room where
# larger ones, all of one size perhaps, do not.
MOST_PADDING = 0.01
HALVINGS = 2
GROUP_DOCS = 2048
BINS_BITS = 32
# Keys a task remembers to tell repeated rows by.
KEPT_KEYS = 200_000

PIECES = (
    "key long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, "
    "parts array<struct<length:long,ids_crc32:long>>"
)


def cut_documents(
    docs: DataFrame,
    definition: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    sequence: int = SEQUENCE,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``sequence`` ids of every whole document.

    A document's ids are those of its text (NULL: empty) and ``end_id``. Pieces
    are full, but for the last; ``parts`` says how that one may be cut further:
    half and a quarter of a sequence as far as the ids go, and the rest. Gives ``key`` (a hash of id and text, which deals documents into
    groups; rows without an id are dealt by their place, and rows that repeat id
    and text by their task and number there, so that many do not meet in one
    group), ``doc_id, start, length, ids_crc32, doc_tokens`` and ``ids``,
    little-endian unsigned 32-bit, NULL unless ``with_ids``. Repeated rows give
    pieces each; an empty table gives none. Other columns of the input are not
    looked at, whatever their names.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(definition)
        task, seen = TaskContext.get().partitionId(), {}
        for batch in slices(batches):
            rows = []
            if len(seen) > KEPT_KEYS:
                seen.clear()
            encoded = encoder.encode(batch.column("text").to_pylist())
            ids_of = zip(batch.column("key").to_pylist(), batch.column("doc_id").to_pylist(), encoded, strict=True)
            for key, doc_id, ids in ids_of:
                ids += end
                repeat = seen[key] = seen.get(key, -1) + 1
                if repeat:
                    key = xxhash.xxh3_64_intdigest(struct.pack("<qqq", key, task, repeat)) >> 1
                for start, length in cuts(len(ids) // 4, sequence, 0):
                    piece = ids[4 * start : 4 * (start + length)]
                    kept = piece if with_ids else None
                    parts = [
                        {"length": n, "ids_crc32": zlib.crc32(piece[4 * at : 4 * (at + n)])}
                        for at, n in (cuts(length, sequence) if length < sequence else [])
                    ]
                    rows.append((key, doc_id, start, length, zlib.crc32(piece), len(ids) // 4, kept, parts))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    names = [part.split()[0] for part in PIECES.split(", ")]
    part_type = pa.struct([("length", pa.int64()), ("ids_crc32", pa.int64())])
    kinds = [*[pa.int64()] * 6, pa.binary(), pa.list_(part_type)]
    chosen = docs.select(
        hash63(
            F.coalesce(F.col(f"`{id_col}`").cast("long"), F.monotonically_increasing_id()), F.col(f"`{text_col}`")
        ).alias("key"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    return chosen.mapInArrow(cut, PIECES)


def cuts(length: int, sequence: int, halvings: int = HALVINGS) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of so many ids."""
    found, start = [], 0
    for size in [sequence] * (length // sequence) + [sequence >> k for k in range(1, halvings + 1)]:
        if 0 < size <= length - start:
            found.append((start, size))
            start += size
    return [*found, (start, length - start)] if start < length else found


def pack(
    pieces: DataFrame,
    *,
    key_col: str = "key",
    length_col: str = "length",
    order_cols: tuple[str, ...] = ("doc_id", "start", "ids_crc32"),
    capacity: int = SEQUENCE,
    groups: int = 1,
    seed: int = 0,
) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there.

    Lengths must lie between 1 and ``capacity``; 0 is allowed and takes no
    room. Pieces with one key go into one group, and ``seed`` chooses the
    groups. Equal lengths are taken by ``order_cols``, so reruns agree. Columns
    of the input are kept; they must not be named like the two new ones.

    Documents stay whole where a group's sequences are full so. Where they are
    not, pieces with ``parts`` are cut into these, as ``cut_documents`` gives
    them; the column itself does not stay.
    """
    number = F.pmod(hash63(F.lit(seed), F.col(f"`{key_col}`")), F.lit(groups))
    into = _packer(length_col, list(order_cols), capacity)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name != "parts")
    dealt = pieces.withColumn("sequence_id", number)
    return dealt.groupBy("sequence_id").applyInArrow(into, f"{fields}, sequence_id long, offset long")


def group_count(n_docs: int, group_docs: int = GROUP_DOCS) -> int:
    """Groups for so many documents: each holds about ``group_docs`` of them."""
    return max(1, -(-n_docs // group_docs))


def _packer(length_col: str, order_cols: list[str], capacity: int) -> Callable[[pa.Table], pa.Table]:
    order = [(length_col, "descending"), *[(c, "ascending") for c in order_cols]]

    def into(rows: pa.Table) -> pa.Table:
        cuttable = "parts" in rows.column_names
        whole = rows.drop_columns(["parts"]) if cuttable else rows
        whole = whole.take(pc.sort_indices(whole, sort_keys=order))
        bins, offsets = first_fit(whole[length_col].to_pylist(), capacity)
        if cuttable:
            used = (max(bins) + 1) * capacity
            if used - pc.sum(whole[length_col]).as_py() > MOST_PADDING * used:
                pieces = _cut_further(rows)
                pieces = pieces.take(pc.sort_indices(pieces, sort_keys=order))
                finer = first_fit(pieces[length_col].to_pylist(), capacity)
                if max(finer[0]) < max(bins):
                    whole, (bins, offsets) = pieces, finer
        rows = whole
        group = rows["sequence_id"][0].as_py() << BINS_BITS
        rows = rows.drop_columns(["sequence_id"])
        numbers = pa.array(np.array(bins, dtype=np.int64) + group)
        return rows.append_column("sequence_id", numbers).append_column("offset", pa.array(offsets, pa.int64()))

    return into


def _cut_further(rows: pa.Table) -> pa.Table:
    """Pieces with ``parts`` as these."""
    found = []
    for row in rows.to_pylist():
        parts, at = row.pop("parts"), 0
        for part in parts or [row]:
            ids = row["ids"] and row["ids"][4 * at : 4 * (at + part["length"])]
            found.append(row | {"start": row["start"] + at, "length": part["length"], "ids_crc32": part["ids_crc32"], "ids": ids})
            at += part["length"]
    return pa.Table.from_pylist(found, rows.drop_columns(["parts"]).schema)


def first_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """For each length in turn, the first bin with room for it and its place there."""
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - room[node])
        room[node] -= length
        while node > 1:
            node //= 2
            larger = max(room[2 * node], room[2 * node + 1])
            if room[node] == larger:
                break
            room[node] = larger
    return bins, offsets


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id``, its ids and their number."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.expr("aggregate(parts, cast('' as binary), (ids, part) -> concat(ids, part.ids))")
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"), F.sum("length").alias("length"))
        .select("sequence_id", joined.alias("ids"), "length")
    )

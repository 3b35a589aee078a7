"""Importance resampling towards a target: weights from arrays, ranks by regular sampling.

Runs of words fall into hash buckets. What a bucket counts in all documents and
in the target texts gives its gain, and an array of gains scores a document by
the mean over its runs; a Gumbel draw, fixed by the document's id, turns the
highest scores into a draw without replacement.

The scores are put in order by regular sampling. Each task writes its rows as a
sorted run. Rows at regular steps of the runs give the splitters that cut the
order into segments, counts of the segments tell where each begins, and only
segments that reach into the draw are exchanged. Each is merged on its own, and
its beginning makes the places in it exact ranks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import keep, slices
from millrace.llm.tokens import Known, worker_kept
from millrace.session import Workspace

BUCKETS = 10_000
# Words whose buckets a worker keeps.
KEPT_WORDS = 400_000
# Rows of a segment, and samples a segment; both grow beyond the largest number
# of segments, whose splitters and counts are all that the driver holds.
SEGMENT_ROWS = 4096
SAMPLES = 16
MOST_SEGMENTS = 16_384
# Place in a run, in the low bits that Spark's own row numbers have.
PLACE_BITS = 33


def _table() -> bytes:
    """Bytes of words: digits, lower-case letters and all beyond ASCII; A-Z become lower case."""
    kept = {b: b for b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]}
    kept |= {b: b + 0x20 for b in range(0x41, 0x5B)}
    return bytes(kept.get(b, 0x20) for b in range(256))


class Buckets:
    """Buckets of a text's runs of one to ``longest`` words, by the CRC of their bytes."""

    def __init__(self, buckets: int, longest: int):
        self.longest = longest
        self.known = Known(lambda run: zlib.crc32(run) % buckets, KEPT_WORDS)
        self.table = _table()

    def of(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of every run, repeats counted."""
        words = (text or "").encode("utf-8", "replace").translate(self.table).split()
        runs = list(words)
        for k in range(2, self.longest + 1):
            runs += map(b" ".join, zip(*(words[j:] for j in range(k)), strict=False))
        return len(words), np.fromiter(map(self.known.__getitem__, runs), np.int64, len(runs))


def _worker_buckets(buckets: int, longest: int) -> Buckets:
    return worker_kept("buckets", b"", lambda: Buckets(buckets, longest), buckets, longest)


def bucket_counts(texts: DataFrame, text_col: str = "text", *, buckets: int = BUCKETS, longest: int = 1) -> np.ndarray:
    """Runs in each bucket over all texts; a task adds its own up before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, of = np.zeros(buckets, np.int64), _worker_buckets(buckets, longest).of
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                found += np.bincount(of(text)[1], minlength=buckets)
        held = np.flatnonzero(found)
        yield pa.record_batch([pa.array(held), pa.array(found[held])], ["bucket", "n"])

    each = texts.select(F.col(f"`{text_col}`")).mapInArrow(count, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for row in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of a bucket's smoothed shares, rounded down."""
    a = float(corpus.sum() + len(corpus))
    b = float(target.sum() + len(target))
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * a / ((s + 1.0) * b))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def weigh(docs: DataFrame, gain: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", longest: int = 1) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the mean gain of a document's runs, rounded down."""
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _worker_buckets(buckets, longest).of
        for batch in slices(batches):
            rows = [[], [], []]
            for text in batch.column("text").to_pylist():
                words, found = of(text)
                sum_of = int(gain[found].sum())
                for column, value in zip(rows, (words, len(found), sum_of // len(found) if len(found) else 0), strict=True):
                    column.append(value)
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in rows)]
            yield pa.record_batch(columns, ["doc_id", "n_words", "n_features", "weight"])

    chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return chosen.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """1000 times a standard Gumbel draw, rounded down, by the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    work: Workspace,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    buckets: int = BUCKETS,
    longest: int = 1,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; ``rank`` is NULL where not drawn.

    Of the rows with ``least_words`` words, ``percent`` in a hundred with the
    highest scores are drawn, ties to the smaller id, rows without an id last.
    NULL and empty texts have no runs and the weight 0. Rows that repeat an id
    have the same draw and stand next to each other, each with a rank of its
    own; which of them is first is the same in each reading of one table. A very
    long text is one row like others. Tables without rows give no rows, and
    without target texts all gains rest on the corpus alone. Other columns of
    the inputs are not looked at, whatever their names.
    """
    gain = gains(
        bucket_counts(docs, text_col, buckets=buckets, longest=longest),
        bucket_counts(target, text_col, buckets=buckets, longest=longest),
    )
    weighed = weigh(docs, gain, id_col=id_col, text_col=text_col, longest=longest)
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn(
        "able", F.col("n_words") >= least_words
    )
    runs = keep(sorted_runs(scored), work, "runs")
    able = runs.where("able")
    drawn = able.count() * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    nothing = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return runs.select(*out, nothing)
    cuts = splitters(able)
    parts = segments(able, cuts, segment_starts(able, cuts))
    # A segment that begins behind the draw's end has nothing to exchange.
    reaches = F.col("begin") < drawn
    place = F.col("begin") + F.row_number().over(Window.partitionBy("segment").orderBy(*rank_order()))
    near = parts.where(reaches).withColumn("place", place)
    rank = F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    beyond = parts.where(~reaches).select(*out, nothing)
    return near.select(*out, rank).unionAll(beyond).unionAll(runs.where("NOT able").select(*out, nothing))


def rank_order() -> list[Column]:
    """The order of ranks; ``place`` tells rows apart that are equal else."""
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("place")]


def sorted_runs(scored: DataFrame) -> DataFrame:
    """Each task's rows in order, those that can be drawn first, with their ``place``."""
    ordered = scored.sortWithinPartitions(F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id"))
    return ordered.withColumn("place", F.monotonically_increasing_id())


def splitters(able: DataFrame) -> np.ndarray:
    """Sorted keys that cut the rows into segments of about equal numbers.

    Every run gives rows at one regular step, from a start of its own; the
    sorted samples are cut regularly again.
    """
    rows = able.count()
    wanted = min(MOST_SEGMENTS, -(-rows // SEGMENT_ROWS))
    if wanted < 2:
        return keys_of([], [], [])
    step = max(1, rows // (wanted * SAMPLES))
    run, inside = F.shiftright("place", PLACE_BITS), F.col("place").bitwiseAND((1 << PLACE_BITS) - 1)
    phase = F.pmod(F.xxhash64(run), F.lit(step))
    sample = able.where((inside + phase) % step == 0).select("score", "doc_id", "place").toArrow()
    keys = np.sort(keys_of(*(sample.column(c).to_pylist() for c in ("score", "doc_id", "place"))))
    return keys[np.arange(1, wanted) * len(keys) // wanted] if len(keys) else keys


def keys_of(score: list[int], doc_id: list[int | None], place: list[int]) -> np.ndarray:
    """Byte strings that sort like ``rank_order``: falling score, id with NULL last, place."""
    out = np.empty((len(score), 3), dtype=">u8")
    top = np.uint64(1 << 63)
    out[:, 0] = ~(np.array(score, np.int64).view(np.uint64) ^ top)
    none = (1 << 63) - 1
    out[:, 1] = np.array([none if i is None else i for i in doc_id], np.int64).view(np.uint64) ^ top
    out[:, 2] = np.array(place, np.int64).view(np.uint64)
    return out.view("S24").ravel()


def segments(able: DataFrame, cuts: np.ndarray, starts: np.ndarray) -> DataFrame:
    """The rows with their ``segment``, the number of splitters not behind them, and its ``begin``."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = keys_of(*(batch.column(c).to_pylist() for c in ("score", "doc_id", "place")))
            found = np.searchsorted(cuts, keys, side="right")
            columns = [*batch.columns, pa.array(found, pa.int32()), pa.array(starts[found], pa.int64())]
            yield pa.record_batch(columns, [*batch.schema.names, "segment", "begin"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in able.schema.fields)
    return able.mapInArrow(place, f"{fields}, segment int, begin long")


def segment_starts(able: DataFrame, cuts: np.ndarray) -> np.ndarray:
    """Rows before each segment: prefix sums of the segments' counts."""
    starts = np.zeros(len(cuts) + 2, np.int64)
    for row in segments(able, cuts, starts).groupBy("segment").count().collect():
        starts[row["segment"] + 1] = row["count"]
    return np.cumsum(starts)[:-1]

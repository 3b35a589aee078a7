"""Mixing sources to target weights by hash thresholds, in DataFrame functions only.

Every document has a hash. A source takes each of its documents a whole number
of times and those below a hash threshold once more, so a larger budget always
holds a smaller one's documents. The threshold comes from histograms: words are
summed by source and hash bucket, the bucket in which the budget ends is split
into finer buckets, and so on until it holds a single hash. No row is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORDS, keep, with_position
from millrace.session import Workspace

HASH_BITS = 60
BUCKET_BITS = 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """The first ``HASH_BITS`` bits of a digest that any engine can compute."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, HASH_BITS // 4), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    work: Workspace,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row with what the mix takes of it.

    Gives ``doc_id, source, size, source_size, target, copies, taken`` and, as
    the struct ``row``, the columns named in ``carry``. Sources in code point
    order, NULL last, get ``weights`` in turn. Targets share the words of all
    documents by weight; none exceeds ``most`` times its source, and what is
    over goes to the others by weight until none does.

    NULL text has size 0, and a source without words the target 0. Rows equal
    in id and text share one hash and so one decision; sizes being whole, a
    source ends within one such hash of its target. An empty table gives no
    rows. Other columns of the input are not looked at, whatever their names.
    """
    text = F.col(f"`{text_col}`")
    columns = [
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        word_count(text).alias("size"),
        document_hash(F.col(f"`{id_col}`"), text).alias("hash"),
    ]
    if carry is not None:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"))
        rows = docs.select(*columns)
        sizes = keep(rows.drop("row"), work, "sizes")
    else:
        rows = sizes = keep(docs.select(*columns), work, "sizes")
    # Written, so that Spark sees how small it is and does not deal out documents.
    found = keep(thresholds(sizes, targets(sizes, work, weights, most), work, most), work, "taken")
    extra = F.when(F.col("hash") <= F.col("last_hash"), 1).otherwise(0)
    return (
        rows.join(
            found.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source"))
        )
        .withColumn("copies", F.col("whole") + extra)
        .withColumn("taken", F.col("size") * F.col("copies"))
        .drop("of_source", "hash", "whole", "last_hash")
    )


def targets(sizes: DataFrame, work: Workspace, weights: tuple[int, ...], most: int) -> DataFrame:
    """``source, source_size, target`` for every source."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_position(sources, F.col("source").asc_nulls_last(), work, "ranked")
    turn = F.pmod("position", F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    weighed = keep(
        ranked.select("source", "source_size", weight.cast("long").alias("weight")), work, "weighed"
    )
    total, weight_sum = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return weighed.select("source", "source_size", F.lit(0.0).alias("target"))
    # Words for each unit of weight; it rises until no further source is full.
    share, full = total / weight_sum, 0
    bound = F.lit(most) * F.col("source_size")
    while True:
        over = F.lit(share) * F.col("weight") > bound
        now, words, rest = weighed.agg(
            F.count_if(over),
            F.coalesce(F.sum(F.when(over, bound)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        if now == full or not rest:
            break
        share, full = (total - words) / rest, now
    return weighed.select(
        "source", "source_size", F.least(F.lit(share) * F.col("weight"), bound.cast("double")).alias("target")
    )


def thresholds(sizes: DataFrame, aims: DataFrame, work: Workspace, most: int) -> DataFrame:
    """For every source its whole copies and the last hash taken once more."""
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most)))
    aims = keep(
        aims.withColumn("whole", F.coalesce(whole, F.lit(0)).cast("long")).withColumn(
            "budget",
            F.when(F.col("whole") < most, F.col("target") - F.col("whole") * F.col("source_size")).otherwise(0.0),
        ),
        work,
        "aims",
    )
    wanted = aims.where("budget > 0").select(
        F.col("source").alias("of_source"), "budget", F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("below")
    )
    bits = 0
    while True:
        finer = min(HASH_BITS, bits + BUCKET_BITS)
        inside = sizes.join(
            wanted,
            F.col("source").eqNullSafe(F.col("of_source"))
            & (F.shiftright("hash", HASH_BITS - bits) == F.col("cell")),
        )
        bucket = F.shiftright("hash", HASH_BITS - finer)
        words = inside.groupBy("of_source", "budget", "below", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        ordered = Window.partitionBy("of_source").orderBy("bucket")
        upto = F.col("below") + F.sum("words").over(ordered)
        # The bucket in which the budget ends: the first whose sum reaches it.
        ends = (
            words.withColumn("upto", upto)
            .where((F.col("upto") >= F.col("budget")) & (F.col("upto") - F.col("words") < F.col("budget")))
            .select(
                "of_source",
                "budget",
                F.col("bucket").alias("cell"),
                (F.col("upto") - F.col("words")).alias("below"),
                "words",
                "low",
                "high",
            )
        )
        found = keep(ends, work, f"buckets_{finer}")
        bits = finer
        if bits == HASH_BITS or not found.where("low < high").limit(1).count():
            break
        wanted = found.select("of_source", "budget", "cell", "below")
    closer = F.col("below") + F.col("words") - F.col("budget") < F.col("budget") - F.col("below")
    last = F.when(closer, F.col("high")).otherwise(F.col("low") - 1)
    return aims.join(
        found.select("of_source", last.alias("last_hash")),
        F.col("source").eqNullSafe(F.col("of_source")),
        "left",
    ).select("source", "source_size", "target", "whole", F.coalesce("last_hash", F.lit(-1)).alias("last_hash"))

"""Quality rules whose cutoffs keep false rejections below a certified limit.

A rule rejects a document whose share (symbols, repeated words and so on) is
above a cutoff. The cutoffs of all rules form a path from lenient to strict,
learnt for each stratum from the good labelled documents of one part. The other
part is held out: its good documents, as many as a step of the path rejects,
give an exact binomial bound on the share of good documents that the step
rejects. Steps are tested from the first on, each at the same level, until one
fails, which needs no correction; the strata share the level by Bonferroni's.
So, with the given confidence, in no stratum more than the limit is rejected.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import keep, slices
from millrace.session import Workspace

# Largest share of good documents of a stratum that may be rejected, and the
# probability that it is more in any of them.
LIMIT = 0.05
RISK = 0.05
# A rule: share of the first column in the second, in thousandths, and the
# lowest cutoff. The lowest ones are those published for web text.
RULES = {
    "symbols": ("n_symbols", "n_words", 100),
    "word_length": ("word_chars", "n_words", 10_000),
    "repeats": ("n_repeat_words", "n_words", 200),
    "dup_lines": ("n_dup_lines", "n_lines", 300),
}
# Steps of the path: hundredths of the largest share among the good documents,
# then thousandths of these documents that a cutoff leaves below it.
MULTIPLES = (200, 150, 125, 100)
QUANTILES = (999, 995, 990, 980, 950)
STEPS = len(MULTIPLES) + len(QUANTILES)
# Shares are counted up to this one, so a stratum has few different ones.
MOST_SHARE = 50_000
# First hexadecimal digits of a text's digest: up to this one cutoffs are learnt from it.
LEARN_BELOW = "4"

WHITE = b" \t\n\r\x0b\f"
SYMBOLS = b"#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def text_stats(text: str | None) -> tuple[int, ...]:
    """``STATS`` of a whole text; all 0 for NULL.

    Words are runs of other than ASCII white space. ``n_lines`` counts lines
    with a word, ``n_dup_lines`` those of them equal to an earlier line, and
    ``n_repeat_words`` the words in windows of three that occur twice or more.
    """
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    chars = len(text) - (len(raw) - len(raw.translate(None, WHITE)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        often = np.fromiter(map(counts.__getitem__, windows), np.int64, len(windows)) > 1
        inside = np.zeros(len(words), bool)
        for k in range(3):
            inside[k : k + len(often)] |= often
        repeated = int(inside.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def with_stats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``doc_id, stratum, text_key``, the text's statistics and ``base_failed``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [text_stats(text) for text in batch.column("text").to_pylist()]
            columns = list(zip(*found, strict=True)) or [[]] * len(STATS)
            kept = [batch.column(c) for c in ("doc_id", "stratum", "text_key")]
            yield pa.record_batch([*kept, *(pa.array(c, pa.int64()) for c in columns)], names)

    names = ["doc_id", "stratum", "text_key", *STATS]
    text = F.col(f"`{text_col}`").cast("string")
    chosen = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{stratum_col}`").cast("string").alias("stratum"),
        F.md5(text.cast("binary")).alias("text_key"),
        text.alias("text"),
    )
    counted = chosen.mapInArrow(count, "doc_id long, stratum string, text_key string, " + ", ".join(f"{s} long" for s in STATS))
    few = F.col("n_words") < 50
    return counted.withColumn("base_failed", few | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def share(rule: str) -> Column:
    """A rule's share of a document in thousandths, rounded down."""
    part, whole, _ = RULES[rule]
    of = F.when(F.col(whole) > 0, F.expr(f"{part} * 1000 div {whole}")).otherwise(0)
    return F.least(of, F.lit(MOST_SHARE)).cast("long")


def labelled_texts(stats: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """``stratum, good, learn`` and the shares of every labelled text that passes the base rules.

    Copies of a text in a stratum are one text, since they are no draws of their
    own. Ids or texts whose labels disagree are left out.
    """
    label = F.col("label")
    known = (
        labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & label.isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where(label == F.col("other"))
        .drop("other")
    )
    shares = [share(rule).alias(rule) for rule in RULES]
    rows = stats.where("NOT base_failed").select("doc_id", "stratum", "text_key", *shares).join(known, "doc_id")
    same = rows.groupBy("stratum", "text_key").agg(
        F.min(label).alias("label"), F.max(label).alias("other"), *[F.max(rule).alias(rule) for rule in RULES]
    )
    return same.where(label == F.col("other")).select(
        "stratum", (label == 1).alias("good"), (F.substring("text_key", 1, 1) < LEARN_BELOW).alias("learn"), *RULES
    )


def cutoffs(texts: DataFrame) -> DataFrame:
    """``stratum`` and for every rule the array of its cutoffs, from lenient to strict."""
    shares = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("share")) for r in RULES]))
    counts = texts.where("good AND learn").select("stratum", shares.alias("s")).groupBy("stratum", "s.rule", "s.share").count()
    of_rule = Window.partitionBy("stratum", "rule")
    upto = counts.withColumn("upto", F.sum("count").over(of_rule.orderBy("share"))).withColumn(
        "all", F.sum("count").over(of_rule)
    )
    steps = [F.max("share") * m / 100 for m in MULTIPLES]
    steps += [F.min(F.when(F.col("upto") * 1000 >= F.col("all") * q, F.col("share"))) for q in QUANTILES]
    paths = upto.groupBy("stratum", "rule").agg(F.array(*[F.floor(s) for s in steps]).alias("path"))
    of_rules = [F.max(F.when(F.col("rule") == rule, F.col("path"))).alias(rule) for rule in RULES]
    lowest = [F.expr(f"transform({rule}, c -> greatest(c, {least}L))").alias(rule) for rule, (_, _, least) in RULES.items()]
    return paths.groupBy("stratum").agg(*of_rules).select("stratum", *lowest)


def lower_tail(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` in ``n`` independent draws of probability ``p``.

    Where ``k`` reaches the mean it is a half at least and 1 is given instead.
    """
    if k >= n * p:
        return 1.0
    total, first = 0.0, math.lgamma(n + 1)
    for i in range(k, -1, -1):  # falling terms
        term = math.exp(first - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
        total += term
        if term < total * 1e-18:
            break
    return total


def chosen_step(false: list[int], n: int, good: list[int], bad: list[int], level: float, limit: float) -> int | None:
    """The certified step that tells good from bad best, or None if no step is certified.

    ``false`` are the rejected of ``n`` held-out good texts by step; ``good`` and
    ``bad`` the rejected texts of the other part by step, the last entry all of
    them. Ties go to the more lenient step.
    """
    certified = 0
    while certified < len(false) and lower_tail(false[certified], n, limit) <= level:
        certified += 1
    gain = [bad[s] * good[-1] - good[s] * bad[-1] for s in range(certified)]
    return gain.index(max(gain)) if gain else None


def certify(texts: DataFrame, work: Workspace, limit: float = LIMIT, risk: float = RISK) -> DataFrame:
    """Every stratum with its ``step`` (NULL: none certified), the cutoffs there, and what certified it.

    ``n_good`` held-out good texts, of which the step rejects ``n_false``.
    """
    paths = keep(cutoffs(texts), work, "cutoffs")
    strata = max(1, paths.count())
    level = [F.expr(f"size(filter(path.{rule}, c -> c >= {rule}))") for rule in RULES]
    tested = texts.join(
        paths.select(F.col("stratum").alias("of"), F.struct(*RULES).alias("path")), F.col("stratum").eqNullSafe(F.col("of"))
    ).withColumn("level", reduce(F.least, level))
    held, learnt, good = ~F.col("learn"), F.col("learn"), F.col("good")

    def by_step(which: Column) -> Column:
        steps = [F.count_if(which & (F.col("level") <= s)) for s in range(STEPS)]
        return F.array(*steps, F.count_if(which))

    counted = tested.groupBy("of").agg(
        F.first("path").alias("path"),
        by_step(held & good).alias("false"),
        by_step(learnt & good).alias("good"),
        by_step(learnt & ~good).alias("bad"),
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                *row["false"], n = row["false"]
                step = chosen_step(row["false"], n, row["good"], row["bad"], risk / strata, limit)
                row |= {"stratum": row["of"], "step": step, "n_good": n, "n_false": None if step is None else row["false"][step]}
                row |= {f"most_{r}": None if step is None else row["path"][r][step] for r in RULES}
            yield pa.RecordBatch.from_pylist(rows, schema)

    names = ["step", "n_good", "n_false", *[f"most_{r}" for r in RULES]]
    schema = pa.schema([("stratum", pa.string()), *[(n, pa.int64()) for n in names]])
    return counted.mapInArrow(choose, "stratum string, " + ", ".join(f"{n} long" for n in names))


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    work: Workspace,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
    limit: float = LIMIT,
    risk: float = RISK,
) -> DataFrame:
    """``doc_id``, the text's statistics, ``base_failed, kept`` and the stratum's ``step`` for every row.

    A row is kept if it passes the base rules (50 words, at most half of them in
    repeated windows) and no certified rule of its stratum rejects it. A stratum
    with too few labelled texts to certify anything rejects nothing more; NULL
    is a stratum of its own. NULL and empty texts fail the base rules. Rows that
    repeat others get the same verdict; a share equal to the cutoff passes; a
    very long text is one row like others; an empty table gives no rows, and
    without labels the base rules stand alone. Other columns of the inputs are
    not looked at, whatever their names.
    """
    stats = keep(with_stats(docs, id_col=id_col, text_col=text_col, stratum_col=stratum_col), work, "stats")
    texts = keep(labelled_texts(stats, labels, id_col=id_col, label_col=label_col), work, "labelled")
    found = keep(certify(texts, work, limit, risk), work, "certified").withColumnRenamed("stratum", "of")
    rejected = reduce(Column.__or__, [share(r) > F.col(f"most_{r}") for r in RULES])
    judged = stats.join(found, F.col("stratum").eqNullSafe(F.col("of")), "left")
    kept = ~F.col("base_failed") & ~F.coalesce(rejected, F.lit(False))
    return judged.select("doc_id", "stratum", *STATS, "base_failed", kept.alias("kept"), "step")

"""From raw documents to packed sequences: five stages, each an operator of ``millrace.llm``.

Every stage takes and, but for the last, returns the columns of ``documents``:

1. ``language``: documents whose text no learnt language fits are left out.
2. ``quality``: documents scored below the threshold are left out.
3. ``near_duplicates``: of documents linked by a similarity of 0.8 or more one
   stays, that with the smallest id; two texts of one id are two documents.
4. ``mixture``: a source takes its documents as often as its target asks for; a
   document is repeated, or left out, as the mix says.
5. ``sequences``: documents are packed into sequences of at most 1024 tokens.

A NULL text has no language and is left out by the first stage. Of rows that
repeat an id and a text the third stage keeps one; rows without an id stay
there. Empty tables pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import langid, minhash, mixing, packing, quality, tokens
from millrace.llm.common import keep, load
from millrace.session import Workspace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is learnt from ``docs`` themselves."""
    models = langid.train(docs)
    found = docs.withColumn("found_language", langid.identify(F.col("text"), models))
    return found.where("NOT found_language.rejected").select(COLUMNS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of ``labels`` scores at the threshold or above."""
    model = quality.train(docs, load(spark, sf_dir, "labels"))
    scored = docs.withColumn("found_quality", quality.score(F.col("text"), model))
    return scored.where(F.col("found_quality") >= quality.THRESHOLD).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    found = minhash.near_duplicates(docs, Workspace(spark, "stage3"), percent=80, by_row=True)
    dropped = found.where("NOT kept").select("doc_id", "text_key").distinct()
    keyed = docs.where("doc_id IS NOT NULL").withColumn("text_key", minhash.text_key(F.col("text")))
    rest = keyed.join(dropped, ["doc_id", "text_key"], "left_anti")
    once = rest.dropDuplicates(["doc_id", "text_key"])
    return once.select(COLUMNS).unionAll(docs.where("doc_id IS NULL").select(COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    mixed = mixing.mix(docs, Workspace(spark, "stage4"), carry=COLUMNS)
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.where("copies > 0").select("row", F.explode(copies)).select("row.*")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    definition = tokens.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.cut_documents(docs, definition, with_ids=False)
    packed = packing.pack(pieces, groups=packing.group_count(docs.count()))
    return packed.drop("key", "ids")


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("sequences", sequences),
]

# SQL cannot express the first, second and last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each written and read again."""
    work = Workspace(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = keep(docs, work, name)
    return docs

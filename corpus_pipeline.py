"""Corpus pipeline: from ``documents`` to packed training sequences.

``STAGES`` are applied in order; each is written as Parquet and read again, so a
lost executor never costs more than one stage.  All but the last return the columns
of their input.

1. toxicity: documents that the compression-distance score rejects go;
2. near_duplicates: one document of each group of near copies stays (five words, 0.8);
3. repeated_passages: passages of 50 or more words stay in one document only;
4. secrets: the values of secrets are masked;
5. packing: the texts become sequences of 1024 tokens.

Null ids and texts pass every filter; a text that loses all its words stays as an
empty document; rows that share an id stay or go together; texts of any length are read
whole; further columns, whatever their names, go through the filtering stages as they
are; an empty table gives an empty result, stage by stage.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.llm.minhash_dedup import near_groups
from tontine.llm.packing import pack
from tontine.llm.secret_scan import find_secrets, masked
from tontine.llm.secret_scan import learn as learn_secrets
from tontine.llm.substring_dedup import remove_repeats
from tontine.llm.toxicity import THRESHOLD, learn, score
from tontine.session import configure
from tontine.sources.sinks import materialize

SIMILARITY_PERCENT, SHINGLE = 80, 5
PASSAGE_WORDS = 50
SEQUENCE = 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _apart(docs: DataFrame) -> DataFrame:
    """Id and text, and everything but the text as one column ``row``."""
    rest = [F.col(c).alias(c) for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*rest, F.col("text").isNull().alias("no_text")).alias("row"))


def _whole(docs: DataFrame, out: DataFrame, text: Column, changed: Column) -> DataFrame:
    """The columns of ``docs`` again, with the new text and its length where it has changed."""
    text = F.when(~F.col("row.no_text"), text)
    given = {c: text if c == "text" else F.col(f"row.{c}") for c in docs.columns}
    if "n_chars" in given:
        given["n_chars"] = F.when(changed, F.length(text)).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[v.alias(c) for c, v in given.items()])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold, by a model of the labels that are not held out.  All of them if
    the labels give no model (too few, or of one kind, or no marker): no evidence is no rejection."""
    model = learn(docs, _table(spark, sf_dir, "labels"))
    if not model.weights:
        return docs
    scored = score(_apart(docs), model, keep=("text", "row"))
    return _whole(docs, scored.filter(F.col("score") < THRESHOLD), F.col("text"), F.lit(False))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies."""
    groups = near_groups(docs, percent=SIMILARITY_PERCENT, shingle=SHINGLE)
    copies = groups.filter(~F.col("kept")).select(F.col("id").alias("doc_id")).distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has too."""
    out = remove_repeats(_apart(docs), window=PASSAGE_WORDS, joined=False, keep=("row",))
    return _whole(docs, out, F.col("kept_text"), F.col("n_removed") > 0)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the values of secrets masked."""
    out = find_secrets(_apart(docs), learn_secrets(docs), keep=("text", "row"))
    return _whole(docs, out, masked(F.col("text"), F.col("secrets")), F.size("secrets") > 0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece: its document, place there, sequence and offset."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), length=SEQUENCE).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("secrets", secrets), ("packing", packing)]

#: Scores of a learnt model, hashes and a bin packing: not for SQL; tests/llm/test_pipeline.py checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    out = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = materialize(stage(spark, out, sf_dir), name=f"pipeline-{name}")
    return STAGES[-1][1](spark, out, sf_dir)

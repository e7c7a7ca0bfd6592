"""The training-data pipeline over ``documents``: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.llm.bpe import encode
from attestra.llm.common import stored, table
from attestra.llm.decontaminate import leaks
from attestra.llm.jaccard import one_of_each
from attestra.llm.pii import pseudonymised
from attestra.llm.quality import classify, held_out


def apart(docs: DataFrame, *taken: str) -> tuple[DataFrame, list[Column]]:
    """docs with its own columns of the ``taken`` names under free names, and its columns under their right names to select at the end."""
    free = "own"
    while any(c.lower().startswith(free) for c in docs.columns):
        free += "_"
    names = {c: f"{free}{i}" for i, c in enumerate(docs.columns) if c.lower() in taken}
    return docs.withColumnsRenamed(names), [F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; a quarter of the labels is held out from it.

    Null and empty texts get the score of an empty text, long ones are read whole; equal texts, and so repeated rows, stay or go together; null
    ids have no label and are scored; columns named score or predicted are kept as they are; no rows give no rows.
    """
    docs, own = apart(docs, "score", "predicted")
    return classify(docs, table(spark, sf_dir, "labels").filter(~held_out())).filter("predicted = 1").select(own)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8: that with the smallest id.

    Null, empty and blank texts belong to no group and stay; null ids come last in a group; of rows that repeat id and text one stays; other
    columns of any name are kept; no rows give no rows.
    """
    return one_of_each(docs, width=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay, long ones are searched whole; every row is judged by itself, so repeated rows stay or go together;
    null ids make no difference; a column named leaks is kept as it is; no rows give no rows, an empty benchmark keeps all.
    """
    docs, own = apart(docs, "leaks")
    return leaks(docs, table(spark, sf_dir, "benchmark")).filter(F.size("leaks") == 0).select(own)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in place of personal values; n_chars, where there is one, follows the text.

    Null texts stay null (n_chars too) and empty ones empty, long ones are searched whole; repeated rows stay equal; ids and other columns of any
    name are kept; no rows give no rows.
    """
    got = pseudonymised(docs, found=None)
    return got.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns) if "n_chars" in docs.columns else got


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the text as the ids decode.

    Null texts count as empty; long ones are encoded whole; null ids and repeated rows are rows of their own; other columns, also one named ids,
    are not read; no rows give no rows.
    """
    path = public_tokenizers.path("byte_bpe_50k.json")
    return encode(docs, path, decoded="text").select("doc_id", "text", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality classifier", good_quality), ("n-gram Jaccard join", without_near_copies), ("benchmark decontamination", without_benchmark), ("PII", without_personal_data),
          ("BPE encoding and decoding", token_ids)]

#: Trained weights and byte-pair codes are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{i}")
    return docs

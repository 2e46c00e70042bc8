"""A corpus pipeline: toxic documents go, then repeats, then near copies; sources are mixed; the rest becomes token ids.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as docs of the
next. All but the last give the columns of documents. The classifier of the first stage is fitted on all
labelled documents, and every stage covers all of its rows.

Mixing gives a document once for each epoch of its source, so from there on rows may repeat. Encoding a repeat anew
costs nothing but its positions.

Defined results: columns beyond those of documents go through all stages but the last untouched, whatever their names. A
null text is never toxic, a repeat or a near copy, is mixed in once and has null ids; a null doc_id stays unless another
row has the same text; of rows with the same doc_id and text one stays. Ties go to the least doc_id. Empty tables of
documents or labels give an empty result or nothing toxic. Texts of any length are worked on whole. SQL can express
neither the first stage nor the last, so tests/llm/test_pipeline.py holds every stage against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from canopy.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from canopy.llm._store import new_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs that the field finds no toxic span in."""
    return toxicity.reject_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one document of each text."""
    return exact_dedup.remove_repeats(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one document of each group that n-gram Jaccard similarity connects."""
    return ngram_join.remove_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs in the order of the schedule of sources, those of sources below their weight several times."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, text_md5) of every row, text_md5 of the decoded ids."""
    return bpe.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", remove_repeats),
    ("ngram_join", remove_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL can express neither the conditional random field nor byte-pair encoding.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; between two of them lies a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = new_path(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

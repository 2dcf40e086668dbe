"""A training-data pipeline of five stages over ``documents``.

Ids may be null or repeat, texts be null, empty or very long, and further columns have any name: the stages but the last
return all columns, and an empty table gives an empty one. What a stage does with such rows is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnwright.llm.common import table, vocabulary
from turnwright.llm.decontaminate import without_leaks
from turnwright.llm.mixing import mixed_documents
from turnwright.llm.near_dedup import without_near_duplicates
from turnwright.llm.quality import keep_good
from turnwright.llm.token_files import token_files
from turnwright.storage import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; each row is judged by its own text, a null one as an empty one."""
    return keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest id stays: five-word shingles, similarity 0.8. Of rows with
    equal ids one stays; rows without id stay, and texts without words are in no group."""
    return without_near_duplicates(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; each row is judged by its own text."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), words=5, least=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document is there as often as the mix takes it, one without words not at all.
    A null source is a source of its own."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary files; a row for each row from reading them back, null ids first, a null text as an empty one."""
    return token_files(docs, vocabulary("word_bpe_49k.json"), end_id=1)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]

#: The classifier, the sketches and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written to the shared folder before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs

"""A cleaning pipeline over ``documents``: each stage's decisions take effect, its result is written and read again.

quality (documents that the rules reject go) -> language (documents without an identified language go) ->
near_duplicates (one document of each group stays) -> secrets (spans are masked in the text) -> packing (sequences).
All stages but the last return the columns of documents; the last returns a row for each piece of a document with its
ids and its place in a sequence.

Edge cases, of all stages: null and empty texts have no word, so ``quality`` rejects them; the later stages take them as
their operators do. Null ids and repeated rows are documents like others; of rows with equal id and text one stays in
``near_duplicates``. Texts of any length are read whole. Ties go to the smallest id. Extra columns are carried through,
whatever their names, up to the last stage. An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blockflow.llm.common import held_out
from blockflow.llm.language import keep_identified
from blockflow.llm.nearcopies import keep_distinct
from blockflow.llm.packing import PackingParams, pack, tokenise
from blockflow.llm.quality import keep_good
from blockflow.llm.secrets import redact
from blockflow.runtime import read_table, shared_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the learned cutoffs of their language keep."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is identified; documents without a letter, or like none learned, go."""
    return keep_identified(docs, ~held_out(4, 2))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group: SimHash links, then five-word similarity of 0.8 or more."""
    return keep_distinct(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the spans of secrets masked in their texts."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset."""
    p = PackingParams()
    return pack(tokenise(docs, p), docs.count(), p).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]

#: Fitted models decide in the first two stages and a tokenizer in the last, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``; each is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = shared_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

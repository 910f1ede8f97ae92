"""The training-data pipeline over ``documents``: STAGES in order, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the
last return the columns of ``documents``. Null and letterless texts have no language, so the
first stage drops them. The third keeps one row of each group, whatever ids its rows have:
that of the smallest id, of a null id only where no row has one. A text that repeats
passages throughout is empty after the fourth stage and stays as such.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.llm import langid, packing, simhash, substring_dedup, toxicity
from rampart.llm.common import fresh, materialize
from rampart.llm.queries import BITS, CONTEXT, REPEAT_WORDS, SHINGLE, TOXIC, tokenizer_path
from rampart.operators.validate import FILE, INDEX
from rampart.sources.files import with_source_index


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language, the labeller's where they state none (a null lang); those without
    any lettered word, null and empty texts among them, go, and all go where no document states a language.

    Rows are judged one by one, repeated ones too; a tie of languages goes to the first in order. Any column of
    ``docs`` may have any name beside doc_id, text and lang."""
    model = langid.train(docs)
    names = fresh(docs, "_lang", "_share", "_spans")
    found = langid.identify(docs, model, names=names).filter(F.col(names[0]) != "und")
    return found.withColumn("lang", F.coalesce("lang", names[0])).select(docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below TOXIC; null and empty texts have the score of a text without
    scored words and stay.

    Labels are those of labels.parquet for rows of ``docs``; without any, no word is scored and all stay. Rows
    are judged one by one, repeated ones too; columns beside doc_id and text may have any name."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = fresh(docs, "_toxicity", "_restored")
    return toxicity.score(docs, model, names=names).filter(F.col(names[0]) < TOXIC).select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the smallest id, nulls last.
    Rows that share an id, or have none, are told apart by a key of their own."""
    key, group = fresh(docs, "_key", "_group")
    keyed = _keyed(docs, key)
    groups = simhash.simhash_groups(keyed, SHINGLE, BITS, id_col=key).select(F.col("doc_id").alias(key), F.col("component_id").alias(group))
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(key).alias("key"))
    keep = keyed.select(key, "doc_id").join(groups, key).groupBy(group).agg(F.min(rank)["key"].alias(key))
    return keyed.join(keep, key, "left_semi").select(docs.columns)


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a number for each row. Rows of a Parquet table have a place of their own; others are
    written once with theirs."""
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().toString() == "parquet":
        return with_source_index(docs, "parquet").withColumnRenamed(INDEX, key).drop(FILE)
    return materialize(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that a document of a smaller id has. Texts that lose none stay as
    they are, null ones too; of the others the kept words are joined by one space, and n_chars is their length."""
    rest = [c for c in docs.columns if c != "text"]
    found = substring_dedup.remove_repeats(docs, REPEAT_WORDS, carry=rest, whole=True)
    kept = {c: F.col(f"c{k}") for k, c in enumerate(rest)} | {"text": F.col("text")}
    kept["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(kept["n_chars"])
    return found.select(*[kept[c].alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document, tokenized and packed into sequences: one row for each piece.

    A null or empty text is a piece of its end token alone; repeated rows, and rows of a null doc_id, are packed
    each for itself; further columns are not read; no documents give no rows."""
    return packing.pack_documents(docs, tokenizer_path(), CONTEXT)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("best_fit_packing", best_fit_packing),
]

#: The stages learn models and decode texts, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training-corpus pipeline: stages applied to ``documents`` in turn, each written before the next reads it.

Each stage works on all rows that the one before kept, and all but the last return the columns of ``documents`` unchanged, whatever
other columns there are and however they are named. Defined results:

* null, empty and unlettered texts have the toxicity of the bias alone and stay in that stage; the language stage drops them, as
  no language explains them;
* rows with a null ``doc_id`` are judged for toxicity, language and leaks like others, and never count as near-duplicates;
* repeated rows are judged each for itself; the near-duplicate stage keeps one of those that repeat id and text;
* an empty table gives an empty table in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.llm import decontamination, language, near_dup, packing, toxicity
from sievemill.llm.shared import free_name, only, remove, written

#: A document goes if the operator would call it toxic.
TOXIC = toxicity.THRESHOLD


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not likely to be toxic."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs.columns, "toxicity_score")
    return toxicity.score(docs, model, name).filter(F.col(name) < TOXIC).select(docs.columns)


def drop_undetermined(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some learned language explains; texts without a letter go."""
    name = free_name(docs.columns, "language_found")
    found = language.identify(docs, language.train(docs), name, free_name([*docs.columns, name], "language_share"))
    return found.filter(F.col(name) != language.UNDETERMINED).select(docs.columns)


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dup.deduplicate(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as sequences of power-of-two lengths."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("language", drop_undetermined), ("near_duplicates", drop_duplicates), ("decontamination", drop_leaks), ("packing", pack)]

#: Trained models and hashing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table. What a stage wrote for itself goes when its result is written, and that when
    the next one's is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with only(spark) as keep:
        before: list[str] = []
        for name, stage in STAGES[:-1]:
            with only(spark) as keep_here:
                docs, path = written(stage(spark, docs, sf_dir), name)
                keep_here(docs, path)
            remove(spark, *before)
            before = [path]
        return keep(*written(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0]))

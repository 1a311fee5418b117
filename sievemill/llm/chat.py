"""Chat formatting with cumulative-snapshot collapse.

Chat logs often hold a conversation once after every exchange. A turn's fingerprint hashes its place, role and text; the
running xor of the fingerprints, in two independent halves of 64 bits, is the rolling hash of each turn prefix. A conversation
whose whole hash is a proper prefix of another one's is a snapshot and an anti-join drops it; of equal conversations the one
with the smallest id stays. Turns are put in order once, with their texts, which alone part equal turns; after that only
hashes are shuffled, and both sides are made distinct before they meet, so a first turn or a conversation that very many logs
share costs one row. Texts are gathered and rendered for the conversations kept.

Everything is a DataFrame expression. A conversation is rendered as one string, so its turns have to fit one row.

Defined results: turns are ordered by ``turn`` (null first), then role, then text by its bytes; rows that repeat stay turns of their own; a
null role is ``user``, a null text empty; rows with a null ``conv_id`` belong to no conversation and are left out; an empty table
gives no rows; other columns are not read. The markers' opening characters inside a text are written with a blank between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The markers of the chat markup that is written.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id is not null")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, place, n_turns, h1, h2``: the rolling hash up to each turn."""
    hashed = turns.select("conv_id", "turn", "role", "text", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = hashed.withColumn("place", F.row_number().over(order))
    run = order.rowsBetween(W.unboundedPreceding, 0)
    return placed.select(
        "conv_id",
        "place",
        F.bit_xor(F.xxhash64("place", "a")).over(run).alias("h1"),
        F.bit_xor(F.xxhash64("place", "b")).over(run).alias("h2"),
        F.lead("place").over(order).isNull().alias("last"),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies`` of the conversations that no longer one begins with."""
    rolled = prefix_hashes(turns)
    whole = rolled.filter("last").groupBy("place", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    snapshots = rolled.filter("not last").select("place", "h1", "h2").distinct()
    return whole.join(snapshots, ["place", "h1", "h2"], "left_anti").select("conv_id", F.col("place").cast("long").alias("n_turns"), "n_copies")


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies, rendered, assistant_chars``: each maximal conversation in chat markup, and how many
    characters of it are answers to learn from."""
    turns = _turns(conversations)
    kept = maximal_conversations(turns)
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    gathered = turns.join(kept.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id").agg(ordered.alias("turns"))
    rendered = F.concat_ws("", F.transform("turns", lambda t: F.concat(F.lit(OPEN), _plain(t.role), F.lit("\n"), _plain(t.text), F.lit(CLOSE + "\n"))))
    answers = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.when(t.role == "assistant", F.length(_plain(t.text))).otherwise(0))
    return gathered.join(kept, "conv_id").select("conv_id", "n_turns", "n_copies", rendered.alias("rendered"), answers.alias("assistant_chars"))


def op5_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP5_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, count(*) AS n, list(role || chr(31) || text ORDER BY turn NULLS FIRST, role, text) AS turns,
         string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), ''
                    ORDER BY turn NULLS FIRST, role, text) AS rendered,
         sum(CASE WHEN role = 'assistant' THEN length(replace(text, '<|', '< |')) ELSE 0 END) AS assistant_chars
  FROM t GROUP BY conv_id
), p AS (
  SELECT DISTINCT k AS n, turns[1:k] AS turns FROM (SELECT turns, n, unnest(range(1, n)) AS k FROM c) x
), d AS (
  SELECT turns, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY turns, n
)
SELECT d.conv_id, d.n AS n_turns, d.n_copies, c.rendered, CAST(c.assistant_chars AS BIGINT) AS assistant_chars
FROM d JOIN c ON c.conv_id = d.conv_id
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.n = d.n AND p.turns = d.turns)
"""

"""Chat logs: snapshots of one growing conversation collapse to the longest, then are rendered.

1. Every turn gets a 128-bit hash of its place, role and text (two xxhash64); running XORs
   over the turns of a conversation are its prefix hashes, one for each length.
2. A conversation is a snapshot if its whole hash and length appear among the prefixes of a longer
   one: an anti-join of whole hashes with the distinct proper prefixes.  Of equal
   conversations the smallest conv_id stays.  Both sides hold each hash once, so an
   opening that a third of all conversations share is one row.
3. What is left is rendered, a header and the text for each turn.

Turns are ordered by turn, role and text (nulls first); repeated rows are turns of their own.  A
null role or text counts as empty.  Rows with a null conv_id form one conversation, like
any other.  Only conv_id, turn, role and text are read.  A conversation is one row of the result,
so the longest one must fit in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.storage import materialize, table

TURN_HEAD, TURN_END = "<|im_start|>", "<|im_end|>\n"


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), role, text, and the prefix hashes p1 and p2 up to each turn."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = turns.withColumn("place", F.row_number().over(order).cast("long"))
    turns = turns.withColumns({"h1": F.xxhash64("place", "role", "text"), "h2": F.xxhash64(F.lit("second"), "text", "role", "place")})
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return turns.select("conv_id", "place", "role", "text", F.bit_xor("h1").over(so_far).alias("p1"), F.bit_xor("h2").over(so_far).alias("p2"))


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_equal of the conversations that prefix no longer one; of
    equal ones the smallest id, and how many they are."""
    hashes = prefixes.select("conv_id", "place", "p1", "p2")
    # a conversation's hashes stand in the window's order, so its last one is that of the whole
    whole = hashes.groupBy("conv_id").agg(F.max(F.struct("place", "p1", "p2")).alias("last")).select("conv_id", "last.*")
    per_hash = whole.groupBy("place", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"))
    after = F.lead("place").over(Window.partitionBy("conv_id").orderBy("place"))
    proper = hashes.withColumn("_next", after).where("_next is not null").select("place", "p1", "p2").distinct()
    return per_hash.join(proper, ["place", "p1", "p2"], "left_anti").select("conv_id", F.col("place").alias("n_turns"), "n_equal")


def _rendered() -> Column:
    parts = F.transform(F.array_sort(F.collect_list(F.struct("place", "role", "text"))), lambda t: F.concat(F.lit(TURN_HEAD), t["role"], F.lit("\n"), t["text"], F.lit(TURN_END)))
    return F.concat_ws("", parts)


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal and ``rendered`` of the maximal conversations."""
    prefixes = materialize(prefix_hashes(conversations), "prefixes")
    kept = materialize(maximal_conversations(prefixes), "maximal")
    turns = prefixes.select("conv_id", "place", "role", "text")
    texts = turns.join(kept, turns["conv_id"].eqNullSafe(kept["conv_id"]), "left_semi").groupBy("conv_id").agg(_rendered().alias("rendered"))
    return kept.join(texts, kept["conv_id"].eqNullSafe(texts["conv_id"])).select(kept["conv_id"], "n_turns", "n_equal", "rendered")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


ORACLE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
           FROM conversations),
p AS (SELECT conv_id, place, count(*) OVER (PARTITION BY conv_id) AS n,
             string_agg('{TURN_HEAD}' || role || chr(10) || text || '<|im_end|>' || chr(10), '') OVER (PARTITION BY conv_id ORDER BY place) AS so_far
      FROM t),
w AS (SELECT n, so_far, min(conv_id) AS conv_id, count(*) AS n_equal FROM p WHERE place = n GROUP BY n, so_far)
SELECT conv_id, n AS n_turns, n_equal, so_far AS rendered FROM w
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.place < p.n AND p.place = w.n AND p.so_far = w.so_far)
"""

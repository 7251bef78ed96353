"""Chat formatting of logged conversations, after collapsing cumulative snapshots.

Logs often hold a conversation several times, each time a few turns longer. A rolling hash
runs over the turns of each conversation; one whose last hash occurs before the end of
another is a snapshot of a longer one and goes, by an anti-join of hashes. Of equal
conversations the one with the smallest id stays. The rest are rendered.

The hash of a turn covers its place, role and text; the hashes of a prefix are combined by
exclusive or, twice with different seeds (128 bits). That combination is associative, so a
long conversation is handled in blocks of turns whose totals are then carried over: no task
needs a whole one before rendering, where a conversation is one row of the result.

Defined results: turns are ordered by turn (null first), role and a hash of the text;
turn numbers belong to what is compared; repeated rows of a turn
count once; a null role is `user`, a null text is empty; rows without conversation id are
left out; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.shared import stored

#: Turn numbers in a block.
BLOCK = 256
START, END = "<|im_start|>", "<|im_end|>"


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, n_turns, h1, h2): the hash of every conversation's first `pos` turns.

    `turns` has conv_id, turn, role, text without repeated rows.
    """
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62)))
    light = turns.select("conv_id", block.alias("block"), "turn", "role", F.xxhash64("text").alias("t1"), F.md5("text").alias("t2"))
    within = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "t2")
    rows = light.withColumn("k", F.row_number().over(within))
    # the place within a conversation is block and place in it: equal prefixes have equal ones
    salted = [F.col("block"), F.col("k"), F.col("turn"), F.col("role"), F.col("t1"), F.col("t2")]
    one = rows.select("conv_id", "block", "k", F.xxhash64(F.lit(1), *salted).alias("x1"), F.xxhash64(F.lit(2), *salted).alias("x2"))
    so_far = Window.partitionBy("conv_id", "block").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    one = one.withColumns({"b1": F.bit_xor("x1").over(so_far), "b2": F.bit_xor("x2").over(so_far)})
    totals = one.groupBy("conv_id", "block").agg(
        F.count("*").alias("n"), F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2")
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    zero = F.lit(0).cast("long")
    carried = totals.select(
        "conv_id",
        "block",
        F.sum("n").over(whole).alias("n_turns"),
        F.coalesce(F.sum("n").over(before), zero).alias("p0"),
        F.coalesce(F.bit_xor("s1").over(before), zero).alias("c1"),
        F.coalesce(F.bit_xor("s2").over(before), zero).alias("c2"),
    )
    joined = one.join(carried, ["conv_id", "block"])
    return joined.select(
        "conv_id",
        (F.col("p0") + F.col("k")).alias("pos"),
        "n_turns",
        F.col("b1").bitwiseXOR(F.col("c1")).alias("h1"),
        F.col("b2").bitwiseXOR(F.col("c2")).alias("h2"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id and n_turns of the conversations that no longer one begins with."""
    hashes = stored(prefixes(turns))
    key = ["pos", "h1", "h2"]
    ends = hashes.filter("pos = n_turns").groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    inner = hashes.filter("pos < n_turns").select(*key).distinct()
    return ends.join(inner, key, "left_anti").select("conv_id", F.col("pos").alias("n_turns"))


def format_chats(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per maximal conversation: conv_id, n_turns, chat (the rendered text)."""
    turns = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("user")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    turns = turns.distinct()
    kept = maximal(turns)
    shown = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END + "\n"))
    said = turns.join(kept.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id")
    rows = said.agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.md5("text").alias("t2"), shown.alias("shown")))).alias("all"))
    chat = F.array_join(F.col("all.shown"), "")
    return rows.select(F.col("conv_id").alias(conv), F.size("all").cast("long").alias("n_turns"), chat.alias("chat"))


#: Snapshots by comparing lists of turns; the rendering is the same text.
ORACLE = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), said AS (
  SELECT conv_id, turn, role, text,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown,
         row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))
), sofar AS (
  SELECT conv_id, pos, n, string_agg(coalesce(turn, -1) || ' ' || shown, '') OVER (
    PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS prefix
  FROM said
), ends AS (
  SELECT prefix, min(conv_id) AS conv_id FROM sofar WHERE pos = n GROUP BY prefix
), kept AS (
  SELECT conv_id FROM ends WHERE prefix NOT IN (SELECT prefix FROM sofar WHERE pos < n)
)
SELECT conv_id, count(*) AS n_turns, string_agg(shown, '' ORDER BY pos) AS chat
FROM said JOIN kept USING (conv_id) GROUP BY conv_id
"""

"""Chat formatting: reply trees to conversations.

Every branch of a reply tree, from its root to a leaf, is a possible
conversation. Self-joins with doubled steps give each message its path's score
and depth, branches are ranked by score, and self-joins with halved steps list
the messages of the chosen paths: as many joins as the depth has binary digits.
Texts join only the chosen paths. A conversation is one string, its loss mask
the places of the answers' texts in it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contestlab.llm.registry import registered
from contestlab.llm.tables import read
from contestlab.sources.scratch import written

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ANSWER = "assistant"


@dataclass(frozen=True)
class Branches:
    """How many branches of a tree are kept: those whose messages have the
    highest mean score, ties to the smaller leaf."""

    keep: int = 1


def escaped(text: Column) -> Column:
    """A text without the first two signs of any marker; ``unescaped`` undoes it."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    """A single backslash stands only between the two signs, all others are
    doubled, so the two steps cannot mistake one for the other."""
    marked = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(marked, F.lit("\\\\"), F.lit("\\"))


def rises(messages: DataFrame) -> list[DataFrame]:
    """For k = 0, 1, ...: (tree, node, up, total, n) where ``up`` is the 2**k-th
    message above, null past the root, and ``total`` and ``n`` sum the scores
    and count the messages below ``up``. The last has no ``up`` but for messages
    whose parents run in a circle."""
    known = messages.select("tree", F.col("node").alias("parent"), F.lit(1).alias("there"))
    level = messages.join(known, ["tree", "parent"], "left").select(
        "tree",
        "node",
        F.when(F.col("there") == 1, F.col("parent")).alias("up"),
        F.col("score").alias("total"),
        F.lit(1).cast("bigint").alias("n"),
    )
    levels = [written(level, "rises")]
    open_ = levels[0].where("up IS NOT NULL").count()
    while open_:
        low, high = levels[-1], levels[-1]
        high = high.select(
            "tree",
            F.col("node").alias("up"),
            F.col("up").alias("next"),
            F.col("total").alias("more"),
            F.col("n").alias("further"),
        )
        level = low.join(high, ["tree", "up"], "left").select(
            "tree",
            "node",
            F.col("next").alias("up"),
            (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"),
            (F.col("n") + F.coalesce("further", F.lit(0).cast("bigint"))).alias("n"),
        )
        levels.append(written(level, "rises"))
        left = levels[-1].where("up IS NOT NULL").count()
        if left == open_:  # circles only: every round ends some other path
            break
        open_ = left
    return levels


def chosen_paths(messages: DataFrame, branches: Branches = Branches()) -> DataFrame:
    """(tree, leaf, node, above): the messages of the chosen branches, with how
    many messages of the path follow each."""
    levels = rises(messages)
    parents = messages.select("tree", F.col("parent").alias("node")).where("node IS NOT NULL")
    leaves = levels[-1].where("up IS NULL").join(parents, ["tree", "node"], "left_anti")
    rank = Window.partitionBy("tree").orderBy((F.col("total") / F.col("n")).desc(), "node")
    paths = (
        leaves.withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= branches.keep)
        .select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("above"))
    )
    for k in reversed(range(len(levels) - 1)):
        step = levels[k].where("up IS NOT NULL").select("tree", "node", "up")
        higher = paths.join(step, ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above")
        )
        paths = written(paths.unionByName(higher), "paths")
    return paths


def formatted(messages: DataFrame, branches: Branches = Branches()) -> DataFrame:
    """(tree, leaf, n_turns, formatted, loss): one conversation per chosen path.

    ``messages`` has tree, node, parent (null at a root; a parent that does not
    exist is none), role, text and score (null: 0). Null roles and texts are
    empty. ``loss`` has the start (from 1) and length in code points of each
    answer's escaped text. Messages whose parents run in a circle are in no
    path. (tree, node) has to be unique, tree and node not null. No messages
    give no conversations. Other columns are ignored.
    """
    rows = messages.select(
        "tree",
        "node",
        "parent",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    rows = written(rows, "messages")
    paths = chosen_paths(rows.select("tree", "node", "parent", "score"), branches)
    turn = F.struct(
        (-F.col("above")).alias("place"),
        F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT)).alias("head"),
        escaped(F.col("text")).alias("body"),
        (F.col("role") == ANSWER).alias("answer"),
    )
    grouped = (
        paths.join(rows.select("tree", "node", "role", "text"), ["tree", "node"])
        .groupBy("tree", "leaf")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    start = F.struct(
        F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.char_length(t["head"])
        length = F.char_length(t["body"])
        span = F.array(F.struct(begin.alias("start"), length.alias("length")))
        spans = F.when(t["answer"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((begin + length + len(END)).alias("at"), spans.alias("spans"))

    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    return grouped.select(
        "tree",
        "leaf",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(pieces, "").alias("formatted"),
        F.aggregate("turns", start, step)["spans"].alias("loss"),
    )


def turns_of(formatted_text: Column) -> Column:
    """Read (role, text) of all turns back from a formatted conversation."""
    pieces = F.filter(F.split(formatted_text, "<\\|end\\|>"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.substr(F.substring_index(p, TEXT, 1), F.lit(len(TURN) + 1))).alias("role"),
            unescaped(F.substr(p, F.instr(p, TEXT) + F.lit(len(TEXT)))).alias("text"),
        ),
    )


def loss_text(formatted_text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    parts = F.transform(
        loss, lambda s: unescaped(F.substr(formatted_text, s["start"], s["length"]))
    )
    return F.array_join(parts, "")


def messages_of(conversations: DataFrame) -> DataFrame:
    """Turns as replies to the turn before. Turns are ordered by number, then
    role and text, nulls first; rows without a conv_id are one conversation."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order)
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("tree"),
        place.alias("node"),
        F.nullif(place - 1, F.lit(0)).alias("parent"),
        "role",
        "text",
        F.when(F.col("role") == ANSWER, F.char_length("text")).otherwise(0).alias("score"),
    )


PROBE = "\\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts look like markers."""
    spark = conversations.sparkSession
    schema = "conv_id bigint, turn bigint, role string, text string"
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, ANSWER, PROBE)], schema)
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}'))
), e AS (
  SELECT *, length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'))
          + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'))
          + {len(TURN) + len(TEXT) + len(END)} AS chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
                    ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{ANSWER}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)
                  FILTER (role = '{ANSWER}'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@registered("op2_chat_format", ORACLE)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = with_probe(read(spark, sf_dir, "conversations"))
    out = formatted(messages_of(conversations))
    lines = F.transform(
        turns_of(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    read_back = out.select(
        F.nullif(F.col("tree"), F.lit("null")).cast("bigint").alias("conv_id"),
        F.size(lines).cast("bigint").alias("n_turns"),
        F.array_join(lines, "").alias("turns"),
        loss_text(F.col("formatted"), F.col("loss")).alias("answers"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    return read_back.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.char_length("answers").cast("bigint").alias("loss_chars"),
        F.sha2("answers", 256).alias("loss_sha256"),
        "formatted_chars",
    )

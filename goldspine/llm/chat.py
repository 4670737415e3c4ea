"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context and its text as the only part to learn. A turn is written as

    ### Role: text</turn>\n

with the backslash, ``#`` and ``<`` of roles and texts (and the colon of a role)
written as a backslash and a letter, so no text can hold a mark, and unescaping
gives the text back. Turns after the last assistant turn, or a conversation without one, come
as a last example with nothing to learn, so that no turn is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_OPEN, _MIDDLE, _CLOSE = "### ", ": ", "</turn>\n"
TRAINED = "assistant"


#: What a character is written as; the backslash itself comes first, and last on the way back.
_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
_ROLE_ESCAPES = (*_ESCAPES, (":", "\\c"))


def escape(text: Column, escapes=_ESCAPES) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, escapes=_ESCAPES) -> Column:
    """Every backslash of an escaped text begins one of the escapes, so they can be undone one after the other."""
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def format_examples(
    turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """``conv_id, example, target_turn, formatted, loss_start, loss_chars`` for each example.

    ``formatted`` holds the context and the target; the learnt part is
    ``loss_chars`` code points from ``loss_start`` (0 for the first); none for a
    last example without a target. Null roles and texts are empty, turns of
    equal number are ordered by role and text, and repeated rows are turns of
    their own. Null ids are one conversation. An empty table has no examples.

    A conversation's turns meet in one task, since an example holds all that
    come before; examples of a conversation are as long as its square.
    """
    said = turns.select(
        F.col(f"`{id_column}`").alias("conv_id"), F.col(f"`{turn_column}`").alias("turn"),
        F.coalesce(F.col(f"`{role_column}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )
    shown = said.select(
        "conv_id",
        F.struct("turn", "role", "text", escape(F.col("role"), _ROLE_ESCAPES).alias("r"), escape(F.col("text")).alias("t")).alias("x"),
    )
    whole = shown.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    # A column of its own: used twice below, worked out once.
    written = whole.select(
        "conv_id",
        F.transform("xs", lambda x: (x["role"] == TRAINED)).alias("trained"),
        F.transform("xs", lambda x: x["turn"]).alias("turns"),
        F.transform("xs", lambda x: F.concat(F.lit(_OPEN), x["r"], F.lit(_MIDDLE), x["t"], F.lit(_CLOSE))).alias("parts"),
        F.transform("xs", lambda x: F.char_length(x["t"])).alias("chars"),
    )
    last = F.size("parts") - 1
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("trained", i) | (i == last))
    cut = written.select("conv_id", "trained", "turns", "parts", "chars", F.posexplode(ends).alias("example", "i"))
    learnt = F.get("trained", F.col("i"))
    formed = cut.select(
        "conv_id", F.col("example").cast("long").alias("example"),
        F.when(learnt, F.get("turns", F.col("i"))).alias("target_turn"),
        F.array_join(F.slice("parts", 1, F.col("i") + 1), "").alias("formatted"),
        F.when(learnt, F.get("chars", F.col("i"))).otherwise(0).cast("long").alias("loss_chars"),
    )
    return formed.withColumn(
        "loss_start",
        F.when(F.col("target_turn").isNotNull() | (F.col("loss_chars") > 0), F.char_length("formatted") - len(_CLOSE) - F.col("loss_chars")).otherwise(F.char_length("formatted")).cast("long"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """``conv_id`` with its turns, from its longest example, and all that is learnt, from every example in order."""
    learnt = F.expr("substring(formatted, cast(loss_start + 1 as int), cast(loss_chars as int))")
    per_conversation = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("formatted"),
        F.array_sort(F.collect_list(F.struct("example", unescape(learnt).alias("said")))).alias("learnt"),
        F.sum(F.char_length("formatted")).cast("long").alias("formatted_chars"),
    )
    # Escaped texts hold no "<", so every close is a mark; only what follows the last one is empty.
    pieces = F.filter(F.split("formatted", "</turn>\n", -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(_OPEN) + 1, 1 << 30)
        role = F.substring_index(body, _MIDDLE, 1)
        text = F.substring(body, F.char_length(role) + len(_MIDDLE) + 1, F.lit(1 << 30))
        return F.struct(unescape(role, _ROLE_ESCAPES).alias("role"), unescape(text).alias("text"))

    return per_conversation.select(
        "conv_id", F.transform(pieces, turn).alias("turns"), F.transform("learnt", lambda x: x["said"]).alias("learnt"), "formatted_chars"
    )


def summary(turns: DataFrame) -> DataFrame:
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return read_back(format_examples(turns)).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"), "formatted_chars",
    )


ORACLE = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, 15 - 1 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS p, count(*) OVER (PARTITION BY conv_id) AS n
  FROM said
), grown AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY p) AS total FROM sized
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(total) FILTER (WHERE role = 'assistant' OR p = n) AS BIGINT) AS formatted_chars
FROM grown GROUP BY conv_id
"""

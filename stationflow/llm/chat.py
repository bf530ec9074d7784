"""Chat formatting by event-sourced reconstruction.

A log holds events of messages: streamed deltas, edits and regenerations. The log of
a conversation, sorted by sequence, is folded to its final messages, which are then
rendered by a template that can be read back, with the spans that a model is trained
on. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The marks of a turn: head, end of head, end of turn.
HEAD, BODY, END = "[INST]", "[/INST]", "</s>"
_MARKS = r"(<)(/?s>)|(\[)(/?INST\])"


def escape(text: Column) -> Column:
    """No mark is left in the text: a backslash stands after its first character.

    A backslash of the text is doubled, so ``unescape`` gives the text back.
    """
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _MARKS, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\)|(<)\\(/?s>)|(\[)\\(/?INST\])", "$1$2$3$4$5")


def fold_events(events: DataFrame) -> DataFrame:
    """``conv_id, message, position, role, text``: the final messages of every log.

    ``events`` has ``conv_id, seq, message, event, role, text``. A ``delta`` adds to
    its message, an ``edit`` replaces it, and ``regenerate`` discards it and all
    messages begun after it so far. Events of one ``seq`` come in the order of their
    message, event and text; null texts are empty, other kinds of event are left out,
    null ids are one conversation. A message with no event left is gone; the role is
    that of its last event that has one, an edit or not.
    """
    kinds = F.col("event").isin("delta", "edit", "regenerate")
    place = F.struct("seq", "message", "event", F.coalesce("text", F.lit("")).alias("text"))
    of_message = Window.partitionBy("conv_id", "message")
    began = events.where(kinds).withColumn("place", place).withColumn("began", F.min("place").over(of_message))
    later = Window.partitionBy("conv_id").orderBy(F.col("place").desc()).rowsBetween(Window.unboundedPreceding, -1)
    dropped = F.min(F.when(F.col("event") == "regenerate", F.col("began"))).over(later)
    alive = began.withColumn("dropped", dropped).where("(dropped IS NULL OR dropped > began) AND event <> 'regenerate'")
    edited = F.max(F.when(F.col("event") == "edit", F.col("place"))).over(of_message)
    told = F.max(F.when(F.col("role").isNotNull(), F.struct("place", "role"))).over(of_message)["role"]
    left = alive.withColumns({"edited": edited, "told": told}).where("edited IS NULL OR place >= edited")
    folded = left.groupBy("conv_id", "message").agg(
        F.min("began").alias("began"),
        F.max("told").alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list("place")), lambda e: e["text"]), "").alias("text"),
    )
    position = F.row_number().over(Window.partitionBy("conv_id").orderBy("began"))
    return folded.select("conv_id", "message", position.alias("position"), "role", "text")


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """``conv_id, n_turns, formatted, loss``: one text per conversation.

    ``loss`` has the spans (code points, end exclusive) of what messages with the role
    ``learn`` say, without their marks. Null roles and texts are empty.
    """
    head = F.concat(F.lit(HEAD), escape(F.coalesce("role", F.lit(""))), F.lit(BODY))
    turns = messages.select(
        "conv_id", "position", "role", head.alias("head"), escape(F.coalesce("text", F.lit(""))).alias("body")
    )
    so_far = Window.partitionBy("conv_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + F.lit(len(END))
    turns = turns.withColumn("start", F.coalesce(F.sum(size).over(so_far), F.lit(0)) + F.length("head"))
    turn = F.struct(
        "position",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        F.when(F.col("role") == learn, F.struct("start", (F.col("start") + F.length("body")).alias("end"))).alias("loss"),
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join("turns.piece", "").alias("formatted"),
        F.filter(F.col("turns.loss"), lambda s: s.isNotNull()).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a rendered text: an array of ``role, text``."""
    pieces = F.split(formatted, END, -1)
    whole = F.slice(pieces, 1, F.size(pieces) - 1)
    halves = F.transform(whole, lambda p: F.split(p, r"\[/INST\]", 2))
    return F.transform(
        halves,
        lambda h: F.struct(
            unescape(F.substring(h[0], len(HEAD) + 1, 2**30)).alias("role"), unescape(h[1]).alias("text")
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """What stands under the loss spans, each as it was said."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))))


def table_events(rows: DataFrame) -> DataFrame:
    """The log of a table of whole turns: each row is a message of one delta.

    Rows come by turn, null first, and rows of one turn by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    seq = F.row_number().over(order).cast("long")
    return rows.select("conv_id", seq.alias("seq"), "role", "text").select(
        "conv_id", "seq", F.col("seq").alias("message"), F.lit("delta").alias("event"), "role", "text"
    )


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    told = f"{END}{HEAD} ok {BODY}"
    own = spark.createDataFrame(
        [(-1, 0, "user", told), (-1, 1, "assistant", told)], "conv_id long, turn long, role string, text string"
    )
    done = render(fold_events(table_events(rows.unionByName(own))))
    back = done.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("said")
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    said = F.array_join("said", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(said).cast("long").alias("loss_chars"),
        F.sha2(said, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP8_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT conv_id, turn, role, text AS raw, coalesce(role, '') AS r, coalesce(text, '') AS t,
    length(replace(coalesce(role, ''), '\', '\\')) + len(regexp_extract_all(coalesce(role, ''), '</?s>|\[/?INST\]'))
    + length(replace(coalesce(text, ''), '\', '\\')) + len(regexp_extract_all(coalesce(text, ''), '</?s>|\[/?INST\]')) AS n
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, raw NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(t) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN t END, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, raw NULLS FIRST), '')) AS loss_sha256,
  CAST(sum(n + 6 + 7 + 4) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

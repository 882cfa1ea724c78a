"""Chat formatting: every dialogue once from the view of each participant, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turns of one prefix-sum chunk: a dialogue of any length is numbered chunk by chunk.
CHUNK_TURNS = 256
#: Speakers with this name give instructions and take no part.
SYSTEM = "system"
UNKNOWN = "unknown"
#: White space and line ends in a speaker's name.
SPACES = r"[\x20\x09-\x0D\x{85}\x{A0}\x{2028}\x{2029}]+"
#: Marks of the template; the start of a mark inside a text is broken up, so a text cannot forge one.
START, END = "<|im_start|>", "<|im_end|>"


def render_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text") -> DataFrame:
    """For each dialogue and each of its participants, the dialogue as training text with that speaker as the assistant.

    One row a turn and view: conv_id, perspective, seq (from 0), turn, role, name, segment, loss (1 if the view's own
    speaker talks), char_start and char_end of the segment in the whole rendered dialogue, and target_start and target_end
    of what is learned in it (the speaker's words and the end mark; null where loss is 0). The segments of a view in order
    of seq, put together, are the rendered dialogue. They stay rows, so that a dialogue of any length is never one value
    nor one task's work; `whole_dialogues` joins them where dialogues are known to be short.

    Others speak as named users; `system` turns are system turns in each view, and a dialogue without participants gives
    no view. Null or blank speakers are `unknown`, runs of white space in a name one space, null texts empty. Turns of any
    length are one row; an empty table gives none. Turns are ordered by turn (null last), speaker and
    text; repeated rows are repeated turns. A null conv_id is a dialogue like others. Other columns are ignored.
    """
    # white space of any kind in a name is one space: a line break would end the header line
    speaker = F.coalesce(F.nullif(F.trim(F.regexp_replace(speaker_col, SPACES, " ")), F.lit("")), F.lit(UNKNOWN))
    body = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|"), F.lit("< |"))
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), speaker.alias("name"), body.alias("body"))
    views = t.filter(F.col("name") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("name").alias("perspective")).distinct()
    d = t.join(views, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own = F.col("name") == F.col("perspective")
    role = F.when(own, "assistant").when(F.col("name") == SYSTEM, SYSTEM).otherwise("user")
    label = F.replace("name", F.lit("<|"), F.lit("< |"))
    head = F.concat(F.lit(START), role, F.when(role == "user", F.concat(F.lit(" name="), label)).otherwise(F.lit("")), F.lit("\n"))
    d = d.select(
        "conv_id",
        "perspective",
        "turn",
        role.alias("role"),
        "name",
        F.concat(head, "body", F.lit(END + "\n")).alias("segment"),
        own.cast("int").alias("loss"),
        F.length(head).alias("head_chars"),
        F.coalesce(F.floor(F.col("turn") / CHUNK_TURNS), F.lit((1 << 62))).cast("long").alias("chunk"),
    )
    keys = ["conv_id", "perspective", "chunk"]
    order = Window.partitionBy(*keys).orderBy(F.col("turn").asc_nulls_last(), "name", "segment")
    chars = F.length("segment").cast("long")
    d = d.withColumn("at", F.row_number().over(order).cast("long") - 1).withColumn("chars_to", F.sum(chars).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("chars_to").alias("chars"))
    offsets = sums.select(F.col("conv_id").alias("_c"), F.col("perspective").alias("_p"), F.col("chunk").alias("_k"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars0"))
    d = d.join(offsets, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("perspective") == F.col("_p")) & (F.col("chunk") == F.col("_k")))
    end = F.col("chars0") + F.col("chars_to")
    return d.select(
        "conv_id",
        "perspective",
        (F.col("n0") + F.col("at")).alias("seq"),
        "turn",
        "role",
        "name",
        "segment",
        "loss",
        (end - chars).alias("char_start"),
        end.alias("char_end"),
        F.when(F.col("loss") == 1, end - chars + F.col("head_chars")).alias("target_start"),
        F.when(F.col("loss") == 1, end - 1).alias("target_end"),
    )


def whole_dialogues(views: DataFrame) -> DataFrame:
    """conv_id, perspective, text, targets: segments put together, for dialogues known to fit a row."""
    parts = F.sort_array(F.collect_list(F.struct("seq", "segment", "loss", "target_start", "target_end")))
    return views.groupBy("conv_id", "perspective").agg(parts.alias("p")).select(
        "conv_id", "perspective", F.array_join("p.segment", "").alias("text"), F.transform(F.filter("p", lambda s: s["loss"] == 1), lambda s: F.struct(s["target_start"], s["target_end"])).alias("targets")
    )


SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(nullif(trim(regexp_replace(role, '{SPACES}', ' ', 'g')), ''), '{UNKNOWN}') AS name, replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations),
v AS (SELECT DISTINCT conv_id, name AS perspective FROM t WHERE name <> '{SYSTEM}'),
d AS (
  SELECT t.conv_id, v.perspective, t.turn, t.name, t.body,
    CASE WHEN t.name = v.perspective THEN 'assistant' WHEN t.name = '{SYSTEM}' THEN '{SYSTEM}' ELSE 'user' END AS role
  FROM t JOIN v ON t.conv_id IS NOT DISTINCT FROM v.conv_id),
h AS (
  SELECT *, '{START}' || role || CASE WHEN role = 'user' THEN ' name=' || replace(name, '<|', '< |') ELSE '' END || chr(10) AS head FROM d),
s AS (SELECT *, head || body || '{END}' || chr(10) AS segment FROM h),
w AS (
  SELECT *, row_number() OVER o - 1 AS seq, sum(length(segment)) OVER (o ROWS UNBOUNDED PRECEDING) AS char_end
  FROM s WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, name, segment))
SELECT conv_id, perspective, seq, turn, role, name, segment, CAST(role = 'assistant' AS INTEGER) AS loss,
  CAST(char_end - length(segment) AS BIGINT) AS char_start, CAST(char_end AS BIGINT) AS char_end,
  CASE WHEN role = 'assistant' THEN CAST(char_end - length(segment) + length(head) AS BIGINT) END AS target_start,
  CASE WHEN role = 'assistant' THEN CAST(char_end - 1 AS BIGINT) END AS target_end
FROM w
"""

"""Chat formatting in budgeted windows.

Turns are put in order and their tokens summed up. The running sum, cut every
``SPAN`` tokens, gives turn-aligned spans: a turn is new in the window in which
it starts. A window repeats the turns that start in the ``HISTORY`` tokens
before its cut, and the conversation's first turn if that is a system turn.
Repeated turns come first and are masked; the loss is on the new turns of the
assistant, so each of its texts counts once. A window holds the tokens of its
span, history and system turn, and may end in a turn that is longer than that.

A turn is ``<|turn|>role``, a line break, the text, ``<|end|>`` and a line
break. Roles and texts have ``&``, ``<`` and ``[`` written as entities, and line
breaks in roles too, so no control string (``<|turn|>``, ``</s>``, ``[INST]``)
can stand in them, and the output can be read back exactly.

A turn's tokens are its words and punctuation marks, plus ``TURN_TOKENS``.
DataFrame functions only. Turns are range-partitioned in their order and running
sums are taken by range, so a conversation may hold any share of the rows; only
turns of one conversation that are equal in number, role and the first ``LEAD``
code points are in one range. Windows are rows of their own. ``read_back``, which
the query needs for its digests, puts a whole conversation in one row: its text
must stay under the two gigabytes of a Spark value.

Nulls: a null text or role is empty; a null turn comes before all others, a
null conv_id is a conversation. Turns of equal number are ordered by role and
text; repeated rows are turns of their own. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from comptoir.sources.stores import written

SPAN, HISTORY, TURN_TOKENS = 384, 128, 4
#: Code points of a text that ranges of turns are cut by.
LEAD = 32
TURN, END = "<|turn|>", "<|end|>\n"
ASSISTANT, SYSTEM = "assistant", "system"
#: A conversation whose texts look like control strings.
CONTROL = (-7, "</s>[INST] ok [/INST]")


def escaped(text: Column) -> Column:
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")):
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def unescaped(text: Column) -> Column:
    for character, entity in (("\n", "&#10;"), ("[", "&#91;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def with_control_conversation(conversations: DataFrame) -> DataFrame:
    number, text = CONTROL
    rows = conversations.sparkSession.createDataFrame(
        [(number, 0, "user", text), (number, 1, ASSISTANT, text)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionAll(rows)


def _placed(conversations: DataFrame) -> DataFrame:
    """Turns with ``block`` and ``at`` (their order), ``before`` (tokens of earlier turns) and ``tokens``."""
    text = F.coalesce("text", F.lit(""))
    tokens = F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")) + TURN_TOKENS
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), tokens.cast("long").alias("tokens"))
    ranged = turns.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, LEAD))
    turns = written(ranged.withColumn("block", F.spark_partition_id()), "chat-turns")
    sums = turns.groupBy("conv_id", "block").agg(F.sum("tokens").alias("sum"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select("conv_id", "block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("shift"))
    shifts = shifts.select(*(F.col(c).alias(f"_{c}") for c in shifts.columns))
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("block") == F.col("_block"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    running = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    joined = turns.join(shifts, same).select(
        *turns.columns, F.row_number().over(inside).alias("at"), (running + F.col("_shift") - F.col("tokens")).alias("before"))
    return written(joined, "chat-placed")


def windows(conversations: DataFrame, span: int = SPAN, history: int = HISTORY) -> DataFrame:
    """conv_id, window, repeated (turns), text, loss (spans of code points), tokens: one row per window."""
    if not 0 <= history < span:
        raise ValueError("history must be less than span")
    placed = _placed(conversations)
    cut = F.floor(F.col("before") / span)
    new = placed.select("*", cut.alias("window"), F.lit(2).alias("kind"))
    again = placed.where((cut + 1) * span - F.col("before") <= history)
    again = again.select("*", (cut + 1).alias("window"), F.lit(1).alias("kind"))
    # The system turn, in every window but its own; history never reaches back to it.
    first = placed.where((F.col("before") == 0) & (F.col("at") == 1) & (F.col("role") == SYSTEM))
    later = new.where("window > 0").select(F.col("conv_id").alias("_conv_id"), "window").distinct()
    later = later.withColumn("kind", F.lit(0))
    system = first.join(later, F.col("conv_id").eqNullSafe(F.col("_conv_id"))).drop("_conv_id")
    order = ["kind", "block", "at"]
    all_turns = new.unionByName(again).unionByName(system)

    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("&#10;"))
    head = F.concat(F.lit(TURN), role, F.lit("\n"))
    body = escaped(F.col("text"))
    shown = all_turns.select(
        "conv_id", "window", *order, "tokens", (F.col("kind") == 2).alias("new"),
        F.concat(head, body, F.lit(END)).alias("shown"),
        F.length(head).alias("head"), F.length(body).alias("body"),
        ((F.col("kind") == 2) & (F.col("role") == ASSISTANT)).alias("counts"))
    group = Window.partitionBy("conv_id", "window").orderBy(*order)
    before = F.coalesce(F.sum(F.length("shown")).over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = before + F.col("head")
    spans = F.when(F.col("counts"), F.struct(start.alias("start"), (start + F.col("body")).alias("end")))
    parts = shown.select("conv_id", "window", *order, "tokens", "new", "shown", spans.alias("loss"))
    formatted = parts.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct(*order, "shown", "loss"))).alias("turns"),
        F.sum(F.when(F.col("new"), 0).otherwise(1)).alias("repeated"), F.sum("tokens").alias("tokens"),
        F.max("new").alias("any_new"))
    return formatted.where("any_new").select(
        "conv_id", "window", "repeated", F.concat_ws("", "turns.shown").alias("text"),
        F.filter("turns.loss", lambda x: x.isNotNull()).alias("loss"), "tokens")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars: one row per conversation.

    From the formatted text and its loss spans alone: new turns are parsed and
    put together. The digests are of whole conversations.
    """
    pieces = F.split("text", r"<\|end\|>\n")
    turns = F.slice(pieces, F.col("repeated") + 1, F.size(pieces) - 1 - F.col("repeated"))
    parsed = F.transform(turns, lambda t: unescaped(F.substr(t, F.lit(len(TURN) + 1))))
    marked = F.transform("loss", lambda s: unescaped(F.substr("text", s["start"] + 1, s["end"] - s["start"])))
    each = formatted.select(
        "conv_id", "window", F.size(turns).alias("n"), F.concat_ws("", F.transform(parsed, lambda t: F.concat(t, F.lit("\n")))).alias("turns"),
        F.concat_ws("", marked).alias("loss"), F.length("text").alias("chars"))
    whole = each.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count(F.lit(1)).alias("n_windows"),
        F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("parts"))
    loss = F.concat_ws("", "parts.loss")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.concat_ws("", "parts.turns"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"), "n_windows")


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    """Every conversation and the one of control strings, formatted and read back."""
    return read_back(written(windows(with_control_conversation(conversations)), "chat-windows"))


_SHOWN_SQL = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"
FORMATTED_CONVERSATIONS_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {CONTROL[0]}, 0, 'user', '{CONTROL[1]}' UNION ALL SELECT {CONTROL[0]}, 1, '{ASSISTANT}', '{CONTROL[1]}'),
counted AS (
  SELECT *, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}\\x09-\\x0D\\x20]')) + {TURN_TOKENS} AS tokens,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         {len(TURN) + 1 + len(END)} + length({_SHOWN_SQL.format('text')}) + length(replace({_SHOWN_SQL.format('role')}, chr(10), '&#10;')) AS shown
  FROM turns),
placed AS (SELECT *, (sum(tokens) OVER (PARTITION BY conv_id ORDER BY place) - tokens)::BIGINT AS before FROM counted),
cut AS (SELECT *, before // {SPAN} AS span FROM placed),
opened AS (SELECT DISTINCT conv_id, span FROM cut),  -- windows with new turns
repeats AS (
  SELECT c.conv_id, shown FROM cut c JOIN opened o ON c.conv_id IS NOT DISTINCT FROM o.conv_id AND o.span = c.span + 1
  WHERE (c.span + 1) * {SPAN} - before <= {HISTORY}
  UNION ALL SELECT c.conv_id, shown FROM cut c JOIN opened o ON c.conv_id IS NOT DISTINCT FROM o.conv_id AND o.span > 0
  WHERE place = 1 AND role = '{SYSTEM}'),
again AS (SELECT conv_id, sum(shown) AS shown FROM repeats GROUP BY conv_id),
whole AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
         coalesce(sum(length(text)) FILTER (role = '{ASSISTANT}'), 0)::BIGINT AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = '{ASSISTANT}'), '')) AS loss_sha256,
         sum(shown) AS shown, count(DISTINCT span)::BIGINT AS n_windows
  FROM cut GROUP BY conv_id)
SELECT w.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, (w.shown + coalesce(a.shown, 0))::BIGINT AS formatted_chars, n_windows
FROM whole w LEFT JOIN again a ON w.conv_id IS NOT DISTINCT FROM a.conv_id
"""

"""Chat formatting by prefix-target expansion. DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are the context, its reply alone is trainable. A
turn is written as `[INST] role` newline `text` `</s>`; a reply ends with `</s>`, which is not trainable. Texts and roles
are escaped, so that none of the control strings can occur inside them, and the escaping can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, LINE, CLOSE = "[INST] ", "\n", "</s>"
REPLY = "assistant"
# Every control string starts with [ or <; a backslash starts an escape. The order matters.
_ESCAPES = (("\\", "\\0"), ("[", "\\1"), ("<", "\\2"))


def escape(text: Column) -> Column:
    for plain, written in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(_ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _role(role: Column) -> Column:
    """A role stands on one line: line feeds in it are escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\3"))


def _unrole(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\3"), F.lit("\n")))


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, example (from 0), context, target, trainable: one row per assistant turn.

    context ends with the header of the target's turn. Turns that follow the last reply, or all turns of a conversation
    without one, are kept in one more example without a target, trainable false. Turns are ordered by number, then role
    and text; NULL numbers come first; repeated rows are turns of their own. NULL roles and texts count as empty. Rows with a
    NULL conversation are one conversation. A conversation is one row of its own text; conversations never meet in a task's group.
    An empty table gives no rows.
    """
    given = turns.select(F.col(conv).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")).alias("t"))
    talks = given.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    header = lambda t: F.concat(F.lit(OPEN), _role(t["role"]), F.lit(LINE))
    written = talks.select(
        "conv_id",
        F.transform("ts", lambda t: F.concat(header(t), escape(t["text"]), F.lit(CLOSE))).alias("parts"),
        F.transform("ts", lambda t: F.struct(header(t).alias("header"), escape(t["text"]).alias("reply"),
                                             (t["role"] == REPLY).alias("is_reply"))).alias("ts"))
    ends = F.filter(F.sequence(F.lit(1), F.size("ts")), lambda i: F.element_at("ts", i)["is_reply"])
    marked = written.withColumn("ends", ends)
    rest = F.when(~F.element_at("ts", -1)["is_reply"], F.array(F.size("ts") + 1)).otherwise(F.array().cast("array<int>"))
    spread = marked.select("conv_id", "parts", "ts", F.posexplode_outer(F.concat("ends", rest)).alias("example", "end"))
    last = F.col("end") > F.size("ts")
    before = F.array_join(F.slice("parts", F.lit(1), F.col("end") - 1), "")
    own = F.get("ts", F.col("end") - 1)
    return spread.select(
        "conv_id", "example",
        F.when(last, before).otherwise(F.concat(before, own["header"])).alias("context"),
        F.when(last, F.lit("")).otherwise(F.concat(own["reply"], F.lit(CLOSE))).alias("target"),
        (~last).alias("trainable"))


def read_back(made: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all parsed from the formatted examples.

    The last example of a conversation holds all its turns. loss is the text under the loss mask of all examples in order.
    """
    formatted = F.concat("context", "target")
    size = len(CLOSE)
    loss = F.when(F.col("trainable"), unescape(F.substring("target", 1, F.length("target") - size))).otherwise("")
    whole = made.groupBy("conv_id").agg(
        F.max_by(formatted, "example").alias("all"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", loss.alias("loss")))), lambda e: e["loss"]), "").alias("loss"),
        F.sum(F.length(formatted)).cast("bigint").alias("formatted_chars"))
    # split drops nothing: the text ends with the last turn's end mark, which leaves one empty part.
    turns = F.split("all", CLOSE, -1)
    bodies = F.transform(F.slice(turns, F.lit(1), F.size(turns) - 1), lambda t: F.substring(t, F.lit(len(OPEN) + 1), F.length(t)))
    at = lambda t: F.instr(t, F.lit(LINE))
    read = F.transform("bodies", lambda t: F.concat(
        _unrole(F.substring(t, F.lit(1), at(t) - 1)), F.lit("\n"), unescape(F.substring(t, at(t) + 1, F.length(t))), F.lit("\n")))
    return whole.withColumn("bodies", bodies).select(
        "conv_id", F.size("bodies").cast("bigint").alias("n_turns"), F.sha2(F.array_join(read, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")

"""Chat examples by prefix-target expansion: one example per assistant turn."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Strings that chat templates give a meaning. None of them may be
# left readable inside a text or a role.
CONTROL_PATTERN = r"<(?=\|)|<(?=/?s>)|<(?=<SYS>>)|<(?=</SYS>>)|\[(?=/?INST\])"


@dataclass(frozen=True)
class Template:
    """Marks around a turn; ``newline`` stands for a line break inside a role."""

    begin: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    newline: str = "<|nl|>"


def escape(text: Column) -> Column:
    """Put a backslash behind the first character of every control string.

    Backslashes of the text are doubled first, so the way back is one scan.
    """
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL_PATTERN, r"$0\\")


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`: a backslash goes, the character behind it stays."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_examples(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    target_role: str = "assistant",
    template: Template = Template(),
) -> DataFrame:
    """Expand every conversation into training examples.

    Returns ``conv_id, example, target_turn, formatted, loss_start, loss_length,
    final``. Each assistant turn gives one example: all turns before it as
    context, then the reply; only the reply's text lies under the loss mask
    (``loss_start`` counts code points from 0). Turns behind the last reply, or
    a conversation without one, give one closing example with an empty mask
    (``target_turn`` null), so no turn is lost. ``final`` marks the example that
    holds the whole conversation.

    A conversation's text is built once; an example is a prefix of it. Turns are
    ordered by (turn, role, text), nulls first. Null texts and roles are empty;
    a null conversation id is one conversation; repeated turns all stay; an
    empty table gives no rows. Columns other than the four named are not read.
    """
    t = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    conv = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    marked = F.transform(
        "ts",
        lambda x: F.struct(
            x["turn"].alias("turn"),
            (x["role"] == target_role).alias("target"),
            F.concat(
                F.lit(template.begin),
                F.replace(escape(x["role"]), F.lit("\n"), F.lit(template.newline)),
                F.lit("\n"),
            ).alias("head"),
            escape(x["text"]).alias("body"),
        ),
    )
    conv = conv.select("conv_id", marked.alias("ms"))
    tail = len(template.end)
    lengths = F.transform(
        "ms", lambda m: F.struct(m["turn"].alias("turn"), m["target"].alias("target"),
                                 F.length(m["head"]).cast("long").alias("h"), F.length(m["body"]).cast("long").alias("b"))
    )
    spans = F.aggregate(
        lengths,
        F.struct(F.lit(0).cast("long").alias("at"),
                 F.array().cast("array<struct<turn:bigint,target:boolean,start:bigint,length:bigint,stop:bigint>>").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["h"] + x["b"] + tail).alias("at"),
            F.concat(
                acc["out"],
                F.array(F.struct(
                    x["turn"].cast("bigint").alias("turn"), x["target"].alias("target"),
                    (acc["at"] + x["h"]).alias("start"), x["b"].alias("length"),
                    (acc["at"] + x["h"] + x["b"] + tail).alias("stop"),
                )),
            ).alias("out"),
        ),
    )["out"]
    whole = F.array_join(F.transform("ms", lambda m: F.concat(m["head"], m["body"], F.lit(template.end))), "")
    conv = conv.select("conv_id", whole.alias("whole"), spans.alias("spans"))
    last = F.element_at("spans", -1)
    closing = F.struct(
        F.lit(None).cast("bigint").alias("turn"), F.lit(False).alias("target"),
        last["stop"].alias("start"), F.lit(0).cast("bigint").alias("length"), last["stop"].alias("stop"),
    )
    wanted = F.concat(
        F.filter("spans", lambda s: s["target"]),
        F.when(last["target"], F.slice(F.array(closing), 1, 0)).otherwise(F.array(closing)),
    )
    rows = conv.select("conv_id", "whole", last["stop"].alias("_stop"), F.posexplode(wanted).alias("example", "x"))
    return rows.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        F.col("x.turn").alias("target_turn"),
        F.substring(F.col("whole"), F.lit(1), F.col("x.stop").cast("int")).alias("formatted"),
        F.col("x.start").alias("loss_start"),
        F.col("x.length").alias("loss_length"),
        (F.col("x.stop") == F.col("_stop")).alias("final"),
    )


def read_examples(examples: DataFrame, template: Template = Template()) -> DataFrame:
    """Turns and trained text of every conversation, from formatted examples alone.

    Returns ``conv_id, turns (array of role and text), trained (array of texts in
    order), formatted_chars``. The turns come from each conversation's ``final``
    example, the trained texts from the loss spans.
    """
    pieces = F.split(F.col("formatted"), "\\Q" + template.end + "\\E")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    head = len(template.begin) + 1

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + F.lit(2), F.length(piece))
        role = F.replace(F.substring(role, F.lit(head), F.length(role)), F.lit(template.newline), F.lit("\n"))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    trained = unescape(F.substring(F.col("formatted"), (F.col("loss_start") + 1).cast("int"), F.col("loss_length").cast("int")))
    read = examples.select(
        "conv_id",
        F.when(F.col("final"), F.transform(pieces, turn)).alias("turns"),
        F.struct("example", trained.alias("text"), F.col("target_turn").isNotNull().alias("real")).alias("t"),
        F.length("formatted").cast("long").alias("n"),
    )
    return read.groupBy("conv_id").agg(
        F.first("turns", ignorenulls=True).alias("turns"),
        F.transform(F.sort_array(F.collect_list("t")), lambda x: x["text"]).alias("trained"),
        F.sum("n").alias("formatted_chars"),
    )

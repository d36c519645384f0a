r"""Chat formatting with a grammar round trip (DataFrame functions only).

A turn is rendered as ``<|im_start|>role\ntext<|im_end|>\n``. A deterministic
parser splits rendered text at the control strings and rejects whatever does
not follow this grammar. Every rendered turn is parsed again; if the recovered
turn is not the source turn, its content conflicts with the grammar and is
escaped: a backslash goes between ``<`` and ``|`` (one more where some are
there already), and a line end in a role becomes ``<|n|>``. The parser undoes
this, so the second rendering always parses back; the whole conversation is
parsed once more and an error is raised if any turn still differs.

Order: by turn (null first), then role, then text, so repeated turns have a
defined place. Null roles and texts count as empty, a null conversation id is
a conversation of its own, an empty table gives no rows, other columns are
ignored. One conversation is one output row, which is the operator's result
and the only thing that grows with a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ROLE_LINE_END = "<|n|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit(ROLE_LINE_END))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit(ROLE_LINE_END), F.lit("\n")))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(rendered: Column) -> Column:
    """The turns of a rendered text; a null role and text where the grammar is violated."""

    def turn(part: Column) -> Column:
        end, line = F.locate(END, part), F.locate("\n", part)
        valid = (end > 0) & (line > 0) & (line < end) & part.endswith(END + "\n") & (F.length(part) == end + len(END))
        role = F.when(valid, _unescape_role(F.substring(part, F.lit(1), line - 1)))
        text = F.when(valid, unescape(F.substring(part, line + 1, end - line - 1)))
        return F.struct(role.alias("role"), text.alias("text"))

    parts = F.split(rendered, r"<\|im_start\|>", -1)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def format_conversations(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans`` (start and length in code points)."""
    source = F.struct(F.col("role"), F.col("text"))
    turns = rows.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("same", parse(render(F.col("role"), F.col("text"))) == F.array(source))
    turns = turns.withColumn("role_out", F.when(F.col("same"), F.col("role")).otherwise(_escape_role(F.col("role")))).withColumn(
        "text_out", F.when(F.col("same"), F.col("text")).otherwise(escape(F.col("text")))
    )
    turns = turns.withColumn("rendered", render(F.col("role_out"), F.col("text_out")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "rendered")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.select(
        "conv_id", "role", "text", "rendered",
        F.row_number().over(order).alias("k"),
        F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0)).alias("at"),
        F.length("role_out").alias("role_chars"),
        F.length("text_out").alias("text_chars"),
    )
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("k", "at", "role", "text", "rendered", "role_chars", "text_chars"))).alias("turns")
    )
    formatted = grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["role"] == loss_role),
            lambda t: F.struct(
                (t["at"] + len(START) + t["role_chars"] + 1).alias("start"), t["text_chars"].cast("long").alias("length")
            ),
        ).alias("loss_spans"),
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
    )
    checked = F.when(parse(F.col("formatted")) == F.col("source"), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a rendered conversation does not parse back to its turns"))
    )
    return formatted.select("conv_id", checked.alias("formatted"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text, formatted_chars``, all taken from the formatted text."""
    masked = F.transform(
        "loss_spans",
        lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    return formatted.select(
        "conv_id",
        parse(F.col("formatted")).alias("turns"),
        F.array_join(masked, "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )

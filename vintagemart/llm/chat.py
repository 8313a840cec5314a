"""Chat examples by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context,
and only its reply is trainable. A conversation that ends with another role gets one
more example with all its turns and nothing trainable, so that no turn is lost.

A turn reads ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside roles and
texts get a backslash after their first character, or one more if they have some, so
the marks stay unambiguous and the texts come back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"

# Control strings of common chat templates, without their first
# character, as a pattern.
CONTROL = r"/?s>|/?INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>"
ESCAPE = rf"([<\[])(\\*)({CONTROL})"
UNESCAPE = rf"([<\[])\\(\\*)({CONTROL})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def escape_role(role: Column) -> Column:
    """A role stays on its line."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def chat_examples(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    target: str = "assistant",
) -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_length): a row per example.

    ``loss_start`` and ``loss_length`` are the code points of ``formatted`` that are
    trainable: the escaped reply, without marks; both are 0 in an
    example without a reply. Examples of a conversation are numbered by ``example``,
    and the last one holds all its turns.

    Turns are ordered by ``turn`` (null first), then role and text, so repeated rows
    and ties are turns like others. Null roles and texts are empty, and rows with a
    null id are one conversation. An empty table has no examples; other columns
    aren't read. An example holds its whole context, so a conversation has to fit
    into a row, and its examples grow with the square of its turns.
    """
    rows = turns.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    body = F.concat(escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")))
    rows = rows.select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            "text",
            F.concat(F.lit(START), body, F.lit(END + "\n")).alias("part"),
            F.when(F.col("role") == target, F.length(escape(F.col("text")))).alias("reply"),
        ).alias("row"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    # Zero-based places of the examples' last turns.
    ends = F.expr(
        "filter(sequence(0, size(rows) - 1), i -> rows[i].reply IS NOT NULL OR i = size(rows) - 1)"
    )
    each = whole.select("conv_id", "rows", F.posexplode(ends).alias("example", "last"))
    formatted = F.expr("array_join(transform(slice(rows, 1, last + 1), r -> r.part), '')")
    reply = F.expr("rows[last].reply")
    return each.select(
        "conv_id", "example", formatted.alias("formatted"), reply.alias("reply")
    ).select(
        "conv_id",
        "example",
        "formatted",
        F.when(F.col("reply").isNull(), 0)
        .otherwise(F.length("formatted") - len(END) - 1 - F.col("reply"))
        .alias("loss_start"),
        F.coalesce("reply", F.lit(0)).alias("loss_length"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)

    def turn(part: Column) -> Column:
        line = F.position(F.lit("\n"), part)
        length = F.length(part) - line - len(END) - 1
        return F.struct(
            unescape_role(F.substr(part, F.lit(1), line - 1)).alias("role"),
            unescape(F.substr(part, line + 1, length)).alias("text"),
        )

    return F.transform(parts, turn)


def read_loss(formatted: Column, start: Column, length: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.substr(formatted, start + 1, length))

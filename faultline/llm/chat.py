"""Chat formatting: every assistant turn becomes an example of its own, with all earlier turns as context.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. A control string inside a text cannot open or close a turn: one
backslash is added between ``<`` and ``|`` wherever only backslashes stand between them, so no ``<|`` of a text survives
and taking one backslash away restores it. Roles are percent-escaped (``%``, newline, ``<``). Only the reply an example
ends with is under its loss mask, so over all examples each assistant text is trained once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%3C"), F.lit("<")), F.lit("%25"), F.lit("%"))


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, example, target, text, loss_start, loss_end): the formatted examples of all conversations.

    ``target`` is true where the example ends with an assistant turn, whose text is [loss_start, loss_end) in code
    points. Turns after the last reply, or of a conversation without one, come out as a last example with an empty
    mask, so no turn is lost. Turns are ordered by (turn, role, text); a NULL turn comes first, repeated rows are
    repeated turns, a NULL role or text is empty, a NULL conv_id is a conversation of its own. Other columns are ignored.

    A conversation is put together in one row, as its longest example holds it whole in any case.
    """
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                 F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).alias("row"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows")).select(
        "conv_id", F.transform("rows", lambda r: r["role"]).alias("roles"),
        F.transform("rows", lambda r: F.concat(F.lit(OPEN), escape_role(r["role"]), F.lit("\n"), escape(r["text"]), F.lit(CLOSE))).alias("parts"),
    )
    last = F.size("roles") - 1
    each = whole.select(
        "conv_id", "parts", F.posexplode("roles").alias("example", "role"), last.alias("last"),
    ).filter((F.col("role") == ASSISTANT) | (F.col("example") == F.col("last")))
    target = F.col("role") == ASSISTANT
    built = each.select(
        "conv_id", "example", target.alias("target"),
        F.array_join(F.slice("parts", F.lit(1), F.col("example") + 1), "").alias("text"),
        F.length(F.element_at("parts", F.col("example") + 1)).alias("tail"),
    )
    end = F.length("text") - F.when(F.col("target"), len(CLOSE)).otherwise(0)
    start = F.when(F.col("target"), F.length("text") - F.col("tail") + len(OPEN) + len(ASSISTANT) + 1).otherwise(F.length("text"))
    return built.select("conv_id", "example", "target", "text", start.alias("loss_start"), end.alias("loss_end"))


def trained_text() -> Column:
    """The text under an example's loss mask, unescaped."""
    return unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))


def read_turns(text: Column) -> Column:
    """array<struct<role, text>> of a formatted example."""
    parts = F.split(text, r"<\|im_end\|>\n", -1)
    bodies = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.substring(p, F.lit(len(OPEN) + 1), F.length(p)))

    def turn(body: Column) -> Column:
        head = F.substring_index(body, "\n", 1)
        return F.struct(unescape_role(head).alias("role"), unescape(F.substring(body, F.length(head) + 2, F.length(body))).alias("text"))

    return F.transform(bodies, turn)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Turns and trained text of each conversation, read back from its examples."""
    longest = read_turns(F.max_by("text", "example"))
    spoken = F.array_join(F.transform(longest, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", trained_text().alias("t")))), lambda x: x["t"]), "")
    return formatted.groupBy("conv_id").agg(
        F.size(longest).cast("bigint").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.length(trained).cast("bigint").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"),
        F.sum(F.length("text")).cast("bigint").alias("formatted_chars"),
        F.count_if("target").alias("n_examples"),
    )

"""Chat formatting with Spark expressions only.

Turns are collected as structs and sorted; adjacent turns of one role are merged with array
functions into a block, whose parts keep their borders; blocks are concatenated to one
string.  Control strings inside texts and roles are escaped with a backslash, which
``unescaped`` takes out again, so the formatted string reads back to the turns it was made of.

    <|im_start|>role<|im_sep|>text[<|im_part|>text ...]<|im_end|>

The loss mask covers the texts of the roles that are trained on: (start, length) pairs in
code points of the formatted string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's marks, and the control strings that must not occur in a text.
START, SEP, PART, END = "<|im_start|>", "<|im_sep|>", "<|im_part|>", "<|im_end|>"
CONTROL = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
LOSS_ROLES = ("assistant",)

_TAILS = {head: "|".join(c[1:].replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for c in CONTROL if c[0] == head) for head in "<["}
_ESCAPE = rf"(<(?=(?:{_TAILS['<']}))|\[(?=(?:{_TAILS['[']})))"
_UNESCAPE = rf"(<(?=\\(?:{_TAILS['<']}))|\[(?=\\(?:{_TAILS['[']})))\\"


def escaped(text: Column) -> Column:
    """Reversible: backslashes are doubled, then one is put behind the first character of
    each control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _ESCAPE, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, _UNESCAPE, "$1"), F.lit("\\\\"), F.lit("\\"))


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_mask`` (array of start, length).

    Turns go by number (nulls first), then role and text; repeated rows are all kept.  Null
    roles and texts are empty; a null conversation id is a conversation of its own.  An
    empty table gives no rows.
    """
    role, text = (escaped(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in (role_col, text_col))
    trained = F.coalesce(F.col(role_col).isin(*loss_roles), F.lit(False))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), trained.alias("loss"))
    # Where a text starts is a running sum of what stands before it.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    new = F.coalesce(F.lag("role").over(order) != F.col("role"), F.lit(True))
    close = F.when(F.row_number().over(order) == 1, 0).otherwise(len(END))
    rows = rows.withColumn("before", F.when(new, close + F.length("role") + len(START) + len(SEP)).otherwise(len(PART)))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("start", F.sum(F.col("before") + F.length("text")).over(upto) - F.length("text"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "start", "loss"))).alias("turns"))
    # A block begins where the role differs from the turn before, and reaches to the next beginning.
    begins = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"]),
    )
    chats = chats.withColumn("begins", begins)
    blocks = F.transform(
        "begins",
        lambda b, k: F.struct(
            F.col("turns")[b]["role"].alias("role"),
            F.transform(F.slice("turns", b + 1, F.coalesce(F.get("begins", k + 1), F.size("turns")) - b), lambda t: t["text"]).alias("parts"),
        ),
    )
    written = lambda b: F.concat(F.lit(START), b["role"], F.lit(SEP), F.array_join(b["parts"], PART), F.lit(END))
    mask = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), F.length(t["text"]).alias("length")))
    return chats.select("conv_id", F.array_join(F.transform(blocks, written), "").alias("formatted"), mask.alias("loss_mask"))


def masked_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    part = lambda m: unescaped(F.substr(formatted, (m["start"] + 1).cast("int"), m["length"]))
    return F.array_join(F.transform(loss_mask, part), "")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string, in order."""
    blocks = F.filter(F.split(formatted, r"\Q" + START + r"\E"), lambda b: b != "")
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substring_index(F.substring_index(b, END, 1), SEP, -1), r"\Q" + PART + r"\E"),
                lambda t: F.struct(unescaped(F.substring_index(b, SEP, 1)).alias("role"), unescaped(t).alias("text")),
            ),
        )
    )

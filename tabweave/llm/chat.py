"""Chat formatting by prefix-target expansion: one training example per assistant turn.

Every assistant turn becomes an example of its own: all turns before it are context, and only its
text is trainable. Turns behind the last assistant turn make one more example without a target, so
that the formatted table holds every conversation whole. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed marks of the template.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
ASSISTANT = "assistant"

# "&" is escaped first and restored last. Behind it no "<|" of a text is left, so a mark found in the
# output is always the template's own.
_TEXT_ESCAPES = (("&", "&amp;"), ("<|", "&lt;|"))
_ROLE_ESCAPES = (*_TEXT_ESCAPES, ("\n", "&nl;"))


def _replace_all(value: Column, pairs) -> Column:
    for old, new in pairs:
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


def escape(value: Column, pairs=_TEXT_ESCAPES) -> Column:
    return _replace_all(value, pairs)


def unescape(value: Column, pairs=_TEXT_ESCAPES) -> Column:
    return _replace_all(value, [(new, old) for old, new in reversed(pairs)])


def format_examples(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, example, text, loss_start, loss_length, last``; offsets count code points from 0.

    ``text`` is the formatted context followed by the target turn; characters ``loss_start`` to
    ``loss_start + loss_length`` are its only trainable part, in escaped form. ``loss_start`` is null in
    an example without a target. ``last`` marks the example that holds the whole conversation.

    Turns are ordered by number, then role and text, nulls first; repeated turns all stay. A null role
    or text is empty; rows with a null conversation form one conversation. An empty table gives no
    rows. Other columns are not read.

    A conversation meets in one row, as its formatted text is one value. Examples are cut from that
    value one at a time, never held together.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    head = F.concat(F.lit(TURN_START), escape(role, _ROLE_ESCAPES), F.lit("\n"))
    body = escape(text)
    parts = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            role.alias("role"),
            text.alias("text"),
            F.concat(head, body, F.lit(f"{TURN_END}\n")).alias("part"),
            F.char_length(head).cast("long").alias("head"),
            F.char_length(body).cast("long").alias("body"),
        ).alias("turn"),
    )
    gathered = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    # Where each turn ends, as running sums of part lengths.
    ends = F.aggregate(
        "turns",
        F.expr("named_struct('at', 0L, 'ends', cast(array() AS array<bigint>))"),
        lambda s, t: F.struct(
            (s["at"] + F.char_length(t["part"])).alias("at"),
            F.array_append(s["ends"], s["at"] + F.char_length(t["part"])).alias("ends"),
        ),
        lambda s: s["ends"],
    )
    whole = gathered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["part"]), "").alias("formatted"),
        ends.alias("ends"),
        F.transform(
            "turns", lambda t: F.struct((t["role"] == ASSISTANT).alias("reply"), t["head"].alias("head"), t["body"].alias("body"))
        ).alias("turns"),
    )
    each = whole.select("conv_id", "formatted", "ends", F.posexplode("turns").alias("at", "turn")).select(
        "conv_id",
        "formatted",
        F.col("at").alias("example"),
        F.element_at("ends", F.col("at") + 1).alias("end"),
        "turn",
        (F.col("at") + 1 == F.size("ends")).alias("last"),
    )
    tail = F.lit(len(TURN_END) + 1)
    start = F.col("end") - tail - F.col("turn.body")
    return each.where("turn.reply OR last").select(
        "conv_id",
        "example",
        F.substr("formatted", F.lit(1), F.col("end").cast("int")).alias("text"),
        F.when(F.col("turn.reply"), start).alias("loss_start"),
        F.when(F.col("turn.reply"), F.col("turn.body")).alias("loss_length"),
        "last",
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted examples hold, per conversation, parsed from their texts and masks.

    ``turns`` come from the example that holds the whole conversation, the loss text from the masks of
    all examples, each reply once and in order.
    """
    target = F.substr("text", (F.col("loss_start") + 1).cast("int"), F.col("loss_length").cast("int"))
    loss = F.when(F.col("loss_start").isNotNull(), F.struct(F.col("example"), unescape(target).alias("text")))
    found = examples.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(loss)), lambda x: x["text"]), "").alias("loss_text"),
        F.max(F.when(F.col("last"), F.col("text"))).alias("whole"),
        F.sum(F.char_length("text").cast("long")).alias("formatted_chars"),
    )
    pieces = F.filter(F.split("whole", r"<\|im_start\|>"), lambda _, i: i > 0)

    def parse(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        start = F.char_length(role) + 2
        body = F.substr(piece, start, F.char_length(piece) - start + 1 - (len(TURN_END) + 1))
        return F.struct(unescape(role, _ROLE_ESCAPES).alias("role"), unescape(body).alias("text"))

    return found.select("conv_id", F.transform(pieces, parse).alias("turns"), "loss_text", "formatted_chars")

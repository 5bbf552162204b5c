"""Chat formatting by prefix-target expansion (dealt operator 7, DataFrame functions only).

Every assistant turn becomes one training example: all turns before it as context, and
the reply itself, whose text alone is under the loss mask.  If turns follow the last
reply (or there is none) one more example holds the whole conversation with an empty
mask, so the output holds every turn.  A turn reads

    <|im_start|>role NEWLINE text<|im_end|> NEWLINE

and inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``; a line
break in a role becomes a backslash and an ``n``.  No text can therefore hold a mark,
and ``unescape`` restores it exactly.

Defined cases: a null role or text is empty; turns go by turn number (null first), then
role and text, so ties and repeated rows have a fixed place and all are kept; a null
conv_id is a conversation of its own; an empty table gives no examples; other columns
are ignored.  An example holds its whole context, so the output of one conversation
grows with the square of its turns; conversations do not meet in one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # an n after an odd run of backslashes was a line break; what stays in pairs is read as in a text
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def examples(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) to examples: conv_id, example (from 1), n_turns,
    formatted, loss_start (characters before the mask) and loss_chars (0: nothing trainable)."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    conv = conv.withColumn("turns", F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
        escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("reply"))))
    n = F.size("turns")
    targets = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("turns", i)["reply"])
    tail = F.when(F.element_at("turns", -1)["reply"], F.array().cast("array<int>")).otherwise(F.array(F.lit(0)))
    each = conv.select("conv_id", "turns", F.posexplode(F.concat(targets, tail)).alias("example", "target"))
    last = F.when(F.col("target") > 0, F.col("target")).otherwise(n)
    goal = F.element_at("turns", last)
    before = F.array_join(F.transform(F.slice("turns", 1, last - 1), lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "")
    made = each.select("conv_id", (F.col("example") + 1).alias("example"), last.alias("n_turns"), before.alias("before"),
                       goal["head"].alias("head"), goal["body"].alias("body"), (F.col("target") > 0).alias("trained"))
    return made.select(
        "conv_id", "example", "n_turns", F.concat("before", "head", "body", F.lit(END + "\n")).alias("formatted"),
        F.when(F.col("trained"), F.length("before") + F.length("head")).otherwise(F.lit(0)).alias("loss_start"),
        F.when(F.col("trained"), F.length("body")).otherwise(F.lit(0)).alias("loss_chars"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example as an array of (role, text)."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    bodies = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(bodies, lambda b: F.struct(
        unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substr(b, F.length(F.substring_index(b, "\n", 1)) + 2)).alias("text")))


def trained_text(formatted: Column, start: Column, chars: Column) -> Column:
    return unescape(F.substr(formatted, start + 1, chars))


def digests(made: DataFrame) -> DataFrame:
    """Per conversation what its examples hold, read back from them."""
    each = made.select("conv_id", "example", "n_turns", "formatted",
                       trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("reply"))
    conv = each.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"), F.count("*").alias("n_examples"),
        F.sort_array(F.collect_list(F.struct("example", "reply"))).alias("replies"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"))
    conv = conv.select("conv_id", read_turns(F.col("longest")).alias("turns"), "n_examples", "formatted_chars",
                       F.array_join(F.transform("replies", lambda r: r["reply"]), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return conv.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")

"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns are context and only that reply is trainable.
A conversation that doesn't end with an assistant turn gets one more example without a trainable part, so that the
output holds every turn.

Template, per turn: `<|im_start|>` role newline text `<|im_end|>` newline. Control strings inside a text get a word
joiner (U+2060) after their first character and word joiners of the text are doubled, so unescaping is exact. A role
that isn't plain letters, digits, `_` or `-` is written as `=` and its base64.

Defined results: null text is empty; null role is an empty role; turns with equal numbers are ordered by role and text;
a null conversation id is a conversation; a conversation without assistant turns has loss 0 and the digest of the empty
string; an empty table gives an empty result; long texts are kept whole, and extra columns are ignored, whatever their
names. The output grows with the square of a conversation's turns: that is what the method asks for. A conversation and
its examples are handled in one row each, as the result has one digest a conversation: what bounds memory is the longest
conversation, not their number or the size of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import columns

JOINER = "\u2060"
START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of common templates.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "[INST]", "[/INST]"]
_REST = "|".join(f"(?<=\\{x[0]})(?=\\Q{x[1:]}\\E)" for x in CONTROL)


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit(JOINER), F.lit(JOINER * 2))
    return F.regexp_replace(doubled, _REST, JOINER)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"{JOINER}({JOINER}?)", "$1")


def _role(role: Column) -> Column:
    return F.when(role.rlike("^[A-Za-z0-9_-]+$"), role).otherwise(F.concat(F.lit("="), F.base64(F.encode(role, "UTF-8"))))


def _role_back(role: Column) -> Column:
    return F.when(role.startswith("="), F.decode(F.unbase64(F.substr(role, F.lit(2))), "UTF-8")).otherwise(role)


def expand(conversations: DataFrame) -> DataFrame:
    """conv_id, example, formatted, loss_start, loss_end (code points; null without a trainable part)."""
    conversations = columns(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grouped = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    parts = grouped.select(
        "conv_id",
        F.transform("ts", lambda t: F.struct(F.concat(F.lit(START), _role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("own"))).alias("ps"),
    )
    targets = F.filter(F.sequence(F.lit(1), F.size("ps")), lambda i: (i == F.size("ps")) | F.element_at("ps", i)["own"])
    each = parts.select("conv_id", "ps", F.explode(targets).alias("at"))
    before = F.array_join(F.transform(F.slice("ps", F.lit(1), F.col("at") - 1), lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), "")
    last = F.element_at("ps", F.col("at"))
    shown = each.select("conv_id", F.col("at").alias("example"), F.concat(before, last["head"]).alias("context"), last["body"].alias("reply"), last["own"].alias("own"))
    begin = F.length("context")
    return shown.select(
        "conv_id",
        "example",
        F.concat("context", "reply", F.lit(END + "\n")).alias("formatted"),
        F.when(F.col("own"), begin).alias("loss_start"),
        F.when(F.col("own"), begin + F.length("reply")).alias("loss_end"),
    )


def parse(formatted: Column) -> Column:
    """Array of struct(role, text) of a formatted example."""
    pieces = F.filter(F.split(formatted, "\\Q" + START + "\\E"), lambda x: x != "")
    return F.transform(
        pieces,
        lambda x: F.struct(
            _role_back(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(F.substr(x, F.instr(x, "\n") + 1, F.length(x) - F.instr(x, "\n") - F.lit(len(END) + 1))).alias("text"),
        ),
    )


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted examples alone: turns and trainable text, unescaped."""
    loss = unescape(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    read = examples.select("conv_id", "example", "formatted", F.length("formatted").alias("chars"), loss.alias("loss"))
    gathered = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sum("chars").cast("long").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"),
    )
    turns = gathered.select("conv_id", "formatted_chars", parse(F.col("whole")).alias("turns"), F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"))
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )

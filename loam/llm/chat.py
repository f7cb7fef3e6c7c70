"""Chat formatting with prefix-target expansion, with DataFrame operations only.

A conversation's turns, by turn number, are written as

    <|turn|>role
    text<|end|>

one after the other. Every assistant turn becomes an example of its own: all turns before it as context,
and its reply as the only text under the loss mask. Turns after the last reply (or all, if there is none)
become a last example without a target, so that no turn is lost.

Control strings in roles and texts (`<|`, `<s>`, `</s>`, `[INST]`, `[/INST]`) get a backslash after their
bracket, or one more if they have some; that is undone exactly by taking one away. So no text can open
or close a turn, here or in templates that use these strings.

Null roles and texts are empty. Rows of equal turn number stand in the order of role and text; null turn
numbers come first; rows of a null conversation id are one conversation. Repeated rows stay. An empty
table gives no examples. A conversation is put together in one task, since its longest example is the
whole of it. Texts of any length are written whole; as each example repeats what is before it, a conversation takes the
square of its turns. Only the named columns are read; others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
_BODY = r"(\||/?s>|/?INST\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _BODY, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _BODY, r"$1$2$3")


def role_line(role: Column) -> Column:
    """A role in one line: line feeds (and the sign that marks them) are percent-encoded."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def role_of(line: Column) -> Column:
    return F.replace(F.replace(unescaped(line), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def prefix_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", target_role: str = "assistant") -> DataFrame:
    """(conv_id, example, text, target_start, target_chars): one row per assistant turn, and per unanswered end.

    target_start (from 0) and target_chars count code points of text; both are null without a target.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    row = turns.select(F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    whole = row.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    head = lambda t: F.concat(F.lit(TURN), role_line(t["role"]), F.lit("\n"))
    whole = whole.select("conv_id", F.transform("ts", lambda t: F.struct(head(t).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == target_role).alias("target"))).alias("ts"))
    last = F.size("ts")
    ends = F.filter(F.sequence(F.lit(1), last), lambda k: (k == last) | F.element_at("ts", k)["target"])
    at = whole.select("conv_id", "ts", F.posexplode(ends).alias("example", "k"))
    own = F.element_at("ts", F.col("k"))
    before = F.array_join(F.transform(F.slice("ts", F.lit(1), F.col("k") - 1), lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "")
    parts = at.select("conv_id", "example", F.concat(before, own["head"]).alias("before"), own["body"].alias("body"), own["target"].alias("target"))
    return parts.select(
        "conv_id",
        "example",
        F.concat("before", "body", F.lit(END + "\n")).alias("text"),
        F.when(F.col("target"), F.char_length("before")).alias("target_start"),
        F.when(F.col("target"), F.char_length("body")).alias("target_chars"),
    )


def parsed_turns(text: Column) -> Column:
    """The array of (role, text) that a formatted text holds."""
    blocks = F.filter(F.split(text, r"<\|turn\|>"), lambda b, k: k > 0)

    def turn(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        n = F.char_length(role)
        body = F.substr(b, n + 2, F.char_length(b) - n - 1 - len(END) - 1)
        return F.struct(role_of(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(blocks, turn)


def target_text(text: Column, start: Column, chars: Column) -> Column:
    """What lies under the loss mask, unescaped; null without a target."""
    return unescaped(F.substr(text, start + 1, chars))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from its examples alone: its turns (of the longest example) and what the loss masks cover."""
    per = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"),
        F.sort_array(F.collect_list(F.when(F.col("target_start").isNotNull(), F.struct("example", target_text(F.col("text"), F.col("target_start"), F.col("target_chars")).alias("t"))))).alias("targets"),
        F.sum(F.char_length("text")).alias("formatted_chars"),
    )
    return per.select("conv_id", parsed_turns(F.col("longest")).alias("turns"), F.array_join(F.transform("targets", lambda x: x["t"]), "").alias("loss_text"), F.col("formatted_chars").cast("long"))

r"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes one example: all preceding turns are context, and only that reply is
trainable.  A conversation that does not end with an assistant turn gets one more example without a
target, so that no turn is lost.

Template (fixed values): an assistant turn is `TEXT</s>`, any other turn is `[INST] ROLE`, a newline,
`TEXT [/INST]`.  Inside texts and roles a control string gets one backslash after its opening bracket,
and one that already has backslashes there gets one more, so that unescaping takes exactly one away.
Newlines and backslashes of a role are written as `\n` and `\\`.

Scale: rows of a conversation meet once (hash of conv_id); examples are exploded from that row and
read back in the same partition, without another shuffle.  An example holds its whole context by
definition, so a conversation must fit a row, as its last example does anyway.

Cases: null text and null role are empty strings; rows tied on `turn` are ordered by role, then
text, and all stay; a null conv_id is a conversation of its own; null turns come first; an empty
table gives no examples; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
OPEN, SHUT, END = "[INST] ", " [/INST]", "</s>"
ASSISTANT = "assistant"

_PLAIN = r"(\[/?|</?)(\\*)(INST\]|s>)"
_ESCAPED = r"(\[/?|</?)\\(\\*)(INST\]|s>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _role_line(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_of(line: Column) -> Column:
    parts = F.split(unescaped(line), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def rendered(role: Column, text: Column) -> Column:
    """One turn in the template."""
    other = F.concat(F.lit(OPEN), _role_line(role), F.lit("\n"), escaped(text), F.lit(SHUT))
    return F.when(role == ASSISTANT, F.concat(escaped(text), F.lit(END))).otherwise(other)


def examples(conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
    """conv_id, example (from 1), text, loss_start, loss_length: one row per assistant turn, and one without loss
    (length null) for a conversation that ends otherwise.  Offsets count characters from 0."""
    rows = conversations.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("row"),
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("turns"))
    turns = turns.select(
        "conv_id",
        F.transform("turns", lambda t: rendered(t["role"], t["text"])).alias("parts"),
        F.transform("turns", lambda t: t["role"] == ASSISTANT).alias("target"),
    )
    last = F.size("parts")
    picks = F.filter(F.sequence(F.lit(1), last), lambda i: F.element_at("target", i.cast("int")) | (i == last))
    one = turns.select("conv_id", "parts", "target", F.posexplode(picks).alias("at", "k"))
    reply = F.element_at("parts", F.col("k"))
    trained = F.element_at("target", F.col("k"))
    text = F.array_join(F.slice("parts", F.lit(1), F.col("k")), "")
    return one.select(
        "conv_id",
        (F.col("at") + 1).alias("example"),
        text.alias("text"),
        F.when(trained, F.length(text) - F.length(reply)).cast("long").alias("loss_start"),
        F.when(trained, F.length(reply) - len(END)).cast("long").alias("loss_length"),
    )


def parsed(text: Column) -> Column:
    """The turns of a formatted text: array of (role, text), read from the template alone."""
    pieces = F.filter(F.split(text, r"(?<=</s>)|(?<= \[/INST\])"), lambda p: p != "")

    def turn(p: Column) -> Column:
        body = F.substring(p, len(OPEN) + 1, F.length(p) - len(OPEN) - len(SHUT))
        cut = F.instr(body, "\n")
        return F.when(
            p.startswith(OPEN),
            F.struct(
                _role_of(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                unescaped(F.substring(body, cut + 1, F.length(body))).alias("text"),
            ),
        ).otherwise(
            F.struct(
                F.lit(ASSISTANT).alias("role"),
                unescaped(F.substring(p, F.lit(1), F.length(p) - len(END))).alias("text"),
            )
        )

    return F.transform(pieces, turn)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation: turns and trained text recovered from the examples, and the size of the output.

    The last example holds all turns, so it alone is parsed; replies come from each example's masked range."""
    reply = F.when(
        F.col("loss_length").isNotNull(),
        unescaped(F.substring("text", F.col("loss_start").cast("int") + 1, F.col("loss_length").cast("int"))),
    )
    each = formatted.select("conv_id", "example", "text", reply.alias("reply"), F.length("text").cast("long").alias("chars"))
    replies = F.array_sort(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply"))))
    grouped = each.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"), replies.alias("r"), F.sum("chars").alias("formatted_chars")
    )
    turns = grouped.select("*", parsed(F.col("text")).alias("turns"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("r", lambda x: x["reply"]), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )

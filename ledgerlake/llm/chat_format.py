"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted by (turn, role, text);
adjacent turns of one role are merged into a message by slicing the sorted array at role
changes; messages are concatenated by the template

    <|im_start|>ROLE\\nTEXT[<|im_sep|>TEXT ...]<|im_end|>\\n

``<|im_sep|>`` keeps merged turns apart, so the turns can be read back one by one.
Texts are escaped reversibly: ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|``; roles
also have ``\\n`` as ``&#10;``.  An escaped string holds no ``<|``, hence no marker.

The loss mask is given per segment: ``segments`` are the parts of the formatted text in
order, each with ``loss`` (true for texts of the assistant).

NULL text and NULL role are empty strings, NULL turns come first, NULL conv_id is a
conversation of its own.  Repeated rows are repeated turns.  Other columns are ignored.
A conversation becomes one row, so all its turns meet in one task: its size is that
of the conversation's own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def format_conversations(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """conv_id, messages (role, texts), segments (text, loss), formatted."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    t = F.col("turns")
    sorted_ = (conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn))
                                                    .alias("turns"))
               .withColumn("starts", F.filter(
                   F.sequence(F.lit(0), F.size(t) - 1),
                   lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"])))
               .withColumn("ends", F.concat(F.slice("starts", F.lit(2), F.size("starts")),
                                            F.array(F.size(t)))))
    merged = sorted_.select("conv_id", F.transform(
        F.arrays_zip("starts", "ends"),
        lambda z: F.struct(
            F.get(t, z["starts"])["role"].alias("role"),
            F.transform(F.slice(t, z["starts"] + 1, z["ends"] - z["starts"]),
                        lambda x: x["text"]).alias("texts"))).alias("messages"))

    def part(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    segments = F.flatten(F.transform("messages", lambda m: F.concat(
        F.array(part(F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n")), no)),
        F.flatten(F.transform(m["texts"], lambda x, i: F.when(
            i == 0, F.array(part(escape(x), m["role"] == trained))).otherwise(
            F.array(part(F.lit(SEP), no), part(escape(x), m["role"] == trained))))),
        F.array(part(F.lit(END), no)))))
    return (merged.withColumn("segments", segments)
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]),
                                                  "")))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> from a formatted conversation."""
    blocks = F.split(formatted, r"\Q" + END.strip() + r"\E\n", -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = unescape_role(F.substring(head, F.lit(len(START) + 1), F.length(head)))
        body = F.substring(block, F.length(head) + 2, F.length(block))
        return F.transform(F.split(body, r"\Q" + SEP + r"\E", -1),
                           lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def masked_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")


def digest(formatted: DataFrame) -> DataFrame:
    """What the contract asks for, read back from ``formatted`` and the mask."""
    read = (formatted.withColumn("_turns", read_turns(F.col("formatted")))
            .withColumn("_loss", masked_text(F.col("segments"))))
    spoken = F.array_join(F.transform("_turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("messages").cast("long").alias("n_messages"))

"""Chat formatting of conversations with typed content parts.

A turn's content is a list of parts: text, image, audio or document.  A
visitor flattens it: text is escaped and written, any other part becomes a
placeholder with its number in the conversation (from 0) and its type, its
reference goes to the attachment list at that number, and the tokens it expands
to are counted.  Turns and parts are marked by control strings, all of which
begin with ``<|``; inside texts, roles and types a backslash is doubled and
``<|`` becomes ``<\\|``, so none of them holds a control string and each comes
back whole.  (Line feeds in roles and types are written as a backslash and n,
and the ``|`` of a type as a backslash and ``|``.)

    <|turn|>role, line feed, content, <|end|>, line feed
    <|part:number:type|>

``read_back`` gives turns with their whole content as text, ``read_parts`` turns
with their parts as they were: neighbouring texts come back as one, and empty
ones not at all.

The loss mask is a list of stretches of the formatted text, in code points:
the contents of the assistant's turns, still escaped.

Cases: null text: empty; null role: empty; null turn: first.  Equal turn
numbers are ordered by role, then text; repeated rows are repeated turns.
Null conv_id: one conversation.  A part of unknown type is a placeholder of
that type, of null type one of the empty type; a null part or list is left out.
Very long texts: a conversation is one row, and as long as its turns.  Empty
table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

START, END = "<|turn|>", "<|end|>\n"
LOSS_ROLE = "assistant"
#: Tokens that a placeholder stands for, if the part doesn't say.
EXPANDED = {"image": 576, "audio": 375, "document": 1024}
PART = "struct<type:string,text:string,ref:string,n_tokens:int>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("int").alias("n_tokens"))).cast(f"array<{PART}>")


def _visit(part: Column, text: Column, other: Column) -> Column:
    return F.when(part["type"] == "text", text).otherwise(other)


def _expanded(part: Column) -> Column:
    default = F.coalesce(*[F.when(part["type"] == k, F.lit(n)) for k, n in EXPANDED.items()], F.lit(1))
    return F.coalesce(part["n_tokens"], default)


def _inline(text: Column) -> Column:
    """Escaped, on one line and without a closing sign."""
    return F.replace(F.replace(F.replace(escaped(text), F.lit("<\\|"), F.lit("<|")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit("\\n"))


def _from_inline(text: Column) -> Column:
    # Back from "\n" to a line feed, but not where the backslash is itself escaped.
    return unescaped(F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def flattened(parts: Column) -> tuple[Column, Column]:
    """(content, attachments) of a list of parts: attachments in order, with type, ref and expanded tokens.
    Placeholders are numbered from 0; ``formatted`` counts on over a conversation."""
    parts = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    pieces = F.transform(parts, lambda p: _visit(p, F.struct(F.lit(False).alias("file"), escaped(p["text"]).alias("text")),
                                                 F.struct(F.lit(True).alias("file"), _inline(p["type"]).alias("text"))))
    files = F.transform(F.filter(parts, lambda p: ~F.coalesce(p["type"] == "text", F.lit(False))), lambda p: F.struct(
        p["type"].alias("type"), p["ref"].alias("ref"), _expanded(p).alias("n_tokens")))
    return pieces, files


def _written(pieces: Column, number: Column) -> Column:
    """The pieces of a turn whose first placeholder has this number."""
    step = lambda acc, p: F.struct(
        F.concat(acc["text"], F.when(p["file"], F.concat(F.lit("<|part:"), acc["n"].cast("string"), F.lit(":"), p["text"], F.lit("|>"))).otherwise(
            p["text"])).alias("text"), (acc["n"] + p["file"].cast("long")).alias("n"))
    return F.aggregate(pieces, F.struct(F.lit("").alias("text"), number.cast("long").alias("n")), step, lambda acc: acc["text"])


def formatted(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """conv_id, formatted, loss (start, length in code points), attachments (in order), expanded_tokens, per conversation.

    turns: conv_id, turn, role and a column of parts.  Offsets are running sums
    over a conversation's turns, in the same shuffle that gathers its text.
    """
    pieces, files = flattened(F.col(parts))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    t = turns.select("conv_id", "turn", role.alias("role"), pieces.alias("pieces"), files.alias("files"))
    # Equal turn numbers go by role, then by what they say.
    t = t.withColumn("said", F.array_join(F.transform("pieces", lambda p: F.concat(F.when(p["file"], F.lit("<|")).otherwise(F.lit("")), p["text"])), ""))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "said", F.to_json("files"))
    t = t.withColumn("n", F.row_number().over(order)).withColumn(
        "before", F.sum(F.size("files").cast("long")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.size("files"))
    t = t.withColumn("content", _written(F.col("pieces"), F.col("before")))
    head = F.concat(F.lit(START), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    t = t.withColumn("head", head).withColumn("size", F.length("content")).withColumn(
        "whole", F.length("head") + F.col("size") + len(END))
    t = t.withColumn(
        "start", F.sum(F.col("whole").cast("long")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size") - len(END))
    one = F.struct("n", "role", F.concat("head", "content", F.lit(END)).alias("piece"), "start", "size", "files")
    g = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("t"))
    loss = F.transform(F.filter("t", lambda x: x["role"] == LOSS_ROLE), lambda x: F.struct(
        x["start"].alias("start"), x["size"].cast("long").alias("length")))
    files = F.flatten(F.transform("t", lambda x: x["files"]))
    return g.select("conv_id", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"), loss.alias("loss"),
                    files.alias("attachments")).withColumn("expanded_tokens", F.aggregate(
                        "attachments", F.lit(0).cast("long"), lambda acc, x: acc + x["n_tokens"]))


def _turns(text: Column, content) -> Column:
    turns = F.split(text, "<\\|end\\|>\n")
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def turn(x: Column) -> Column:
        x = F.substring(x, F.lit(len(START) + 1), F.length(x))
        role = F.substring_index(x, "\n", 1)
        plain = F.regexp_replace(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"), r"\\([\s\S])", "$1")
        return F.struct(plain.alias("role"), content(F.substring(x, F.length(role) + 2, F.length(x))))
    return F.transform(turns, turn)


def read_back(text: Column) -> Column:
    """Turns (role, text) of a formatted text; placeholders stand in the text as they are written."""
    return _turns(text, lambda c: unescaped(c).alias("text"))


def read_parts(text: Column, attachments: Column) -> Column:
    """Turns (role, parts) of a formatted text and its attachments: parts as PART, in order."""
    def parts(content: Column) -> Column:
        # Behind each "<|part:" there is a number, a type, "|>" and the text up to the next one.
        cut = F.split(content, r"<\|part:")
        def part(x: Column, i: Column) -> Column:
            mark = F.regexp_extract(x, r"^([0-9]+:(?:[^|\\]|\\[\s\S])*)\|>", 1)
            number = F.substring_index(mark, ":", 1).cast("int")
            file = F.get(attachments, number)
            behind = F.when(i == 0, x).otherwise(F.substring(x, F.length(mark) + 3, F.length(x)))
            words = F.struct(F.lit("text").alias("type"), unescaped(behind).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("n_tokens"))
            kind = F.when(file["type"].isNotNull(), _from_inline(F.substring(mark, F.length(F.substring_index(mark, ":", 1)) + 2, F.length(mark))))
            held = F.struct(kind.alias("type"), F.lit(None).cast("string").alias("text"), file["ref"].alias("ref"), file["n_tokens"].alias("n_tokens"))
            return F.when(i == 0, F.array(words)).otherwise(F.array(held, words))
        return F.filter(F.flatten(F.transform(cut, part)), lambda p: ~F.coalesce((p["type"] == "text") & (p["text"] == ""), F.lit(False))).alias("parts")
    return _turns(text, parts)


def masked(text: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda x: unescaped(F.substring(text, (x["start"] + 1).cast("int"), x["length"].cast("int")))), "")


#: The conversation that the query adds: texts that look like control strings.
EXTRA_ID, EXTRA_TEXT = -7, "\\### Assistant: </turn> ok"


def op8_typed_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(EXTRA_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    made = formatted(rows.union(extra).withColumn("parts", text_parts(F.col("text"))))
    back = made.withColumn("turns", read_back(F.col("formatted"))).withColumn("masked", masked(F.col("formatted"), F.col("loss")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({EXTRA_ID}, 0, 'user', '{EXTRA_TEXT}'), ({EXTRA_ID}, 1, 'assistant', '{EXTRA_TEXT}')),
e AS (SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS escaped FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, escaped)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, escaped) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(escaped) + {len(START) + 1 + len(END)})::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

"""Conversations as training text with a loss mask, in Spark expressions only.

A conversation's rows are collected as structs and sorted by turn (then role and text, so ties have one order); rows
of the same role that follow each other are merged by an array aggregation, and the merged turns are concatenated:

    <s>[INST] role [/INST]text<sep>text</s><s>[INST] ...

Texts and roles are escaped so that none of the marks can occur in them: between the first character of a mark and the
rest of it (and any backslashes already there) goes one more backslash, `[INST]` becoming `[\\INST]` and `[\\INST]`
becoming `[\\\\INST]`.  All other text stays as it is, and taking one backslash out again gives back the original.

The mask is a list of spans (start from 1, length, both in code points): each text of an assistant row, without marks.

One conversation is one record, so its rows meet in one row of one task, as they must; nothing else is grouped.

Nulls and odd rows: null roles and texts are empty strings; null turns come first; rows without a conversation id are
one conversation; repeated rows are turns of their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, SEPARATOR, CLOSE = "<s>[INST] ", " [/INST]", "<sep>", "</s>"
_ESCAPE = r"([<\[])(\\*)(?=(?:/?s>|sep>|/?INST\]))"
_UNESCAPE = r"([<\[])\\(\\*)(?=(?:/?s>|sep>|/?INST\]))"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2")


def _merge(rows: Column) -> Column:
    """Sorted rows as (role, texts) runs."""
    start = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def step(done: Column, row: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(row["role"].alias("role"), F.array_append(last["texts"], row["text"]).alias("texts"))
        fresh = F.struct(row["role"].alias("role"), F.array(row["text"]).alias("texts"))
        grown = F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        return F.when(last["role"] == row["role"], grown).otherwise(F.array_append(done, fresh))

    return F.aggregate(rows, start, step)


def _render(turn: Column) -> Column:
    body = F.array_join(F.transform(turn["texts"], escape), SEPARATOR)
    return F.concat(F.lit(OPEN), escape(turn["role"]), F.lit(MIDDLE), body, F.lit(CLOSE))


def _spans(turns: Column) -> Column:
    """Spans of the texts of trained turns: every text knows its length, the fold adds them up."""
    pieces = F.flatten(
        F.transform(
            turns,
            lambda t: F.transform(
                t["texts"],
                lambda text, i: F.struct(
                    F.when(i == 0, F.char_length(F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE))))
                    .otherwise(F.lit(len(SEPARATOR)))
                    .alias("before"),
                    F.char_length(escape(text)).alias("length"),
                    F.when(i == F.size(t["texts"]) - 1, F.lit(len(CLOSE))).otherwise(F.lit(0)).alias("after"),
                    (t["role"] == TRAINED).alias("trained"),
                ),
            ),
        )
    )
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        span = F.struct((acc["at"] + p["before"]).alias("start"), p["length"].alias("length"))
        spans = F.when(p["trained"], F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((acc["at"] + p["before"] + p["length"] + p["after"]).alias("at"), spans.alias("spans"))

    return F.aggregate(pieces, start, step, lambda acc: acc["spans"])


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans."""
    row = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), row.alias("row"))
    merged = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    merged = merged.select("conv_id", _merge(F.col("rows")).alias("turns"))
    return merged.select(
        "conv_id",
        F.array_join(F.transform("turns", _render), "").alias("formatted"),
        _spans(F.col("turns")).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, rows (role, text of every original row, in order), loss_texts, from text and mask alone."""
    turns = F.slice(F.split("formatted", CLOSE), F.lit(1), F.size(F.split("formatted", CLOSE)) - 1)

    def rows(turn: Column) -> Column:
        role = unescape(F.substring_index(F.substr(turn, F.lit(len(OPEN) + 1)), MIDDLE, 1))
        body = F.substr(turn, F.char_length(F.substring_index(turn, MIDDLE, 1)) + len(MIDDLE) + 1)
        texts = F.split(body, SEPARATOR)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return formatted.select(
        "conv_id",
        "formatted",
        F.flatten(F.transform(turns, rows)).alias("rows"),
        F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"], s["length"]))).alias("loss_texts"),
    )

"""Chat formatting with Spark expressions only.

A conversation is cut into parts of consecutive turn numbers, so that a very long
one is spread over many tasks. In each part the turn structs are collected and
sorted, neighbours of one role are merged by an array aggregation, and the runs
are concatenated. What a part must know of its neighbours, the roles next to it,
comes from a table without texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END, SEP, LINE = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>", "<|nl|>"
#: Turn numbers in a part.
SPAN = 64
#: Part of the rows whose turn is null, before all others.
_FIRST = -(1 << 62)
_RUNS = "array<struct<role:string,texts:array<string>>>"


def escape(text: Column) -> Column:
    """``<|`` and any ``<\\..|`` get one more backslash, so that no control string is left; see ``unescape``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escaped_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def format_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    loss_role: str = "assistant", span: int = SPAN,
) -> DataFrame:
    """conv_id, part, n_parts, open_role, formatted, loss_spans: the formatted conversations, in parts.

    A conversation is the concatenation of ``formatted`` in the order of
    ``part``. Turns follow by turn (null first), then role, then text; a null
    role or text is empty and repeated rows stay. Adjacent turns of one role
    share one block, their texts set apart by ``SEP``, also across parts:
    ``open_role`` is the role whose block goes on from the part before, else
    null. ``loss_spans`` (start, length: code points within ``formatted``)
    covers each text of ``loss_role``, without marks and separators. A null
    conversation id is a conversation of its own; no rows give none. Only the
    four named columns are read. A part holds all rows of ``span`` turn
    numbers; rows that repeat a number stay together.
    """
    rows = turns.select(
        F.col(conv_col).alias("id"), F.coalesce(F.col(conv_col).cast("string"), F.lit("")).alias("key"), F.col(conv_col).isNull().alias("none"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("part", F.coalesce(F.floor(F.col("turn") / span), F.lit(_FIRST)))
    # keys without nulls: a null-safe join would shuffle the texts once more
    each = rows.groupBy("key", "none", "part").agg(
        F.max("id").alias("conv_id"),
        F.aggregate(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), F.lit(None).cast(_RUNS), _merge).alias("runs"))
    both = each.join(_neighbours(rows), ["key", "none", "part"], "left")
    open_role = F.when(F.col("before") == F.col("runs")[0]["role"], F.col("before"))
    going_on = F.coalesce(F.col("after") == F.element_at("runs", -1)["role"], F.lit(False))
    shaped = both.select(
        "conv_id", "part", F.coalesce("n_parts", F.lit(1)).cast("long").alias("n_parts"), open_role.alias("open_role"),
        _pieces(F.col("runs"), open_role, loss_role).alias("pieces"), F.when(going_on, "").otherwise(END).alias("tail"))
    return shaped.select(
        "conv_id", "part", "n_parts", "open_role",
        F.concat(F.array_join(F.transform("pieces", lambda x: F.concat(x["lead"], x["body"])), ""), "tail").alias("formatted"),
        _spans(F.col("pieces")).alias("loss_spans"))


def _merge(runs: Column, turn: Column) -> Column:
    """Add a turn to the last run if that has its role, else begin a run."""
    last = F.try_element_at(runs, F.lit(-1))
    own = F.array(turn["text"])
    longer = F.struct(turn["role"].alias("role"), F.concat(last["texts"], own).alias("texts"))
    fresh = F.array(F.struct(turn["role"].alias("role"), own.alias("texts")))
    return (
        F.when(runs.isNull(), fresh.cast(_RUNS))
        .when(last["role"] == turn["role"], F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(longer)).cast(_RUNS))
        .otherwise(F.concat(runs, fresh).cast(_RUNS)))


def _neighbours(rows: DataFrame) -> DataFrame:
    """key, none, part, n_parts, before, after: the roles next to each part, for conversations of several parts."""
    ends = rows.groupBy("key", "none", "part").agg(
        F.min(F.struct("turn", "role"))["role"].alias("first"), F.max(F.struct("turn", "role"))["role"].alias("last"))
    w = Window.partitionBy("key", "none")
    return ends.select(
        "key", "none", "part", F.count(F.lit(1)).over(w).alias("n_parts"),
        F.lag("last").over(w.orderBy("part")).alias("before"), F.lead("first").over(w.orderBy("part")).alias("after"),
    ).where("n_parts > 1")


def _pieces(runs: Column, open_role: Column, loss_role: str) -> Column:
    """One struct a text: the marks before it, the escaped text, and whether it is under the mask."""

    def of_run(run: Column, at: Column) -> Column:
        begin = F.concat(F.when(at > 0, END).otherwise(""), F.lit(START), _escaped_role(run["role"]), F.lit("\n"))
        head = F.when((at == 0) & open_role.isNotNull(), SEP).otherwise(begin)
        return F.transform(run["texts"], lambda t, i: F.struct(
            F.when(i > 0, SEP).otherwise(head).alias("lead"), escape(t).alias("body"), (run["role"] == loss_role).alias("loss")))

    return F.flatten(F.transform(runs, of_run))


def _spans(pieces: Column) -> Column:
    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["lead"])
        size = F.length(x["body"]).cast("long")
        one = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct((start + size).alias("at"), F.when(x["loss"], F.concat(acc["spans"], one)).otherwise(acc["spans"]).alias("spans"))

    kind = "struct<at:bigint,spans:array<struct<start:bigint,length:bigint>>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    return F.aggregate(pieces, start.cast(kind), lambda acc, x: step(acc, x).cast(kind), lambda acc: acc["spans"])


def read_turns(formatted: Column, open_role: Column) -> Column:
    """The turns (role, text) that a formatted part holds, in order: the inverse of ``format_turns``."""

    def of_block(block: Column, at: Column) -> Column:
        named = F.substring_index(block, "\n", 1)
        role = F.when(at == 0, open_role).otherwise(unescape(F.replace(named, F.lit(LINE), F.lit("\n"))))
        body = F.when(at == 0, F.substring(block, F.lit(len(SEP) + 1), F.length(block))).otherwise(
            F.substring(block, F.length(named) + 2, F.length(block)))
        texts = F.split(F.split(body, r"<\|im_end\|>\n")[0], r"<\|im_sep\|>")
        turns = F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))
        return F.when((at > 0) | (block != ""), turns).otherwise(F.array().cast("array<struct<role:string,text:string>>"))

    return F.flatten(F.transform(F.split(formatted, r"<\|im_start\|>"), of_block))


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    at = F.transform(loss_spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(at, "")


def digests(parts: DataFrame, chosen: str = "conv_id") -> DataFrame:
    """One row per conversation: counts and SHA-256 of the turns and of the masked text, as read back from ``formatted``.

    A digest needs all text of a conversation in one row. Those of one part are
    read where they are; only the parts of longer ones meet by conversation.
    """
    turns = read_turns(F.col("formatted"), F.col("open_role"))
    read = parts.select(
        F.col(chosen).alias("conv_id"), "part", "n_parts", turns.alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    ).select(
        "conv_id", "part", "n_parts", F.size("turns").cast("long").alias("n"), "loss", "chars",
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"))
    in_order = F.sort_array(F.collect_list(F.struct("part", "said", "loss")))
    long = read.where("n_parts > 1").groupBy("conv_id").agg(
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), in_order.alias("all")).select(
        "conv_id", "n", F.array_join("all.said", "").alias("said"), F.array_join("all.loss", "").alias("loss"), "chars")
    return read.where("n_parts = 1").select(*long.columns).union(long).select(
        "conv_id", F.col("n").alias("n_turns"), F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.col("chars").alias("formatted_chars"))

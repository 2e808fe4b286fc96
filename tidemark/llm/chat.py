"""Chat formatting over a prefix tree of conversations.

Conversations that begin with the same turns share those nodes of a tree. Sorting conversations by
their chained turn hashes is a depth-first walk of all trees: what a conversation shares with the
one before it is already emitted, the rest is new. So every shared turn is emitted once, with its
position ids (as if its conversation stood alone) and the stream intervals of its ancestors, which
are all it may attend to besides itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import stored

#: The control strings of the template `[INST]role[/INST]text</s>`.
OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
TURN = r"(?s)\[INST\](.*?)\[/INST\](.*?)</s>"


def escaped(text: Column) -> Column:
    """The text with backslashes doubled and one put inside every control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (OPEN, MIDDLE, CLOSE):
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def segments(turns: Column) -> Column:
    """Formatted turns with the span of the text that is learned: the assistant's words."""
    def one(t):
        head = F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(MIDDLE))
        body = escaped(t["text"])
        return F.struct(
            F.concat(head, body, F.lit(CLOSE)).alias("text"),
            F.char_length(head).alias("loss_from"),
            F.when(t["role"] == "assistant", F.char_length(body)).otherwise(0).alias("loss_chars"))

    return F.transform(turns, one)


def chained(texts: Column) -> Column:
    """Node ids along a conversation: each hashes its parent's id and its own formatted turn."""
    grown = F.aggregate(texts, F.array(F.lit("")), lambda ids, s: F.concat(
        ids, F.array(F.md5(F.concat(F.element_at(ids, -1), F.md5(s["text"]))))))
    return F.slice(grown, F.lit(2), F.size(texts))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + x)


def conversations_of(rows: DataFrame) -> DataFrame:
    """One row per conv_id with its formatted turns in order.

    Rows are ordered by turn, then role and text, nulls first; repeated rows are turns of their
    own. Null roles and texts are empty. Rows with a null conv_id are one conversation.
    """
    empty = F.lit("")
    turn = F.struct("turn", F.coalesce("role", empty).alias("role"),
                    F.coalesce("text", empty).alias("text"))
    return (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
            .select("conv_id", segments(F.col("turns")).alias("segments"))
            .withColumn("path", chained(F.col("segments"))))


def walked(rows: DataFrame) -> DataFrame:
    """Conversations in depth-first order with what they share and where their new turns begin.

    The order comes from a range-partitioned sort, so a third of all conversations may be equal
    or share a turn. Running sums are taken inside each range; ranges are then put in a row by a
    table of one line per range.
    """
    ordered = stored(conversations_of(rows).orderBy("path", "conv_id")
                     .withColumn("rank", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("range", F.shiftright("rank", 33))
    ends = ordered.groupBy("range").agg(F.max_by("path", "rank").alias("path"))
    before = ends.select("range", F.lag("path").over(Window.orderBy("range")).alias("ended"))
    lengths = F.transform("segments", lambda s: F.char_length(s["text"]).cast("long"))
    inside = Window.partitionBy("range").orderBy("rank")
    found = (ordered.withColumn("last", F.lag("path").over(inside)).join(before, "range")
             .withColumn("lengths", lengths)
             .withColumn("shared", F.size(F.array_intersect(
                 "path", F.coalesce("last", "ended", F.array().cast("array<string>")))))
             .drop("last", "ended"))
    new = F.slice("lengths", F.col("shared") + 1, F.size("lengths"))
    found = stored(found.withColumn("new_chars", total(new)))
    sums = found.groupBy("range").agg(F.sum("new_chars").alias("n"))
    begin = sums.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("at"))
    running = F.sum("new_chars").over(inside) - F.col("new_chars")
    return found.withColumn("offset", running).join(begin, "range").withColumn(
        "offset", F.col("offset") + F.col("at")).drop("at", "range")


def emitted(walk: DataFrame) -> DataFrame:
    """The stream: one row per node of the trees, in no order; `stream_from` gives the order.

    Columns: node_id, parent_id (null for a root), depth, stream_from, length, position_from (the
    position id of its first character; ids run on by one), text, loss_from, loss_chars.
    """
    nodes = walk.select("path", "shared", "offset", "lengths",
                        F.posexplode("segments").alias("depth", "s")).where("depth >= shared")
    before = F.slice("lengths", F.lit(1), F.col("depth"))
    shared = F.slice("lengths", F.lit(1), F.col("shared"))
    return nodes.select(
        F.element_at("path", F.col("depth") + 1).alias("node_id"),
        F.when(F.col("depth") > 0, F.get("path", F.col("depth") - 1)).alias("parent_id"), "depth",
        (F.col("offset") + total(before) - total(shared)).alias("stream_from"),
        F.element_at("lengths", F.col("depth") + 1).alias("length"),
        total(before).alias("position_from"), F.col("s.text").alias("text"),
        F.col("s.loss_from").alias("loss_from"), F.col("s.loss_chars").alias("loss_chars"))


def formatted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stream's nodes, each with its ancestors' intervals, and each conversation's nodes.

    `attends` lists the intervals [from, to) of the stream that a node sees, root first and its
    own last. The second table has conv_id, depth and node_id.
    """
    walk = stored(walked(rows))
    nodes = stored(emitted(walk))
    places = nodes.select("node_id", "stream_from", (F.col("stream_from") + F.col("length")).alias("to"))
    owners = walk.select("rank", "path", "shared", F.posexplode("path").alias("depth", "node_id"))
    spans = owners.where("shared < size(path)").select("rank", "depth", "node_id").join(
        places, "node_id").groupBy("rank").agg(F.sort_array(F.collect_list(F.struct(
            "depth", F.col("stream_from").alias("from"), "to"))).alias("spans"))
    seen = owners.where("depth >= shared").select("rank", "depth", "node_id").join(spans, "rank") \
        .select("node_id", F.transform(F.slice("spans", F.lit(1), F.col("depth") + 1),
                                       lambda s: F.struct(s["from"], s["to"])).alias("attends"))
    paths = walk.select("conv_id", F.posexplode("path").alias("depth", "node_id"))
    return nodes.join(seen, "node_id"), paths


def read_back(stream: DataFrame, paths: DataFrame) -> DataFrame:
    """conv_id, formatted, roles, texts, loss: conversations read from the emitted stream."""
    parts = paths.join(stream.select("node_id", "text", "loss_from", "loss_chars"), "node_id")
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "depth", "text", F.substring("text", F.col("loss_from") + 1, F.col("loss_chars"))
        .alias("loss")))).alias("parts"))
    text = F.concat_ws("", F.transform("parts", lambda p: p["text"]))
    return whole.select(
        "conv_id", text.alias("formatted"),
        F.concat_ws("", F.transform("parts", lambda p: unescaped(p["loss"]))).alias("loss")) \
        .withColumns({
            "roles": F.transform(F.regexp_extract_all("formatted", F.lit(TURN), F.lit(1)), unescaped),
            "texts": F.transform(F.regexp_extract_all("formatted", F.lit(TURN), F.lit(2)), unescaped)})


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation, from the stream: turns, their digest, learned text and its digest.

    An empty table gives an empty result; other columns are not read.
    """
    back = read_back(*formatted(rows))
    said = F.concat_ws("", F.transform(F.arrays_zip("roles", "texts"), lambda t: F.concat(
        t["roles"], F.lit("\n"), t["texts"], F.lit("\n"))))
    return back.select(
        "conv_id", F.size("texts").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))

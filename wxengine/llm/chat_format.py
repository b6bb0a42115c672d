"""Chat conversations as packed prefix trees with a loss mask.

Conversations that begin with the same turns share the nodes of those turns. A node is a
prefix of turns; its segment is the text of its last turn in the template. All conversations
with one first turn are one tree, packed depth first, each segment once. A segment has its
place in the packed text, its position (code points from the conversation's start), and the
stretches of the packed text that it attends to: those of its ancestors, neighbours put
together. Text under the loss mask is marked within the segment.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts
``&``, ``<``, ``[`` and, in roles, line feeds are written as character references, so that no
text can hold a control string of this or another common template; reading turns them back.

Scale. A prefix is known by running XORs of its turns' digests, each mixed with its place in
the conversation, so no conversation is put together to be compared. Copies of a conversation
are one path. A tree's segments are laid out in up to 256 parts by their second turn; sums
over parts join them, so a first turn that a third of all conversations share is not one
task. Texts stay with their nodes; ordering moves only numbers and digests. Reading back
streams over sorted turns.

Edge cases. Turns are in the order of ``turn``, then role, then text; equal rows are turns of
their own. A null text or role counts as empty, a null ``turn`` comes first. Rows without a
conversation id are one conversation. Only the named columns are looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wxengine.session import shared_dir

# The template's control strings, and the characters that texts may not hold.
START, END = "<|im_start|>", "<|im_end|>\n"
_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("\n", "&#10;"))
LEARNED_ROLES = ("assistant",)


def escaped(text: Column, role: bool = False) -> Column:
    for plain, reference in _ESCAPES if role else _ESCAPES[:-1]:
        text = F.replace(text, F.lit(plain), F.lit(reference))
    return text


def unescaped(text: str) -> str:
    for plain, reference in reversed(_ESCAPES):
        text = text.replace(reference, plain)
    return text


def _stored(frame: DataFrame, label: str) -> DataFrame:
    path = shared_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def number_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learned_roles: tuple[str, ...] = LEARNED_ROLES,
) -> DataFrame:
    """Turns with place, formatted segment, loss stretch, and their prefix's two hashes."""
    rows = conversations.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    placed = rows.withColumn("at", F.row_number().over(order))
    opening = F.concat(F.lit(START), escaped(F.col("role"), role=True), F.lit("\n"))
    body = escaped(F.col("text"))
    placed = placed.select(
        "conv",
        "at",
        F.concat(opening, body, F.lit(END)).alias("segment"),
        F.when(
            F.col("role").isin(*learned_roles),
            F.struct(
                F.char_length(opening).alias("start"),
                (F.char_length(opening) + F.char_length(body)).alias("end"),
            ),
        ).alias("loss"),
        F.sha2(F.concat_ws("\n", F.col("at"), opening, body), 256).alias("digest"),
    )
    so_far = Window.partitionBy("conv").orderBy("at")
    halves = [F.conv(F.substring("digest", a, 15), 16, 10).cast("bigint") for a in (1, 17)]
    return placed.select(
        "conv",
        "at",
        "segment",
        "loss",
        F.char_length("segment").cast("bigint").alias("length"),
        *(F.bit_xor(h).over(so_far).alias(n) for h, n in zip(halves, ("h1", "h2"), strict=True)),
    ).withColumn("node", F.format_string("%015x%015x", "h1", "h2")).drop("h1", "h2")


def pack(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The packed trees, one row per node, and the nodes of each conversation's turns.

    Nodes: tree, node, parent, depth, segment, loss, start and end in the tree's packed text,
    position, attends (array of start and end).
    """
    turns = _stored(turns, "chat-turns")
    path_of = Window.partitionBy("conv").orderBy("at")
    links = turns.select(
        "conv",
        "at",
        "length",
        "node",
        F.lag("node").over(path_of).alias("parent"),
        F.first("node").over(path_of).alias("tree"),
        F.nth_value("node", 2).over(path_of.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("second"),
        F.last("node").over(path_of.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("leaf"),
        (F.sum("length").over(path_of) - F.col("length")).alias("position"),
    )
    links = _stored(links, "chat-links")
    # One conversation stands for all its copies.
    chosen = links.where("at = 1").groupBy("leaf").agg(F.min_by("conv", F.struct("conv")).alias("conv"))
    paths = links.join(chosen.select(F.col("conv").alias("_conv"), F.col("leaf").alias("_leaf")), (F.col("leaf") == F.col("_leaf")) & F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv", "_leaf")
    paths = paths.withColumn("part", F.coalesce(F.substring("second", 1, 2), F.lit("")))
    # Paths in the order of their nodes visit a tree depth first. Only the nodes that several
    # paths share, and the first that is a path's own, can tell two paths apart.
    shared = paths.groupBy("node").agg(F.count("*").alias("n"))
    marked = paths.join(shared, "node")
    told = marked.where(F.col("n") > 1).select("leaf", "tree", "part", "at", "node").unionByName(
        marked.where(F.col("n") == 1)
        .groupBy("leaf", "tree", "part")
        .agg(F.min("at").alias("at"), F.min_by("node", "at").alias("node"))
        .select("leaf", "tree", "part", "at", "node")
    )
    keys = told.groupBy("leaf", "tree", "part").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "node"))), lambda x: x["node"]).alias("key")
    )
    rank = F.row_number().over(Window.partitionBy("tree", "part").orderBy("key", "leaf"))
    ranks = keys.select("leaf", F.struct("part", rank.alias("rank")).alias("place"))
    nodes = (
        paths.join(ranks, "leaf")
        .groupBy("tree", "node", "at", "parent", "length", "position")
        .agg(F.min("place").alias("place"))
        .select("tree", "node", "at", "parent", "length", "position", "place.part", "place.rank")
    )
    in_part = Window.partitionBy("tree", "part").orderBy("rank", "at")
    local = F.sum("length").over(in_part) - F.col("length")
    nodes = nodes.withColumn("local", local)
    parts = nodes.groupBy("tree", "part").agg(F.sum("length").alias("size"))
    before = F.sum("size").over(Window.partitionBy("tree").orderBy("part")) - F.col("size")
    parts = parts.select("tree", "part", before.alias("before"))
    placed = nodes.join(parts, ["tree", "part"]).select(
        "tree",
        "node",
        "parent",
        F.col("at").alias("depth"),
        (F.col("before") + F.col("local")).alias("start"),
        (F.col("before") + F.col("local") + F.col("length")).alias("end"),
        "position",
    )
    placed = _stored(placed, "chat-nodes")
    # Along a path, a new stretch begins where a node does not follow its parent directly.
    along = paths.select("leaf", "at", "node").join(placed.select("node", "start", "end"), "node")
    path = Window.partitionBy("leaf").orderBy("at")
    gap = F.lag("end").over(path)
    along = along.select(
        "leaf",
        "at",
        "node",
        "start",
        gap.alias("upto"),
        F.when(gap.isNull() | (gap != F.col("start")), F.struct(F.col("start").alias("s"), gap.alias("e"))).alias("new"),
    )
    runs = along.withColumn("runs", F.collect_list("new").over(path))
    stretches = F.transform(
        F.col("runs"),
        lambda r, i: F.struct(
            r["s"].alias("start"),
            F.coalesce(F.try_element_at("runs", (i + 2).cast("int"))["e"], F.col("upto")).alias("end"),
        ),
    )
    # The node's own stretch, when it begins one, is not an ancestor's.
    attends = F.filter(stretches, lambda s: (s["start"] < F.col("start")) & s["end"].isNotNull() & (s["end"] > s["start"]))
    attended = runs.groupBy("node").agg(F.first(attends).alias("attends"))
    segments = turns.groupBy("node").agg(F.first("segment").alias("segment"), F.first("loss").alias("loss"))
    trees = placed.join(segments, "node").join(attended, "node")
    return trees, links.select("conv", "at", "node")


_READ = "conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_back(trees: DataFrame, members: DataFrame) -> DataFrame:
    """Per conversation: turns, loss text and length, read from the packed segments."""
    kind = members.schema["conv"].dataType.simpleString()
    rows = members.join(trees.select("node", "segment", "loss"), "node")
    rows = rows.select(F.coalesce(F.xxhash64("conv"), F.lit(0)).alias("_key"), "conv", "at", "segment", "loss")
    dealt = rows.repartition("_key").sortWithinPartitions("_key", "conv", "at")
    arrow_kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [arrow_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        done: list[tuple] = []
        turns = loss = None
        counts = [0, 0, 0]

        def finish() -> None:
            if current is not None:
                n, learned, chars = counts
                done.append((current[0], n, turns.hexdigest(), learned, loss.hexdigest(), chars))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv", "segment", "loss"))
            for conv, segment, mask in zip(*columns, strict=True):
                if current != (conv,):
                    finish()
                    current, counts = (conv,), [0, 0, 0]
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                role, _, body = segment[len(START) : -len(END)].partition("\n")
                turns.update(f"{unescaped(role)}\n{unescaped(body)}\n".encode())
                counts[0] += 1
                counts[2] += len(segment)
                if mask is not None:
                    learned = unescaped(segment[mask["start"] : mask["end"]])
                    loss.update(learned.encode())
                    counts[1] += len(learned)
            if done:
                yield _batch(done, names, types)
                done = []
        finish()
        if done:
            yield _batch(done, names, types)

    return dealt.mapInArrow(read, _READ.format(kind=kind))


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names
    )

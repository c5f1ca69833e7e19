"""Chat formatting over a prefix tree of conversations.

Conversations that begin with the same turns share those turns' nodes. The forest of nodes is laid
out depth-first and each node's tokens are emitted once, with

* ``position``: the position id of its first token, counted along its own conversation,
* ``offset``: its place in the layout of its tree, and
* ``attends``: the intervals of the layout that hold its ancestors, the only tokens besides its own
  that it attends to.

Depth-first order is the order of the conversations' paths: a conversation emits the nodes that no
earlier conversation has. So a tree is never gathered: conversations are range-partitioned by path,
nodes are grouped by digest, and offsets are sums over slices. A first turn that a third of all
conversations share is one node, and its subtree is spread over as many tasks as its size needs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidestrata.llm.common import stored

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
#: monotonically_increasing_id() is the partition's number above this many bits of place.
PLACE_BITS = 33
ROOT = b""


def escaped(text: str) -> str:
    """``text`` without control strings: ``<|`` and the escape sign itself are marked."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def restored(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def escaped_role(role: str) -> str:
    """A role on one line; a line break becomes the escape sign and ``n``."""
    return escaped(role).replace("\n", "\\n")


def restored_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.DOTALL)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """What a turn is written as: opening, text, closing. The text alone can be under the loss."""
    return f"{START}{escaped_role(role)}\n", escaped(text), f"{END}\n"


def parsed_turn(head: str, body: str) -> tuple[str, str]:
    """Role and text read back from a turn's opening and text."""
    return restored_role(head.removeprefix(START).removesuffix("\n")), restored(body)


def node_digest(parent: bytes, role: str, text: str) -> bytes:
    """A node's identity: its parent's and its turn. Fixed in size, whatever the depth."""
    digest = hashlib.blake2b(parent, digest_size=16)
    for part in (role.encode(), text.encode()):
        digest.update(len(part).to_bytes(8, "little") + part)
    return digest.digest()


def with_paths(turns: DataFrame, vocabulary: str) -> DataFrame:
    """(conv_id, path, nodes) of every conversation; a node has its digest and its turn's tokens."""
    from tidestrata.llm.packing import BytePairEncoder

    ordered = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            )
        ).alias("turns")
    )
    node = pa.struct(
        [("node", pa.binary()), ("head", pa.list_(pa.int32())), ("body", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32())), ("loss", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BytePairEncoder(vocabulary)
        known: dict[str, list[int]] = {}

        def ids(text):
            if len(text) > 100:
                return encoder.encode(text).tolist()
            if text not in known:
                if len(known) > 10_000:
                    known.clear()
                known[text] = encoder.encode(text).tolist()
            return known[text]

        for batch in batches:
            paths, nodes = [], []
            for turns in batch.column(1):
                above, path, own = ROOT, [], []
                for turn in turns.as_py():
                    role, text = turn["role"], turn["text"]
                    digest = node_digest(above, role, text)
                    head, body, tail = map(ids, turn_parts(role, text))
                    own.append({"node": digest, "head": head, "body": body, "tail": tail, "loss": role == TRAINED})
                    path.append(digest)
                    above = digest
                paths.append(path)
                nodes.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(paths, pa.list_(pa.binary())), pa.array(nodes, pa.list_(node))],
                ["conv_id", "path", "nodes"],
            )

    kind = ordered.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(
        run,
        f"conv_id {kind}, path array<binary>, nodes array<struct<node: binary, "
        "head: array<int>, body: array<int>, tail: array<int>, loss: boolean>>",
    )


def prefix_tree(turns: DataFrame, vocabulary: str) -> tuple[DataFrame, DataFrame]:
    """(segments, leaves) of ``turns`` (conv_id, turn, role, text).

    A segment is a node's tokens: tree, offset, length, position, depth, ids, loss_start, loss_stop
    (places in the segment, equal if no loss) and attends, the merged intervals (start, stop) of the
    tree's layout that its ancestors take. A leaf says where a conversation ends: conv_id, tree,
    offset of its last turn's segment, and attends, which with that segment is the whole conversation.

    Turns go by turn, then role and text where a turn is repeated. Null roles and texts count as
    empty. Rows of a null conv_id are one conversation. Equal conversations share every segment. No
    rows give no segments and no leaves; other columns are not read. A conversation is the unit of
    work, like a document's text, and must fit a task.
    """
    shape = stored(with_paths(turns, vocabulary), "conversations")
    width = lambda n: F.size(n["head"]) + F.size(n["body"]) + F.size(n["tail"])

    # One row per distinct path, in the order of paths.
    distinct = shape.select("path", F.transform("nodes", width).alias("widths")).dropDuplicates(["path"])
    ranked = distinct.repartitionByRange("path").sortWithinPartitions("path")
    ranked = stored(ranked.withColumn("rank", F.monotonically_increasing_id()), "paths")
    steps = ranked.select("rank", F.posexplode("path").alias("depth", "node"), "widths").select(
        "rank", "depth", "node", F.element_at("widths", F.col("depth") + 1).alias("length")
    )
    owners = steps.groupBy("node").agg(
        F.min("rank").alias("rank"), F.first("depth").alias("depth"), F.first("length").alias("length")
    )
    emitted = owners.groupBy("rank").agg(F.sum("length").alias("length"), F.count(F.lit(1)).alias("own"))
    starts = _running_starts(ranked.select("rank").join(emitted.drop("own"), "rank", "left"))

    # What an owner emits is one stretch, so a node follows the owner's nodes above it.
    above = Window.partitionBy("rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = owners.withColumn("before", F.coalesce(F.sum("length").over(above), F.lit(0))).join(
        starts, "rank"
    ).select("node", "depth", "length", (F.col("start") + F.col("before")).alias("place"))
    placed = stored(placed, "nodes")

    # Each conversation's nodes with their places; roots give the tree and where its layout begins.
    paths = (
        steps.select("rank", "depth", "node")
        .join(placed.drop("depth"), "node")
        .groupBy("rank")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "place", "length"))).alias("route"))
    )
    route = ranked.select("rank", "path").join(paths, "rank").join(emitted.select("rank", "own"), "rank", "left")
    route = stored(route, "routes")

    # A conversation's own nodes are the last of its path.
    base = F.col("route")[0]["place"]

    def segment(depth):
        above, here = F.slice("route", F.lit(1), depth), F.get("route", depth)
        return F.struct(
            F.get("path", depth).alias("node"),
            F.lower(F.hex(F.get("path", F.lit(0)))).alias("tree"),
            (here["place"] - base).alias("offset"),
            here["length"].cast("bigint").alias("length"),
            F.aggregate(above, F.lit(0).cast("bigint"), lambda s, r: s + r["length"]).alias("position"),
            depth.alias("depth"),
            _merged(above, base).alias("attends"),
        )

    own = F.sequence(F.size("path") - F.col("own").cast("int"), F.size("path") - 1)
    owned = route.where(F.col("own") > 0).select(F.explode(F.transform(own, segment)).alias("s")).select("s.*")
    tokens = shape.select(F.explode("nodes").alias("n")).select("n.*").dropDuplicates(["node"])
    segments = owned.join(tokens, "node").select(
        "tree",
        "offset",
        "length",
        "position",
        "depth",
        F.concat("head", "body", "tail").alias("ids"),
        F.size("head").alias("loss_start"),
        (F.size("head") + F.when(F.col("loss"), F.size("body")).otherwise(0)).alias("loss_stop"),
        F.size("body").alias("body_length"),
        "attends",
    )
    last = F.element_at("route", -1)
    leaves = shape.select("conv_id", "path").join(route.select("path", "route"), "path").select(
        "conv_id",
        F.lower(F.hex(F.element_at("path", 1))).alias("tree"),
        (last["place"] - base).alias("offset"),
        F.transform("route", lambda r: r["place"] - base).alias("offsets"),
        _merged(F.slice("route", F.lit(1), F.size("route") - 1), base).alias("attends"),
    )
    return segments, leaves


def _running_starts(emitted: DataFrame) -> DataFrame:
    """(rank, start): the tokens emitted by all earlier ranks, from sums per slice of ranks."""
    lengths = emitted.select("rank", F.coalesce("length", F.lit(0)).cast("bigint").alias("length"))
    lengths = lengths.withColumn("slice", F.shiftright("rank", PLACE_BITS))
    within = Window.partitionBy("slice").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, as many as the range partitions.
    slices = lengths.groupBy("slice").agg(F.sum("length").alias("length"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("slice", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("base"))
    return lengths.withColumn("inside", F.coalesce(F.sum("length").over(within), F.lit(0))).join(
        slices, "slice"
    ).select("rank", (F.col("base") + F.col("inside")).alias("start"))


def _merged(route: Column, base: Column) -> Column:
    """Intervals (start, stop) of a route's nodes; neighbours that touch are one."""
    span = lambda r: F.struct((r["place"] - base).alias("start"), (r["place"] - base + r["length"]).alias("stop"))
    empty = F.array().cast("array<struct<start: bigint, stop: bigint>>")

    def add(done, r):
        here = span(r)
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] == here["start"])
        grown = F.concat(
            F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
            F.array(F.struct(F.try_element_at(done, F.lit(-1))["start"].alias("start"), here["stop"].alias("stop"))),
        )
        return F.when(touches, grown).otherwise(F.concat(done, F.array(here)))

    return F.aggregate(route, empty, add)


def conversations(segments: DataFrame, leaves: DataFrame, vocabulary: str) -> DataFrame:
    """Conversations read back: conv_id and turns (role, text, formatted characters, loss text).

    A conversation's segments are those of its leaf's route. Tokens are decoded and the template is
    parsed; ``loss`` is the unescaped text under the loss mask, null where a turn has none.
    """
    from tidestrata.llm.packing import BytePairEncoder

    steps = leaves.select("conv_id", "tree", F.posexplode("offsets").alias("number", "offset"))
    pieces = steps.join(
        segments.select("tree", "offset", "ids", "loss_start", "loss_stop", "body_length"), ["tree", "offset"]
    )
    whole = pieces.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct("number", "ids", "loss_start", "loss_stop", "body_length"))
        ).alias("pieces")
    )
    turn = pa.struct([("role", pa.string()), ("text", pa.string()), ("chars", pa.int64()), ("loss", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BytePairEncoder(vocabulary)
        text_of = encoder.decode
        for batch in batches:
            read = []
            for pieces in batch.column(1):
                turns = []
                for p in pieces.as_py():
                    ids, start, size = p["ids"], p["loss_start"], p["body_length"]
                    head, body, tail = text_of(ids[:start]), text_of(ids[start : start + size]), text_of(ids[start + size :])
                    role, text = parsed_turn(head, body)
                    under = ids[start : p["loss_stop"]]
                    loss = restored(text_of(under)) if role == TRAINED else None
                    turns.append({"role": role, "text": text, "chars": len(head + body + tail), "loss": loss})
                read.append(turns)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(read, pa.list_(turn))], ["conv_id", "turns"])

    kind = whole.schema["conv_id"].dataType.simpleString()
    return whole.mapInArrow(
        run, f"conv_id {kind}, turns array<struct<role: string, text: string, chars: bigint, loss: string>>"
    )

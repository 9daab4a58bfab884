"""The trie of conversation prefixes: which conversations begin with the same turns, and what sharing them would save.

Conversations are sorted by their sequences of turns. Two neighbours share a prefix of a certain length: an edge
between them. Taking the edges in descending depth, a union-find over the sorted list joins neighbouring components,
and every join at a new depth is a branching node of the trie. Unary chains between branching nodes are filled in at
the end, from the turns of one member.

The sorted list is split over the tasks. A task joins all that cannot be touched from outside: an edge stays open if
one of its sides reaches the end of the task's part, or meets a deeper open edge. What stays open are the strict
minima seen from either end, at most two per depth, however many conversations a task holds. These contracted
forests are put together, some tasks' at a time, the edges at the boundaries added, and the same union-find goes on
until one forest is left. Rows with equal sequences are neighbours, so a group of copies of any size is spread over
tasks by the conversation's id and only its counts come together.

Turns are told apart by the MD5 hash of role and text, prefixes by a 128-bit hash. Turns go by ``turn``, null first;
equal turns go by that hash. Null roles and texts count as empty, rows without a conversation id are left out. The
remainders of negative ids have their sign, as in SQL. A conversation is one row of 16 bytes a turn, however long its texts are; texts are read once and do not move. Repeated
rows are turns of their own. An empty table gives an empty result, without a root. Other columns are not looked at
and may have any names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.llm import common
from creditflow.session import stage

# Conversations that take their first turns from one of them, and one more than the most turns taken.
FAMILY = 5
MOST_TAKEN = 9
TURN_BYTES = 16
# Conversations of a task, forests that are put together at a time, bytes of ids in a row.
PER_TASK = 1 << 14
FAN = 32
CHUNK_BYTES = 1 << 16

NODE, PART, ENDS = 0, 1, 2
FIELDS = (
    "kind int, task long, at int, hash binary, parent_hash binary, depth long, parent_depth long, conv_id long, n_convs long, "
    "n_children long, n_leaves long, below long, weight long, edge long, edge_weight long, edge_hash binary, seq binary, sums binary, ids binary"
)
NAMES = [f.strip().split()[0] for f in FIELDS.split(",")]
SCHEMA = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[k]) for n, k in (f.strip().split() for f in FIELDS.split(","))])


# --- conversations ------------------------------------------------------------


def turn_key() -> Column:
    """MD5 of role and text, the role's length keeping them apart."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def text_bytes() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of each conversation in order, as (hash, bytes of text)."""
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), turn_key().alias("key"), text_bytes().alias("bytes"))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), place.alias("t"))
    found = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return found.select("conv_id", F.transform("t", lambda t: F.struct(t["key"].alias("key"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(originals: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the first of its family, as many as its id's hash says."""
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_TAKEN
    wanted = originals.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first"), taken.cast("int").alias("h"))
    heads = originals.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("first"), F.slice("turns", 1, MOST_TAKEN - 1).alias("head"))
    joined = wanted.join(heads, "first", "left")
    own = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    head = F.expr("slice(coalesce(head, cast(array() AS array<struct<key: binary, bytes: bigint>>)), 1, h)")
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def sequences(rows: DataFrame) -> DataFrame:
    """``conv_id, seq, sums``: hashes of the turns one after the other, bytes of text in the first 0, 1, 2, ... turns."""
    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.binary()), ("sums", pa.list_(pa.int64()))])

    def run(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column(1)
            ends, flat = turns.offsets.to_pylist(), turns.values
            keys, sizes = b"".join(flat.field("key").to_pylist()), flat.field("bytes").to_numpy(zero_copy_only=False)
            parts = list(zip(ends[:-1], ends[1:], strict=True))
            seqs = pa.array([keys[x * TURN_BYTES : y * TURN_BYTES] for x, y in parts], pa.binary())
            sums = pa.array([np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes[x:y], dtype=np.int64))) for x, y in parts], schema.field("sums").type)
            yield pa.RecordBatch.from_arrays([batch.column(0), seqs, sums], schema=schema)

    return rows.select("conv_id", "turns").mapInArrow(run, "conv_id long, seq binary, sums array<long>")


# --- forests --------------------------------------------------------------------


@dataclass
class Part:
    """A component of the sorted list. Its top node is open; everything below is complete.

    ``below`` is what the nodes under the top save, ``weight`` the bytes of the first ``depth`` turns.
    """

    depth: int
    hash: bytes
    weight: int
    conv_id: int
    n_convs: int
    n_children: int = 0
    child_leaves: int = 0
    below: int = 0

    def leaves(self) -> int:
        return self.child_leaves if self.n_children else 1


@dataclass
class Edge:
    """What two neighbours share: so many turns, their bytes, the hash of that prefix."""

    depth: int
    weight: int
    hash: bytes


def prefix_hash(seq: bytes, depth: int) -> bytes:
    return xxhash.xxh3_128_digest(seq[: depth * TURN_BYTES])


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN_BYTES
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return int(differ[0]) // TURN_BYTES


def raised(part: Part, edge: Edge, closed: list[tuple[Part, Edge]]) -> Part:
    """The part with its top at the edge's depth; a deeper top is complete and becomes a child."""
    if part.depth == edge.depth:
        return part
    closed.append((part, edge))
    saved = part.below + (part.n_convs - 1) * (part.weight - edge.weight)
    return Part(edge.depth, edge.hash, edge.weight, part.conv_id, part.n_convs, 1, part.leaves(), saved)


def joined(a: Part, b: Part) -> Part:
    """Two parts with tops at the same depth have the same top."""
    return replace(
        a,
        conv_id=min(a.conv_id, b.conv_id),
        n_convs=a.n_convs + b.n_convs,
        n_children=a.n_children + b.n_children,
        child_leaves=a.child_leaves + b.child_leaves,
        below=a.below + b.below,
    )


def contract(parts: list[Part], edges: list[Edge], whole: bool) -> tuple[list[Part], list[Edge], list[tuple[Part, Edge]]]:
    """Join neighbours by descending depth; ``edges[i]`` lies between ``parts[i]`` and ``parts[i + 1]``.

    Returns what stays open, and the nodes that are complete, with the edge whose prefix is their parent. Unless the
    list is the whole one, its ends are open: ``held[i]`` is the depth that a part must not be joined below, because an
    open edge of that depth (for an end part: any depth) comes first.
    """
    n = len(parts)
    left, right = list(range(n)), list(range(n))  # at a component's first or last place: its other end
    top = list(parts)  # at a component's first place
    held = [-1] * n
    if not whole:
        held[0] = held[-1] = math.inf
    is_open = [False] * max(n - 1, 0)
    closed: list[tuple[Part, Edge]] = []
    for i in sorted(range(n - 1), key=lambda i: -edges[i].depth):
        edge, a, b = edges[i], left[i], i + 1
        if held[a] > edge.depth or held[b] > edge.depth:
            is_open[i] = True
            held[a], held[b] = max(held[a], edge.depth), max(held[b], edge.depth)
            continue
        top[a] = joined(raised(top[a], edge, closed), raised(top[b], edge, closed))
        held[a] = max(held[a], held[b])
        end = right[b]
        right[a], left[end] = end, a
    firsts = [i for i in range(n) if i == 0 or is_open[i - 1]]
    return [top[i] for i in firsts], [edges[i] for i in range(n - 1) if is_open[i]], closed


def to_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], SCHEMA.field(n).type) for n in NAMES], schema=SCHEMA)


def node_rows(closed: list[tuple[Part, Edge]]) -> list[dict]:
    return [
        {
            "kind": NODE, "hash": p.hash, "parent_hash": e.hash, "depth": p.depth, "parent_depth": e.depth, "conv_id": p.conv_id, "n_convs": p.n_convs,
            "n_children": p.n_children, "n_leaves": p.leaves(), "below": p.below, "weight": p.weight,
        }
        for p, e in closed
    ]


def part_rows(task: int, parts: list[Part], edges: list[Edge], first: tuple[bytes, list[int]], last: tuple[bytes, list[int]]) -> list[dict]:
    """The open parts in order, each with the edge to the next; the ends carry their sequences."""
    rows = []
    for at, p in enumerate(parts):
        row = {
            "kind": PART, "task": task, "at": at, "hash": p.hash, "depth": p.depth, "conv_id": p.conv_id, "n_convs": p.n_convs,
            "n_children": p.n_children, "n_leaves": p.child_leaves, "below": p.below, "weight": p.weight,
        }
        if at < len(edges):
            row |= {"edge": edges[at].depth, "edge_weight": edges[at].weight, "edge_hash": edges[at].hash}
        rows.append(row)
    # the first sequence is only compared with, of the last one the bytes are needed too
    rows[0]["seq"] = first[0]
    rows.append({"kind": PART, "task": task, "at": len(parts), "seq": last[0], "sums": np.array(last[1], dtype="<i8").tobytes()})
    return rows


def local_forests(rows: DataFrame) -> DataFrame:
    """One contracted forest per task over its part of the sorted list, complete nodes, and the ids that end at a prefix."""

    def run(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        parts: list[Part] = []
        edges: list[Edge] = []
        first, last, sums = None, None, []
        end_hash, ids, ids_from, ids_size = b"", [], 0, 0

        def ends() -> dict:
            return {"kind": ENDS, "hash": end_hash, "conv_id": ids_from, "ids": ",".join(ids).encode()}

        for batch in batches:
            out = []
            for conv_id, seq, its_sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last is not None and seq == last[0]:
                    parts[-1].n_convs += 1
                    parts[-1].conv_id = min(parts[-1].conv_id, conv_id)
                else:
                    if last is not None:
                        depth = shared_turns(last[0], seq)
                        edges.append(Edge(depth, sums[depth], prefix_hash(seq, depth)))
                    sums, depth = its_sums, len(seq) // TURN_BYTES
                    parts.append(Part(depth, prefix_hash(seq, depth), sums[depth], conv_id, 1))
                    last = (seq, sums)
                    first = first or last
                if ids and (parts[-1].hash != end_hash or ids_size > CHUNK_BYTES):
                    out.append(ends())
                    ids, ids_size = [], 0
                if not ids:
                    end_hash, ids_from = parts[-1].hash, conv_id
                ids.append(str(conv_id))
                ids_size += len(ids[-1]) + 1
            yield to_batch(out)
        if ids:
            yield to_batch([ends()])
        if parts:
            left, between, closed = contract(parts, edges, whole=False)
            yield to_batch(node_rows(closed) + part_rows(task, left, between, first, last))

    return rows.mapInArrow(run, FIELDS)


def merged_forests(parts: DataFrame, whole: bool) -> DataFrame:
    """The forests of ``FAN`` neighbouring tasks as one; the ``whole`` one has no open ends and gets the root."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["task"], r["at"]))
        parts, edges = [], []
        first, last = None, None
        for r in rows:
            if r["depth"] is None:
                last = (r["seq"], np.frombuffer(r["sums"], dtype="<i8").tolist())
                continue
            if r["seq"] is not None:
                first = first or (r["seq"], [])
                if last is not None:
                    depth = shared_turns(last[0], r["seq"])
                    edges.append(Edge(depth, last[1][depth], prefix_hash(r["seq"], depth)))
            parts.append(Part(r["depth"], r["hash"], r["weight"], r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["below"]))
            if r["edge"] is not None:
                edges.append(Edge(r["edge"], r["edge_weight"], r["edge_hash"]))
        left, between, closed = contract(parts, edges, whole)
        if not whole:
            return pa.Table.from_batches([to_batch(node_rows(closed) + part_rows(rows[0]["task"] // FAN, left, between, first, last))])
        root = Edge(0, 0, prefix_hash(b"", 0))
        top = raised(left[0], root, closed)
        above = Edge(-1, 0, b"")
        return pa.Table.from_batches([to_batch(node_rows([*closed, (top, above)]))])

    fan = 1 << 62 if whole else FAN
    return parts.groupBy(F.floor(F.col("task") / fan).alias("together")).applyInArrow(run, FIELDS)


def end_hashes(chunks: DataFrame) -> DataFrame:
    """``hash, ends_sha256`` of the ids that end at a prefix, from chunks of them in order; a chunk at a time is in memory."""
    schema = pa.schema([("hash", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            found = []
            for key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != current:
                    if current is not None:
                        found.append((current, digest.hexdigest()))
                    current, digest = key, hashlib.sha256(ids)
                else:
                    digest.update(b"," + ids)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.binary()), pa.array([d for _, d in found], pa.string())], schema=schema)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([digest.hexdigest()], pa.string())], schema=schema)

    ordered = chunks.select("hash", "conv_id", "ids").repartition("hash").sortWithinPartitions("hash", "conv_id")
    return ordered.mapInArrow(run, "hash binary, ends_sha256 string")


# --- the trie --------------------------------------------------------------------


def branching_nodes(rows: DataFrame, per_task: int = PER_TASK) -> tuple[DataFrame, DataFrame]:
    """The nodes where something branches or ends, and the chunks of ids that end at a prefix."""
    tasks = max(1, math.ceil(rows.count() / per_task))
    ordered = rows.repartitionByRange(tasks, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    found = stage(local_forests(ordered), "prefix-forest")
    chunks = found.where(F.col("kind") == ENDS)
    nodes = found.where(F.col("kind") == NODE)
    open_parts = found.where(F.col("kind") == PART)
    tasks = open_parts.agg(F.max("task")).first()[0]
    while tasks is not None:
        whole = tasks < FAN
        found = stage(merged_forests(open_parts, whole), "prefix-forest")
        nodes = nodes.unionByName(found.where(F.col("kind") == NODE))
        open_parts, tasks = found.where(F.col("kind") == PART), None if whole else tasks // FAN
    return nodes.select("hash", "parent_hash", "depth", "parent_depth", "conv_id", "n_convs", "n_children", "n_leaves", "below"), chunks


def with_chains(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """All depths between a node and its parent, by the texts of the node's smallest member; ``above`` is the parent's member."""
    members = rows.select(F.col("conv_id").alias("member"), "sums")
    saved = "below + (n_convs - 1) * (get(sums, cast(depth AS int)) - get(sums, cast(greatest(at - 1, 0) AS int)))"
    chain = F.expr(f"explode(transform(sequence(parent_depth + 1, depth), at -> struct(at, {saved} AS saved)))").alias("c")
    spread = nodes.join(members, F.col("conv_id") == F.col("member")).select(*nodes.columns, chain)
    at = F.col("c.at")
    is_last = at == F.col("depth")
    return spread.select(
        "conv_id",
        at.alias("depth"),
        F.when(at == F.col("parent_depth") + 1, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(is_last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        F.col("c.saved").alias("saved_tokens"),
        F.when(is_last, F.col("ends_sha256")).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame, per_task: int = PER_TASK) -> DataFrame:
    """One row per prefix of a rebuilt conversation, see the module; ``saved_tokens`` counts bytes of text."""
    rows = stage(sequences(rebuilt(stage(conversations(turns), "conversations"))), "rebuilt")
    found, chunks = branching_nodes(rows, per_task)
    nodes = stage(found, "prefix-nodes")
    # staged, so that adaptive execution may split the children of one parent
    members = stage(nodes.select(F.col("hash").alias("parent_hash"), F.col("depth").alias("parent_depth"), F.col("conv_id").alias("above")), "prefix-parents")
    ends = stage(end_hashes(chunks), "prefix-ends")
    placed = nodes.join(members, ["parent_hash", "parent_depth"], "left").join(ends, "hash", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return with_chains(placed, rows).na.fill({"ends_sha256": nothing})

"""Conversation prefix trie: vertical bitmaps in shards, merged by prefix.

Conversations are rebuilt while they stream through a task in (base, id, turn) order, so that
only the first turns of the present base are held. A shard is a range of ids with at most ``SHARD`` conversations.

In a shard, postings map (position, turn) to a bitset of conversations. From the root's bitset, depth first, the
turn of a node's lowest open member names a posting; parent bitset AND posting is a child, and what is left goes
on until only the conversations that end at the node remain. Popcounts are the member counts. A conversation
of more than ``LONG`` turns is a shard of its own, whose one-bit bitsets are written turn by turn without being held.

A node is named by a 128-bit digest of its path, so shards are merged by one aggregation per node: counts add up, the
smallest member is the minimum. Each shard node carries the names of its ancestors at distance 1, 2, 4, ...;
sums over subtrees then need one aggregation and one join on unique names for each doubling: what lies within
2^(k+1) of a node is what lies within 2^k of it and of its descendants at distance 2^k.
The list of conversations that end at a node exists in pieces, one a shard, in id order; SHA-256
takes its bytes in order, so the pieces of one list stream through one task, a batch at a time.

Defined cases: rows without conv_id belong to no conversation and are left out. Turns with equal numbers
(repeated rows too) follow each other by role and text. Null roles and texts are empty ones. For
negative ids the base is the next multiple of five below. A conversation whose base is missing and whose
own turns all fall within its first h has no turns and ends at the root. Without conversations there is no
node. Very long conversations and texts are streamed; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import stage, table

FAMILY = 5
TURNS = 9
SHARD = 4_096
LONG = 50_000
# Turns of one shard; a shard also ends when it has more.
SHARD_TURNS = 200_000
_ROOT = hashlib.blake2b(b"root", digest_size=16).digest()
_NODE = "node binary, parent binary, depth int, conv_id long, n long, bytes long, jumps array<binary>, ends string"
_NAMES = [x.split()[0] for x in _NODE.split(", ")]
_KINDS = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.string()]

Turn = tuple[bytes, int]  # digest of role and text, bytes of text


def head_turns(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % TURNS


def turn_of(role: str | None, text: str | None) -> Turn:
    role_, text_ = (role or "").encode(), (text or "").encode()
    return hashlib.blake2b(len(role_).to_bytes(8, "big") + role_ + text_, digest_size=16).digest(), len(text_)


def rebuilt(rows: Iterator[tuple[int, int, Turn]]) -> Iterator[tuple[int, Iterator[Turn]]]:
    """(conversation, its rebuilt turns) from (base, conversation, turn) in that order; holds the base's first turns only.

    The turns of a conversation must be used up before the next one is asked for.
    """
    row = next(rows, None)
    base, head = None, []
    while row is not None:
        if row[0] != base:
            base, head = row[0], []
        conv, h = row[1], head_turns(row[1])
        found, own = conv == base, [0]

        def turns(conv: int = conv, h: int = h, found: bool = found, own: list = own) -> Iterator[Turn]:
            nonlocal row
            if not found:
                yield from head[:h]
            while row is not None and row[1] == conv:
                turn = row[2]
                if found and len(head) < TURNS:
                    head.append(turn)
                if found or own[0] >= h:
                    yield turn
                own[0] += 1
                row = next(rows, None)

        yield conv, turns()


def _path(parent: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(parent + turn, digest_size=16).digest()


class Jumps:
    """Names of the nodes from the root to the present one, and of those at distance 1, 2, 4, ... from it."""

    def __init__(self) -> None:
        self.path: list[bytes] = []

    def enter(self, depth: int, node: bytes) -> list[bytes]:
        del self.path[depth:]
        out, step = [], 1
        while step <= depth:
            out.append(self.path[depth - step])
            step *= 2
        self.path.append(node)
        return out


def long_nodes(conv: int, turns: Iterator[Turn]) -> Iterator[tuple]:
    """The nodes of one conversation, turn by turn; the path's names are all that is held."""
    path, node, depth, size = Jumps(), _ROOT, 0, 0
    parent = None
    for turn in turns:
        yield node, parent, depth, conv, 1, size, path.enter(depth, node), None
        parent, node, depth, size = node, _path(node, turn[0]), depth + 1, turn[1]
    yield node, parent, depth, conv, 1, size, path.enter(depth, node), str(conv)


def shard_nodes(convs: list[tuple[int, list[Turn]]]) -> Iterator[tuple]:
    """The nodes of a shard's conversations (ascending ids), depth first, by intersecting bitsets."""
    if not convs:
        return
    postings: dict[tuple[int, bytes], int] = {}
    for i, (_, turns) in enumerate(convs):
        for d, (name, _) in enumerate(turns):
            at = (d, name)
            postings[at] = postings.get(at, 0) | 1 << i
    path = Jumps()
    open_: list[tuple[bytes, bytes | None, int, int, int]] = [(_ROOT, None, 0, (1 << len(convs)) - 1, 0)]
    while open_:
        node, parent, depth, members, size = open_.pop()
        jumps, left, ends = path.enter(depth, node), members, []
        children = []
        while left:
            low = (left & -left).bit_length() - 1
            turns = convs[low][1]
            if len(turns) == depth:
                ends.append(str(convs[low][0]))
                left &= left - 1
                continue
            child = members & postings[depth, turns[depth][0]]
            children.append((_path(node, turns[depth][0]), node, depth + 1, child, turns[depth][1]))
            left &= ~child
        first = convs[(members & -members).bit_length() - 1][0]
        yield node, parent, depth, first, members.bit_count(), size, jumps, ",".join(ends) if ends else None
        open_.extend(reversed(children))


def _shards(rows: Iterator[tuple[int, int, Turn]]) -> Iterator[tuple]:
    convs, n = [], 0
    for conv, turns in rebuilt(rows):
        held: list[Turn] = []
        for turn in turns:
            held.append(turn)
            if len(held) > LONG:
                break
        if len(held) > LONG:
            yield from shard_nodes(convs)
            convs, n = [], 0
            yield from long_nodes(conv, _chain(held, turns))
            continue
        convs.append((conv, held))
        n += len(held)
        if len(convs) >= SHARD or n >= SHARD_TURNS:
            yield from shard_nodes(convs)
            convs, n = [], 0
    yield from shard_nodes(convs)


def _chain(held: list[Turn], turns: Iterator[Turn]) -> Iterator[Turn]:
    yield from held
    yield from turns


def _batches(nodes: Iterator[tuple], rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _KINDS, strict=True)], _NAMES)
    for node in nodes:
        held.append(node)
        if len(held) == rows:
            yield pack()
            held = []
    if held:
        yield pack()


def _local_nodes(conversations: DataFrame) -> DataFrame:
    """The nodes of every shard, staged."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (base, conv, turn_of(role, text))
            for b in batches
            for base, conv, role, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)
        )
        return _batches(_shards(rows))

    conv = F.col("conv_id").cast("long")
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.filter(conv.isNotNull()).select((conv - F.pmod(conv, F.lit(FAMILY))).alias("base"), conv.alias("conv_id"), "turn", empty("role"), empty("text"))
    # Ranges of bases, so that a family stays together and shards follow each other by id.
    rows = rows.repartitionByRange("base").sortWithinPartitions("base", "conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return stage(rows.select("base", "conv_id", "role", "text").mapInArrow(index, _NODE), "trie_shards")


def _end_digests(local: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for b in batches:
            names, values = [], []
            for node, ends in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if node == last:
                    state.update(b"," + ends.encode())
                    continue
                if last is not None:
                    names.append(last)
                    values.append(state.hexdigest())
                last, state = node, hashlib.sha256(ends.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(values, pa.string())], ["node", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    pieces = local.filter("ends IS NOT NULL").repartition("node").sortWithinPartitions("node", "conv_id")
    return pieces.select("node", "ends").mapInArrow(hashed, "node binary, ends_sha256 string")


def _with_parents(nodes: DataFrame, total: int) -> DataFrame:
    """``parent_conv_id`` for every node but the root.

    Parents with very many children, of which there are at most 5,000 by counting, are
    broadcast; the others have few rows each and are joined.
    """
    own = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children").filter("n_children > 0")
    many = F.col("n_children") >= max(200, total // 5_000)
    large = F.broadcast(own.filter(many).drop("n_children"))
    small = own.filter(~many).select("parent", F.col("parent_conv_id").alias("small_id"))
    half = nodes.join(large, "parent", "left")
    found = half.filter("parent_conv_id IS NOT NULL OR parent IS NULL")
    rest = half.filter("parent_conv_id IS NULL AND parent IS NOT NULL").drop("parent_conv_id").join(small, "parent").withColumnRenamed("small_id", "parent_conv_id")
    return found.unionByName(rest)


def _sum(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    local = _local_nodes(conversations)
    merged = local.groupBy("node").agg(
        F.any_value("parent").alias("parent"), F.any_value("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"),
        F.any_value("bytes").alias("bytes"), F.any_value("jumps").alias("jumps"),
    )
    merged = stage(merged, "trie_merged")
    children = merged.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = merged.join(children, "node", "left").withColumn("n_children", _sum("n_children")).join(_end_digests(local), "node", "left")
    nodes = stage(
        nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes")).drop("bytes"),
        "trie_nodes",
    )
    total, rounds = nodes.agg(F.count(F.lit(1)), F.max(F.size("jumps"))).first()
    sums = nodes.select("node", "n_leaves", "saved_tokens")
    ancestors = nodes.select("node", "jumps")
    for k in range(rounds or 0):
        given = sums.join(ancestors.filter(F.size("jumps") > k).select("node", F.col("jumps")[k].alias("to")), "node")
        given = given.groupBy(F.col("to").alias("node")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        sums = sums.join(given, "node", "left").select("node", (F.col("n_leaves") + _sum("l")).alias("n_leaves"), (F.col("saved_tokens") + _sum("s")).alias("saved_tokens"))
        sums = stage(sums, "trie_sums")
    found = nodes.drop("n_leaves", "saved_tokens", "jumps").join(sums, "node")
    return _with_parents(found, total).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


# CRC-32 (reflected polynomial 0xEDB88320) over the decimal digits, by a table of 256 steps.
OP12_SQL = """
WITH t AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b:
    CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS steps),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (SELECT conv_id, conv_id - (conv_id % 5 + 5) % 5 AS base, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda s, b: xor(steps[(xor(s, b) & 255) + 1], s >> 8))) % 9 AS h FROM (SELECT DISTINCT conv_id FROM o), t),
r AS (SELECT c.conv_id, i, role, text FROM c JOIN o ON o.conv_id = c.base AND o.i <= c.h
    UNION ALL SELECT c.conv_id, i, role, text FROM c JOIN o USING (conv_id) WHERE i > h),
w AS MATERIALIZED (SELECT conv_id, row_number() OVER p AS depth, text, list({'r': role, 't': text}) OVER p AS path FROM r WINDOW p AS (PARTITION BY conv_id ORDER BY i)),
m AS MATERIALIZED (SELECT conv_id, 0 AS depth, '' AS text, md5('') AS node, NULL AS parent FROM c
    UNION ALL SELECT conv_id, depth, text, md5(path::VARCHAR || depth), CASE WHEN depth = 1 THEN md5('') ELSE md5(path[:-2]::VARCHAR || (depth - 1)) END FROM w),
l AS (SELECT conv_id, max(depth) AS depth FROM m GROUP BY conv_id),
n AS MATERIALIZED (SELECT node, any_value(parent) AS parent, any_value(m.depth) AS depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, any_value(strlen(text)) AS bytes,
    sha256(coalesce(string_agg(CASE WHEN l.depth = m.depth THEN m.conv_id::VARCHAR END, ',' ORDER BY m.conv_id), '')) AS ends_sha256
    FROM m JOIN l USING (conv_id) GROUP BY node),
k AS MATERIALIZED (SELECT n.*, p.conv_id AS parent_conv_id, coalesce(q.n_children, 0) AS n_children FROM n LEFT JOIN n p ON p.node = n.parent
    LEFT JOIN (SELECT parent AS node, count(*) AS n_children FROM n GROUP BY parent) q ON q.node = n.node),
s AS (SELECT a.node, sum((k.n_children = 0)::BIGINT) AS n_leaves, sum((k.n_convs - 1) * k.bytes) AS saved_tokens
    FROM (SELECT DISTINCT a.node, b.node AS below FROM m a JOIN m b ON a.conv_id = b.conv_id AND a.depth <= b.depth) a JOIN k ON k.node = a.below GROUP BY a.node)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256 FROM k JOIN s USING (node)
"""

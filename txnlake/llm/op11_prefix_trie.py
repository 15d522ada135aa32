"""Prefix trie of conversations, built from sorted neighbours.

A conversation is the sequence of its turns' digests. Sorted by these, the
conversations of a trie node are neighbours, and a node is known by the number
of turns that neighbours share (LCP). A block of sorted conversations starts as
one component each; the edges between neighbours are taken in descending depth,
and each merge of two components (union-find) makes the node at that depth a
branching one and completes all nodes below it that belong to one side only.

What a block or a task cannot complete are the nodes along its first and its last
conversation, which may go on in a neighbour. A task's forest is contracted to
these, and the forests are merged across their boundaries in the same way,
FAN at a time, in as many rounds as it takes. So no task sees more than a part of
the rows, whichever conversation, first turn or node most rows share.

Completed nodes wait for their parent's smallest member. Where the parent is one
that goes on, they are written with the number of its slot, and the rounds' links
from slot to slot are followed back at the end. Members that end at a node are
hashed where the node is completed, or written as runs of ids in order, and these
are hashed one after another.

Defined results: turns without a conversation id belong to none. Turns with the
same number are taken in the order of their digests, so repeated rows are turns
of their own. Null roles and texts count as empty. A turn's text is hashed where
it is read, however long, and never moved. A conversation is one row of 28 bytes
a turn. Remainders are those of SQL, also below zero. An empty table gives no
rows. Columns other than conv_id, turn, role and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import map_arrow, stored

#: Conversations in every GROUP ids begin like the first of them, with up to HEADS - 1 turns.
GROUP, HEADS = 5, 9
#: Bytes of a turn's digest: half a SHA-256.
DIGEST = 16
#: Sorted conversations that are made a forest at a time, and bytes of their paths.
BLOCK, BLOCK_BYTES = 4096, 1 << 24
#: Forests that are merged in one task.
FAN = 128

RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")



def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, path (the digests of its turns, one after another) and sizes (bytes of their texts).

    Only digests are shuffled, once, by the id that a group of GROUP ids begins with.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(
        "conv_id",
        "turn",
        F.unhex(F.substring(digest, 1, 2 * DIGEST)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    groups = (
        turns.filter("conv_id is not null")
        .select(base.alias("base"), turn.alias("turn"))
        .groupBy("base")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # nulls first
    )
    each = groups.select("base", "turns", F.explode(F.array_distinct("turns.conv_id")).alias("conv_id"))
    each = each.select(
        "conv_id",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int").alias("h"),
        F.expr("filter(turns, t -> t.conv_id = base)").alias("first"),
        F.expr("filter(turns, t -> t.conv_id = conv_id)").alias("own"),
    )
    whole = F.expr("concat(slice(first, 1, h), slice(own, h + 1, greatest(size(own) - h, 0)))")
    return each.select("conv_id", whole.alias("turns")).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns.digest", F.hex), "")).alias("path"),
        F.col("turns.size").alias("sizes"),
    )


@dataclass(slots=True)
class Node:
    """What is known of a node so far; of its children, the completed ones are in the figures."""

    digest: bytes = b""
    size: int = 0
    n: int = 0
    least: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: list[int] = field(default_factory=list)
    key: str | None = None  # names the runs of ends that are written already
    waiting: list[tuple] = field(default_factory=list)
    slots: list[int] = field(default_factory=list)  # of the round before
    slot: int | None = None  # of this round

    def take(self, n: int, least: int | None, leaves: int, saved: int) -> None:
        self.n += n
        self.leaves += leaves
        self.saved += saved
        if least is not None and (self.least is None or least < self.least):
            self.least = least


@dataclass(slots=True)
class Forest:
    """The nodes that may go on: along both ends (trunk), and further along the first or last conversation."""

    trunk: list[Node]
    left: list[Node]
    right: list[Node]

    def chains(self) -> list[tuple[list[Node], int]]:
        """Each path from the root, and the depth from which on its nodes are its own."""
        return [(self.trunk, 0), (self.trunk + self.left, len(self.trunk)), (self.trunk + self.right, len(self.trunk))]


#: The rows that a round writes. node: completed; wait: completed, its parent is in a slot;
#: open: goes on; link: what became of a slot; run: ids that end at a node.
_COLUMNS = {
    "kind": pa.string(),
    "conv_id": pa.int64(),
    "depth": pa.int64(),
    "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(),
    "ends_sha256": pa.string(),
    "ends_key": pa.string(),
    "slot": pa.int64(),
    "to_slot": pa.int64(),
    "old": pa.bool_(),  # slot is one of the round before
    "block": pa.int64(),
    "side": pa.int32(),
    "digest": pa.binary(),
    "size": pa.int64(),
    "ids": pa.string(),
}
_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean", pa.binary(): "binary"}
_SCHEMA = ", ".join(f"{name} {_TYPES[kind]}" for name, kind in _COLUMNS.items())
_COMPLETED = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "ends_key")


class Writer:
    """Collects a task's rows, and numbers its slots."""

    def __init__(self, block: int):
        self.block, self.n_slots = block, 0
        self.rows: dict[str, list] = {name: [] for name in _COLUMNS}

    def put(self, **values) -> None:
        for name, column in self.rows.items():
            column.append(values.get(name))

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.rows["kind"]:
            arrays = [pa.array(self.rows[name], kind) for name, kind in _COLUMNS.items()]
            self.rows = {name: [] for name in _COLUMNS}
            yield pa.RecordBatch.from_arrays(arrays, names=list(_COLUMNS))

    def slot_of(self, node: Node) -> int:
        if node.slot is None:
            node.slot = (self.block << 32) + self.n_slots
            self.n_slots += 1
        return node.slot

    def run(self, node: Node) -> None:
        """The ids that end at the node and are not written yet."""
        if node.ends:
            self.put(kind="run", ends_key=node.key, conv_id=node.ends[0], ids=",".join(map(str, node.ends)))
            node.ends = []

    def complete(self, node: Node, depth: int, parent: Node | None) -> None:
        """Nothing more will come below the node."""
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.n - 1) * node.size
        ends = hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest() if node.key is None else None
        if node.key is not None:
            self.run(node)
        row = (node.least, depth, node.n, node.children, leaves, saved, ends, node.key)
        for child in node.waiting:
            self.put(kind="node", parent_conv_id=node.least, **dict(zip(_COMPLETED, child, strict=True)))
        for slot in node.slots:
            self.put(kind="link", slot=slot, old=True, conv_id=node.least)
        if node.slot is not None:
            self.put(kind="link", slot=node.slot, old=False, conv_id=node.least)
        if parent is None:
            self.put(kind="node", **dict(zip(_COMPLETED, row, strict=True)))
        else:
            parent.waiting.append(row)
            parent.children += 1
            parent.take(node.n, node.least, leaves, saved)

    def relieve(self, forest: Forest) -> None:
        """Write what a forest's open nodes hold besides their figures."""
        for chain, since in forest.chains():
            path = hashlib.sha256()
            named = any(node.ends for node in chain[since:])
            for depth, node in enumerate(chain):
                if named:
                    path.update(node.digest)
                if depth < since:
                    continue
                if node.ends:
                    node.key = node.key or path.hexdigest()
                    self.run(node)
                for child in node.waiting:
                    self.put(kind="wait", slot=self.slot_of(node), **dict(zip(_COMPLETED, child, strict=True)))
                node.waiting = []

    def leave_open(self, forest: Forest) -> None:
        """The forest's nodes as rows for the next round."""
        self.relieve(forest)
        for side, (chain, since) in enumerate(forest.chains()):
            for depth, node in enumerate(chain[since:], since):
                self.put(
                    kind="open", block=self.block, side=side, depth=depth, slot=self.slot_of(node),
                    digest=node.digest, size=node.size, n_convs=node.n, conv_id=node.least,
                    n_children=node.children, n_leaves=node.leaves, saved_tokens=node.saved, ends_key=node.key,
                )
                for slot in node.slots:
                    self.put(kind="link", slot=slot, old=True, to_slot=node.slot)

    def complete_all(self, forest: Forest) -> None:
        for chain, since in reversed(forest.chains()):
            for depth in range(len(chain) - 1, since - 1, -1):
                self.complete(chain[depth], depth, chain[depth - 1] if depth else None)


def united(one: Node, other: Node) -> Node:
    """The same node, seen from both sides of a boundary."""
    one.take(other.n, other.least, other.leaves, other.saved)
    one.children += other.children
    one.ends += other.ends
    one.key = one.key or other.key
    one.waiting += other.waiting
    one.slots += other.slots
    one.slot = other.slot if one.slot is None else one.slot
    return one


def merged(x: Forest, y: Forest, lcp: int, out: Writer) -> Forest:
    """Two neighbouring forests whose facing conversations share `lcp` turns.

    Nodes below the LCP are completed, but for those that are open on the far side.
    """
    last, first = x.trunk + x.right, y.trunk + y.left
    of_x, of_y = len(x.trunk) - 1, len(y.trunk) - 1
    for chain, trunk in ((last, of_x), (first, of_y)):
        for depth in range(len(chain) - 1, max(lcp, trunk), -1):
            out.complete(chain[depth], depth, chain[depth - 1])
    both = [united(a, b) for a, b in zip(last[: lcp + 1], first[: lcp + 1], strict=True)]
    for depth in range(lcp, max(of_x, of_y), -1):
        out.complete(both[depth], depth, both[depth - 1])
    trunk = min(of_x, of_y, lcp) + 1
    return Forest(
        both[:trunk],
        both[trunk : min(lcp, of_x) + 1] + x.trunk[lcp + 1 :] + x.left,
        both[trunk : min(lcp, of_y) + 1] + y.trunk[lcp + 1 :] + y.right,
    )


def one_forest(forests: list[Forest], lcps: list[int], out: Writer) -> Forest:
    """Union-find over the edges between neighbours, in descending depth."""
    component = list(range(len(forests)))

    def find(i: int) -> int:
        while component[i] != i:
            component[i] = component[component[i]]
            i = component[i]
        return i

    for i in sorted(range(len(lcps)), key=lcps.__getitem__, reverse=True):
        a, b = find(i), find(i + 1)
        forests[a] = merged(forests[a], forests[b], lcps[i], out)
        component[b] = a
    return forests[find(0)]


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with alike."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // DIGEST
    low, high = 0, most // DIGEST  # the shared ones are at least low, and fewer than high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * DIGEST : middle * DIGEST] == b[low * DIGEST : middle * DIGEST]:
            low = middle
        else:
            high = middle
    return low


def _chain(path: bytes, sizes: list[int], ids: list[int]) -> Forest:
    """The forest of one conversation, and those equal to it."""
    nodes = [Node()]
    nodes += [Node(path[d * DIGEST : (d + 1) * DIGEST], size) for d, size in enumerate(sizes)]
    nodes[-1].n, nodes[-1].least, nodes[-1].ends = len(ids), min(ids), ids
    return Forest(nodes, [], [])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, list[int], list[int]]]]:
    """Different paths with sizes and ids, in portions."""
    block: list[tuple[bytes, list[int], list[int]]] = []
    rows = volume = 0
    for batch in batches:
        for conv_id, path, sizes in zip(*(batch.column(k) for k in range(3)), strict=True):
            if rows >= BLOCK or volume >= BLOCK_BYTES:
                yield block
                block, rows, volume = [], 0, 0
            path, conv_id = path.as_py(), conv_id.as_py()
            rows += 1
            if block and block[-1][0] == path:
                block[-1][2].append(conv_id)
            else:
                block.append((path, sizes.as_py(), [conv_id]))
                volume += len(path)
    if block:
        yield block


def _sorted_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sorted conversations as one forest."""
    out = Writer(TaskContext.get().partitionId())
    forest, last = None, b""
    for block in _blocks(batches):
        paths = [path for path, _, _ in block]
        lcps = [_shared(a, b) for a, b in zip(paths[:-1], paths[1:], strict=True)]
        here = one_forest([_chain(*x) for x in block], lcps, out)
        forest = here if forest is None else merged(forest, here, _shared(last, paths[0]), out)
        last = paths[-1]
        out.relieve(forest)
        yield from out.batches()
    if forest is not None:
        out.leave_open(forest)
        yield from out.batches()


def _read(rows: Iterable[dict]) -> Forest:
    sides: tuple[list[Node], ...] = ([], [], [])
    for r in rows:
        node = Node(r["digest"], r["size"], r["n_convs"], r["conv_id"], r["n_children"], r["n_leaves"], r["saved_tokens"])
        node.key, node.slots = r["ends_key"], [r["slot"]]
        sides[r["side"]].append(node)
    return Forest(*sides)


def _facing(x: Forest, y: Forest) -> int:
    """Turns that the last conversation of one forest and the first of the next begin with alike."""
    shared = 0
    for a, b in zip((x.trunk + x.right)[1:], (y.trunk + y.left)[1:], strict=False):
        if a.digest != b.digest:
            break
        shared += 1
    return shared


def _boundaries(final: bool):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        for group, of_group in groupby(rows, key=lambda r: r["block"] // FAN):
            out = Writer(group)
            forests = [_read(of_block) for _, of_block in groupby(of_group, key=lambda r: r["block"])]
            lcps = [_facing(a, b) for a, b in zip(forests[:-1], forests[1:], strict=True)]
            forest = one_forest(forests, lcps, out)
            if final:
                out.complete_all(forest)
            else:
                out.leave_open(forest)
            yield from out.batches()

    return merge


def _hashed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids, from its runs in order."""
    key, digest = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["ends_key", "hashed"])

    for batch in batches:
        for of_key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if of_key == key:
                digest.update(b"," + ids.encode())
                continue
            if key is not None:
                yield done()
            key, digest = of_key, hashlib.sha256(ids.encode())
    if key is not None:
        yield done()


def _rounds(conversations: DataFrame) -> list[DataFrame]:
    """What each round writes: first the tasks over sorted conversations, then merges of FAN forests each."""
    order = ["path", "conv_id"]
    ordered = conversations.repartitionByRange(*order).sortWithinPartitions(*order)
    rounds = [stored(map_arrow(ordered.select("conv_id", "path", "sizes"), _sorted_conversations, _SCHEMA), "trie")]
    while True:
        left = rounds[-1].filter("kind = 'open'")
        most = left.agg(F.max("block")).first()[0]
        if most is None:
            return rounds
        in_order = left.repartition(F.expr(f"block div {FAN}")).sortWithinPartitions("block", "side", "depth")
        rounds.append(stored(map_arrow(in_order, _boundaries(most < FAN), _SCHEMA), "trie"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """RESULT: a row per node of the trie of all rebuilt conversations."""
    rounds = _rounds(rebuilt(turns))
    nodes = rounds[0].filter("kind = 'node'").select(*RESULT, "ends_key")
    resolved = None
    for k in range(len(rounds) - 1, -1, -1):
        links = rounds[k].filter("kind = 'link' and not old").select("slot", "conv_id")
        if resolved is not None:
            old = rounds[k + 1].filter("kind = 'link' and old")
            further = old.filter("to_slot is not null").select("slot", F.col("to_slot").alias("next"))
            upper = resolved.select(F.col("slot").alias("next"), "conv_id")
            links = (
                links.unionByName(old.filter("to_slot is null").select("slot", "conv_id"))
                .unionByName(further.join(upper, "next").select("slot", "conv_id"))
            )
        resolved = stored(links, "trie-slots")
        parents = resolved.select("slot", F.col("conv_id").alias("parent"))
        late = rounds[k].filter("kind = 'wait'").drop("parent_conv_id").join(parents, "slot")
        nodes = nodes.unionByName(late.withColumnRenamed("parent", "parent_conv_id").select(*RESULT, "ends_key"))
        if k:
            nodes = nodes.unionByName(rounds[k].filter("kind = 'node'").select(*RESULT, "ends_key"))
    runs = rounds[0].filter("kind = 'run'").select("ends_key", "ids", "conv_id")
    runs = runs.repartition("ends_key").sortWithinPartitions("ends_key", "conv_id").select("ends_key", "ids")
    hashed = map_arrow(runs, _hashed_runs, "ends_key string, hashed string")
    late = nodes.filter("ends_key is not null").join(hashed, "ends_key").withColumn("ends_sha256", F.col("hashed"))
    return nodes.filter("ends_key is null").select(*RESULT).unionByName(late.select(*RESULT))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


ORACLE_SQL = f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (SELECT DISTINCT conv_id FROM turns
), crc AS (
  -- The table of CRC-32, from its polynomial.
  SELECT range AS i, range AS c, 0 AS bit FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, bit + 1 FROM crc WHERE bit < 8
), entries AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE bit = 8
), heads AS (
  SELECT conv_id, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) % {HEADS} AS h
  FROM ids, entries
), rebuilt AS (
  SELECT h.conv_id, place, role, text FROM heads h JOIN turns t
    ON t.conv_id = h.conv_id - h.conv_id % {GROUP} AND place <= h
  UNION ALL
  SELECT h.conv_id, place, role, text FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND place > h
), chained AS (
  SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS size,
         string_agg(sha256(strlen(role)::VARCHAR || ':' || role || text), '') OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
), prefixes AS (
  SELECT conv_id, depth, size, sha256(path) AS path FROM chained
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), members AS (
  SELECT *, min(conv_id) OVER (PARTITION BY depth, path) AS node,
         max(depth) OVER (PARTITION BY conv_id) = depth AS is_end FROM prefixes
), nodes AS (
  SELECT node, depth, count(*) AS n, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends
  FROM members GROUP BY node, depth
), parents AS (
  SELECT n.*, m.node AS parent FROM nodes n LEFT JOIN members m ON m.conv_id = n.node AND m.depth = n.depth - 1
), children AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM parents GROUP BY ALL
), below AS (
  SELECT m.node, m.depth, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves, sum((n.n - 1) * n.size) AS saved
  FROM nodes n LEFT JOIN children c USING (node, depth) JOIN members m ON m.conv_id = n.node AND m.depth <= n.depth
  GROUP BY m.node, m.depth
)
SELECT p.node AS conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n AS n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM parents p LEFT JOIN children c USING (node, depth) JOIN below b USING (node, depth)
"""

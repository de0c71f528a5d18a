"""Prefix trie of conversations: the rebuilt turn sequences of all conversations, one row per distinct prefix.

Splitter-skeleton: the paths (16 bytes of SHA-256 per turn) are dealt to sorted shards by
splitters chosen from a weighted sample.  A node with members in two shards is a prefix of
a splitter between them, so the trie of the splitter paths (the skeleton, broadcast) holds
all such nodes.  Each shard reads its paths in order and finishes every other node with a
stack; for skeleton nodes it emits partial aggregates, which Spark reduces.

A conversation's turns are ordered by turn (null first), equal turns by the hash of role and
text.  A null role or text is empty.  Rows without a conv_id belong to no conversation.
Every other conv_id c is rebuilt: the first h turns of conversation c - c % 100, then its own
turns after its first h, where h is crc32(decimal c) % 6.  A conversation without turns left
is a member of the root.  No conversations: no nodes.  Other columns are not looked at.

Bounds: texts never move, only 20 bytes per turn; a conversation's path is one value.  The
skeleton has at most ``SKELETON_NODES`` nodes and its splitters ``SPLITTER_BYTES``; beyond
that there are fewer and larger shards, which are streamed.  A shard holds the open path and
the finished nodes that wait for their parent's least member.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tickloom.llm.store import staged, to_arrow

#: Conversations whose id is rounded down to a multiple of this share their first turns.
FAMILY, MOST_SHARED = 100, 5
MARK = 16
#: Turns and conversations to a shard, and shards at most.
SHARD_TURNS, MAX_SHARDS = 16_000, 8192
SAMPLE_PER_SHARD = 8
SKELETON_NODES, SPLITTER_BYTES = 200_000, 64_000_000
#: Conversation ids in one piece of a skeleton node's list.
ENDS_PIECE = 50_000

_LEAST = -(1 << 63)
_NOTHING = hashlib.sha256(b"").hexdigest()
_OUT = 1000


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): marks and code points of the turns of each rebuilt conversation."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    said = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    conv = F.col("conv_id").cast("long")
    marked = turns.where(F.col("conv_id").isNotNull()).select(
        (conv - conv % FAMILY).alias("head"),
        conv.alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), F.sha2(said, 256).substr(1, 2 * MARK).alias("mark"), F.char_length(text).alias("size")).alias("turn"),
    )
    own = marked.groupBy("head", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    heads = own.where("conv_id = head").select(F.col("head").alias("__head"), F.slice("turns", 1, MOST_SHARED).alias("__first"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)).cast("int")
    nothing = F.slice("turns", 1, 0)
    rebuilt = F.concat(F.slice(F.coalesce("__first", nothing), F.lit(1), taken), F.slice("turns", taken + 1, F.size("turns")))
    joined = own.join(heads, own["head"] == heads["__head"], "left").select("conv_id", rebuilt.alias("turns"))
    return joined.select("conv_id", F.unhex(F.array_join(F.col("turns.mark"), "")).alias("path"), F.col("turns.size").alias("sizes"))


def common(a: bytes, b: bytes) -> int:
    """How many turns two paths share from the start."""
    most = min(len(a), len(b)) // MARK
    if a[: most * MARK] == b[: most * MARK]:
        return most
    low, high = 0, most
    while low < high - 1:
        middle = (low + high) // 2
        if a[: middle * MARK] == b[: middle * MARK]:
            low = middle
        else:
            high = middle
    return low


# splitters and skeleton


def _choose(step: float):
    """Splitters of one sorted sample: the shortest path that tells two neighbours apart, or a place among equal paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen: list[tuple[bytes, int]] = []
        every, held, before, weight, size, nodes = step, 0, None, 0.0, 0, 0
        for batch in batches:
            for path, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if before is not None and weight >= every:
                    shared = common(before, path)
                    found = (path, conv) if path == before else (path[: (shared + 1) * MARK], _LEAST)
                    last = chosen[-1][0] if chosen else b""
                    if found[0] == last:
                        found = (last, found[1])  # equal paths are one object
                    else:
                        size += len(found[0])
                        nodes += len(found[0]) // MARK - common(last, found[0])
                    chosen.append(found)
                    weight = 0.0
                    while chosen and (size > SPLITTER_BYTES or nodes > SKELETON_NODES):
                        chosen, every = chosen[1::2], every * 2
                        size = sum(len(p) for (p, _), (q, _) in zip(chosen, [(None, 0), *chosen], strict=False) if p != q)
                        nodes = sum(len(p) // MARK - common(q, p) for (p, _), (q, _) in zip(chosen, [(b"", 0), *chosen], strict=False))
                before, held, weight = path, held + 1, weight + 1 + len(path) // MARK
        last = None
        for path, conv in chosen:
            yield pa.RecordBatch.from_arrays([pa.array([None if path == last else path], pa.binary()), pa.array([conv], pa.int64())], names=["path", "conv_id"])
            last = path

    return run


def splitters(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> list[tuple[bytes, int]]:
    """At most ``MAX_SHARDS`` places (path, conv_id), ascending; a shard begins at each."""
    count, turns = rows.agg(F.count("*"), F.sum(F.octet_length("path") / MARK)).first()
    if not count:
        return []
    shards = min(MAX_SHARDS, int((count + turns) // shard_turns) + 1)
    if shards == 1:
        return []
    share = min(1.0, SAMPLE_PER_SHARD * shards / count)
    place = F.pmod(F.xxhash64(F.lit(11), "conv_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(place < share).select("path", "conv_id").repartition(1).sortWithinPartitions("path", "conv_id")
    found, path = [], b""
    for r in sample.mapInArrow(_choose((count + turns) * share / shards), "path binary, conv_id long").collect():
        path = path if r["path"] is None else bytes(r["path"])
        found.append((path, r["conv_id"]))
    return found


class Skeleton(NamedTuple):
    """The trie of the splitter paths.  Node (j, d) is the first d turns of splitter j, the first one that has them."""

    places: list[tuple[bytes, int]]
    shared: list[int]

    @classmethod
    def of(cls, places: list[tuple[bytes, int]]) -> Skeleton:
        return cls(places, [0, *(common(a[0], b[0]) for a, b in zip(places, places[1:], strict=False))])

    def shard(self, path: bytes, conv: int) -> int:
        return bisect.bisect_right(self.places, (path, conv))

    def owners(self, j: int) -> list[int]:
        """For each depth of splitter j, from 0, the splitter that owns its prefix."""
        if not self.places:
            return [0]
        depth = len(self.places[j][0]) // MARK
        found = [0] * (depth + 1)
        while j > 0 and depth > 0:
            if self.shared[j] < depth:
                found[self.shared[j] + 1 : depth + 1] = [j] * (depth - self.shared[j])
                depth = self.shared[j]
            j -= 1
        return found


# the pass over a shard

_DEAL = StructType([StructField("shard", IntegerType()), StructField("conv_id", LongType()), StructField("path", BinaryType()), StructField("sizes", BinaryType())])

#: ``owner`` is null for a finished node, else the splitter that owns the skeleton node; ``up`` is the owner of an unfinished parent.
_NODE = StructType(
    [StructField(c, LongType()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [StructField("ends_sha256", StringType())]
    + [StructField(c, LongType()) for c in ("owner", "up", "size", "shard", "piece")]
    + [StructField("ends", BinaryType())]
)


def _deal(skeleton: Skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs, ways = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            shards = [skeleton.shard(p, c) for p, c in zip(ways, convs, strict=True)]
            sizes = batch.column(2)
            packed = [sizes[i].values.to_numpy().astype("<i4").tobytes() for i in range(len(convs))]
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), batch.column(0), pa.array(ways, pa.binary()), pa.array(packed, pa.binary())], schema=to_arrow(_DEAL))

    return run


class _Open:
    """A node whose subtree is being read."""

    __slots__ = ("children", "ends", "hash", "least", "leaves", "members", "saved", "size", "waiting")

    def __init__(self, size: int):
        self.size, self.least, self.members, self.children, self.leaves, self.saved = size, None, 0, 0, 0, 0
        self.hash, self.ends, self.waiting = None, [], []


class _Shard:
    def __init__(self, number: int, skeleton: Skeleton, out: list[tuple]):
        self.number, self.out, self.stack, self.path, self.inside, self.pieces = number, out, [_Open(0)], b"", 0, 0
        places = skeleton.places
        low = [number - 1] if number > 0 else []
        high = [number] if number < len(places) else []
        self.edges = [(places[j][0], skeleton.owners(j)) for j in low + high]

    def owner(self, depth: int) -> int:
        """The owner of the skeleton node at ``depth`` of the open path."""
        for path, owners in self.edges:
            if depth < len(owners) and path[: depth * MARK] == self.path[: depth * MARK]:
                return owners[depth]
        return 0

    def close(self, depth: int) -> None:
        """Finish the open nodes below ``depth``."""
        while len(self.stack) - 1 > depth:
            d, node = len(self.stack) - 1, self.stack.pop()
            above = self.stack[-1]
            if above.least is None or node.least < above.least:
                above.least = node.least
            above.members += node.members
            if d <= self.inside:
                self.partial(d, node)
                continue
            above.children += 1
            above.leaves += node.leaves if node.children else 1
            above.saved += node.saved + (node.members - 1) * node.size
            for row in node.waiting:
                self.out.append((row[0], row[1], node.least, *row[3:]))
            ends = node.hash.hexdigest() if node.hash else _NOTHING
            leaves = node.leaves if node.children else 1
            row = (node.least, d, None, node.members, node.children, leaves, node.saved + (node.members - 1) * node.size, ends)
            if d - 1 > self.inside:
                above.waiting.append((*row, None, None, None, None, None, None))
            else:
                self.out.append((*row, None, self.owner(d - 1), None, None, None, None))

    def partial(self, depth: int, node: _Open) -> None:
        """What this shard knows of a skeleton node; parts below it that are skeleton nodes themselves are left out."""
        owner = self.owner(depth)
        self.send_ends(depth, owner, node)
        self.out.append((node.least, depth, None, node.members, node.children, node.leaves, node.saved, None, owner, None, node.size, None, None, None))

    def send_ends(self, depth: int, owner: int, node: _Open) -> None:
        if node.ends:
            blob = zlib.compress(",".join(map(str, node.ends)).encode(), 1)
            self.out.append((None, depth, None, None, None, None, None, None, owner, None, None, self.number, self.pieces, blob))
            self.pieces += 1
            node.ends = []

    def add(self, conv: int, path: bytes, sizes: memoryview) -> None:
        self.close(common(self.path, path))
        self.path = path
        self.inside = max((common(edge, path) for edge, _ in self.edges), default=0)
        while len(self.stack) - 1 < len(path) // MARK:
            self.stack.append(_Open(sizes[len(self.stack) - 1]))
        node, depth = self.stack[-1], len(self.stack) - 1
        node.members += 1
        if node.least is None or conv < node.least:
            node.least = conv
        if depth <= self.inside:
            node.ends.append(conv)
            if len(node.ends) >= ENDS_PIECE:
                self.send_ends(depth, self.owner(depth), node)
        elif node.hash is None:
            node.hash = hashlib.sha256(str(conv).encode())
        else:
            node.hash.update(f",{conv}".encode())

    def end(self) -> None:
        self.close(0)
        self.partial(0, self.stack[0])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = to_arrow(_NODE)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _read_shards(skeleton: Skeleton):
    """Rows ordered by shard, path and conv_id, to finished nodes, parts of skeleton nodes and pieces of their ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        shard = None
        for batch in batches:
            for number, conv, path, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard is None or shard.number != number:
                    if shard:
                        shard.end()
                    shard = _Shard(number, skeleton, out)
                shard.add(conv, path, memoryview(sizes).cast("i"))
                while len(out) >= _OUT:
                    yield _batch(out[:_OUT])
                    del out[:_OUT]
        if shard:
            shard.end()
        while out:
            yield _batch(out[:_OUT])
            del out[:_OUT]

    return run


# the skeleton


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(owner, depth, ends_sha256) of pieces that come ordered by owner, depth, shard and piece."""
    names, now, digest = ["owner", "depth", "ends_sha256"], None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([digest.hexdigest()])], names=names)

    for batch in batches:
        for i in range(batch.num_rows):
            key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
            text = zlib.decompress(batch.column(2)[i].as_py())
            if key != now:
                if now:
                    yield row()
                now, digest = key, hashlib.sha256(text)
            else:
                digest.update(b",")
                digest.update(text)
    if now:
        yield row()


def _roll_up(skeleton: Skeleton):
    """Finished skeleton nodes, from their reduced parts: at most ``SKELETON_NODES`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = {(r["owner"], r["depth"]): r for b in batches for r in b.to_pylist()}
        above, last, owners = {}, None, []
        for owner, depth in sorted(nodes):
            if owner != last:
                last, owners = owner, skeleton.owners(owner)
            above[owner, depth] = (owners[depth - 1], depth - 1) if depth else None
        for key in sorted(nodes, key=lambda k: -k[1]):
            node = nodes[key]
            node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
            node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
            if above[key]:
                up = nodes[above[key]]
                up["n_children"] += 1
                up["n_leaves"] += node["n_leaves"]
                up["saved_tokens"] += node["saved_tokens"]
        rows = [
            (n["conv_id"], n["depth"], nodes[above[k]]["conv_id"] if above[k] else None, n["n_convs"], n["n_children"], n["n_leaves"], n["saved_tokens"], n["ends_sha256"] or _NOTHING, k[0], None, None, None, None, None)
            for k, n in nodes.items()
        ]
        for at in range(0, len(rows), _OUT):
            yield _batch(rows[at : at + _OUT])

    return run


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = staged(paths(turns), "paths")
    skeleton = Skeleton.of(splitters(rows, shard_turns))
    dealt = rows.select("conv_id", "path", "sizes").mapInArrow(_deal(skeleton), _DEAL)
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    read = staged(ordered.mapInArrow(_read_shards(skeleton), _NODE), "nodes")

    parts = read.where("owner IS NOT NULL AND ends IS NULL").groupBy("owner", "depth")
    reduced = parts.agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("size").alias("size"))
    pieces = read.where("ends IS NOT NULL").repartition("owner", "depth").sortWithinPartitions("owner", "depth", "shard", "piece")
    hashed = pieces.select("owner", "depth", "ends").mapInArrow(_hash_pieces, "owner long, depth long, ends_sha256 string")
    whole = reduced.join(hashed, ["owner", "depth"], "left").repartition(1).mapInArrow(_roll_up(skeleton), _NODE)
    whole = staged(whole, "skeleton")

    finished = read.where("owner IS NULL AND up IS NULL").select(*COLUMNS)
    # Bounded by SKELETON_NODES rows of three numbers.
    ups = F.broadcast(whole.select(F.col("owner").alias("up"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("__parent")))
    below = read.where("up IS NOT NULL").join(ups, ["up", "depth"]).withColumn("parent_conv_id", F.col("__parent")).select(*COLUMNS)
    return finished.unionByName(below).unionByName(whole.select(*COLUMNS))

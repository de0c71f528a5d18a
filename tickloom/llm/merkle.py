"""Merkle manifest of a dataset: levels of digests stored as parent-linked node rows, and a recursive query that climbs them.

A leaf is H (lowercase hex SHA-256 of its inputs, one after another, digests as hex text) of
the fields of a document, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value.
Per source, leaves ascend by doc_id (null first, equal ids by leaf).  While several nodes
remain, every three consecutive ones become their H.  What remains is the subroot.  The
subroots, ordered by source (null first, bytewise), give the root in the same way.

``build`` stores the tree; a node row reaches ``STEP`` levels up: it holds the siblings of
each of these levels and links to the row of its ancestor there.  ``verify`` starts a
recursive query at every leaf, with the hash of the document as it is now; each step joins
the linked row, appends its siblings to the proof and folds the hash with them.

Null and repeated ids and repeated rows are leaves of their own.  A source of one document
has its leaf as subroot; with one source, its subroot is the root.  No documents: no rows.
Other columns are not looked at, whatever their names.

Scale: texts are read once and never move; rows are numbered by their place in a range sort,
so a source that holds a third of all rows is spread.  A row that many leaves climb through is
stored in copies, of which a leaf takes one, so that none is a hot key of the join.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.store import staged
from tickloom.session import BROADCAST_ROWS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
#: Levels that one row of the tree, and one step of the climb, goes up.
STEP = 6
BLOCK = ARITY**STEP
#: Leaves that climb through one copy of a row.
LOAD = 50_000
#: Rows to a task of the range sort.
TASK_ROWS = 2_000_000
#: The group of the subroots; other groups are numbered from 0.
TOP = -1


def h(*digests: Column) -> Column:
    """H of binary digests."""
    return F.unhex(F.sha2(F.lower(F.hex(F.concat(*digests))).cast("binary"), 256))


def _text_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_hash(columns: dict[str, Column]) -> Column:
    """The binary leaf of a document."""
    parts = []
    for name in FIELDS:
        value = columns[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


# numbering


def _numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with __g (the place of the group's first row: ascends with ``group``), __i (number in the group) and __m (its size).

    Rows are sorted once by ranges; a group that spans many ranges is numbered from their counts.
    """
    spark = rows.sparkSession
    tasks = -(-rows.count() // TASK_ROWS)
    keys = [group, *order]
    ranged = rows.repartitionByRange(tasks, *keys) if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else rows.repartitionByRange(*keys)
    placed = ranged.sortWithinPartitions(*keys).withColumn("__place", F.monotonically_increasing_id())
    placed = staged(placed.withColumn("__task", F.shiftright("__place", 33)), "sorted")
    runs = placed.groupBy("__task", F.col(group).alias("__group")).agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    by_group = Window.partitionBy("__group")
    earlier = F.sum("__n").over(by_group.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    runs = staged(
        runs.select("__task", "__group", "__first", F.coalesce(earlier, F.lit(0)).alias("__before"), F.min("__first").over(by_group).alias("__g"), F.sum("__n").over(by_group).alias("__m")),
        "runs",
    ).withColumnRenamed("__task", "__run")
    if runs.count() <= BROADCAST_ROWS:
        runs = F.broadcast(runs)
    joined = placed.join(runs, (F.col("__task") == F.col("__run")) & F.col(group).eqNullSafe(F.col("__group")))
    number = F.col("__place") - F.col("__first") + F.col("__before")
    return joined.select(*rows.columns, "__g", number.alias("__i"), "__m")


# building


def _up(level: Column) -> Column:
    """The next level above an array of digests."""
    run = lambda i: F.array_join(F.transform(F.slice(level, i * ARITY + 1, F.lit(ARITY)), _text_of), "")
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: F.unhex(F.sha2(run(i).cast("binary"), 256)))


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of consecutive nodes (g, i, m, digest, load, tag), the levels within them, and what each node has beside it.

    (g, b, m, top, load, nodes): ``nodes`` has i, digest, tag, load, before and after (the siblings' digests by level).
    """
    member = F.struct("i", "digest", "load", "tag")
    block = F.floor(F.col("i") / BLOCK).cast("long")
    grouped = nodes.groupBy("g", block.alias("b"), "m").agg(F.sort_array(F.collect_list(member)).alias("l"), F.sum("load").alias("load"))
    rows = grouped.withColumn("a0", F.col("l.digest"))
    for k in range(STEP):
        # A group of one node at this level is at its top.
        rows = rows.withColumn(f"a{k + 1}", F.when(F.col("m") > ARITY**k, _up(F.col(f"a{k}"))))
    tops = [F.col(f"a{k}")[0] for k in range(STEP, -1, -1)]

    def sides(i: Column) -> tuple[Column, Column]:
        before, after = [], []
        for k in range(STEP):
            level, at = F.col(f"a{k}"), F.floor(i / ARITY**k).cast("int")
            place = at % ARITY
            before.append(F.when(F.col("m") > ARITY**k, F.concat(*_each(level, at - place, place, ARITY - 1))))
            after.append(F.when(F.col("m") > ARITY**k, F.concat(*_each(level, at + 1, ARITY - 1 - place, ARITY - 1))))
        used = F.filter(F.array(*(F.when(F.col("m") > ARITY**k, F.lit(k)) for k in range(STEP))), lambda x: x.isNotNull())
        return tuple(F.slice(F.array(*s), 1, F.size(used)) for s in (before, after))

    def node(x: Column, i: Column) -> Column:
        before, after = sides(i)
        return F.struct(x["i"].alias("i"), x["digest"].alias("digest"), x["load"].alias("load"), x["tag"].alias("tag"), before.alias("before"), after.alias("after"))

    return rows.select("g", "b", "m", "load", F.coalesce(*tops).alias("top"), F.transform("l", node).alias("nodes"))


def _each(level: Column, start: Column, count: Column, most: int) -> list[Column]:
    """The digests start, start + 1 ... of a level, as far as they exist and up to ``count``; empty beyond."""
    return [F.when((F.lit(k) < count), F.coalesce(F.get(level, start + k), F.unhex(F.lit("")))).otherwise(F.unhex(F.lit(""))) for k in range(most)]


class Tree(NamedTuple):
    """``leaves``: one row per document.  ``inner``: the other rows of the tree.  ``root``: hex, None without documents."""

    leaves: DataFrame
    inner: DataFrame
    root: str | None


def _copies(load: Column) -> Column:
    return F.ceil(load / LOAD).cast("long")


def _rows(blocks: DataFrame, level: int, up: DataFrame | None) -> DataFrame:
    """The node rows of stored blocks, linked to the block's row or, where the block ends its group, to the subroot's row."""
    none = F.lit(None).cast("long")

    def linked(rows: DataFrame, up_g: Column, up_l: Column, up_i: Column) -> DataFrame:
        to = (up_g.alias("up_g"), up_l.cast("int").alias("up_l"), up_i.alias("up_i"), _copies(F.col("load")).alias("up_n"))
        return rows.select("g", F.lit(level).alias("l"), *to, F.inline("nodes"))

    inside = linked(blocks.where(F.col("m") > BLOCK), F.col("g"), F.lit(level + 1), F.col("b"))
    ended = blocks.where(F.col("m") <= BLOCK)
    if up is None:
        return inside.unionByName(linked(ended, none, none, none))
    rank = up.select(F.col("tag.group").alias("__group"), F.col("i").alias("__rank"))
    rank = F.broadcast(rank) if up.count() <= BROADCAST_ROWS else rank
    return inside.unionByName(linked(ended.join(rank, F.col("g") == F.col("__group")), F.lit(TOP).cast("long"), F.lit(0), F.col("__rank")))


def _levels(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Stored blocks, level by level, until every group is one block."""
    found = []
    while True:
        found.append(staged(_blocks(nodes), label))
        more = found[-1].where(F.col("m") > BLOCK)
        if more.isEmpty():
            return found
        tag = F.col("nodes")[0]["tag"]
        nodes = more.select("g", F.col("b").alias("i"), F.ceil(F.col("m") / BLOCK).cast("long").alias("m"), F.col("top").alias("digest"), "load", F.when(F.lit(False), tag).alias("tag"))


def build(docs: DataFrame, current: Column | None = None) -> Tree:
    """The tree over ``docs``.  ``current`` is the text to be held against it later, if not that of the tree."""
    columns = {c: F.col(c) for c in FIELDS}
    leaf = leaf_hash(columns)
    now = leaf if current is None else leaf_hash(columns | {"text": current})
    hashed = docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf.alias("leaf"), now.alias("now"), F.monotonically_increasing_id().alias("at"))
    rows = _numbered(staged(hashed, "leaves"), "source", ["doc_id", "leaf", "at"])
    tag = F.struct(F.col("doc_id").alias("doc_id"), F.col("now").alias("now"))
    nodes = rows.select(F.col("__g").alias("g"), F.col("__i").alias("i"), F.col("__m").alias("m"), F.col("leaf").alias("digest"), F.lit(1).cast("long").alias("load"), tag.alias("tag"))
    low = _levels(nodes, "blocks")

    tops = None
    for blocks in low:
        ended = blocks.where(F.col("m") <= BLOCK).select(F.lit(0).alias("one"), F.col("g").alias("group"), F.col("top").alias("digest"), "load")
        tops = ended if tops is None else tops.unionByName(ended)
    numbered = _numbered(staged(tops, "subroots"), "one", ["group"])
    subroots = numbered.select(F.lit(TOP).cast("long").alias("g"), F.col("__i").alias("i"), F.col("__m").alias("m"), "digest", "load", F.struct("group").alias("tag"))
    subroots = staged(subroots, "subroots")
    high = _levels(subroots, "top-blocks")
    root = high[-1].select(_text_of(F.col("top"))).first()

    plain = ["g", "l", "i", "digest", "load", "before", "after", "up_g", "up_l", "up_i", "up_n"]
    leaves = _rows(low[0], 0, subroots).select(*plain, "tag.doc_id", "tag.now")
    inner = None
    for level, blocks, up in [*((k, b, subroots) for k, b in enumerate(low) if k), *((k, b, None) for k, b in enumerate(high))]:
        rows = _rows(blocks, level, up).select(*plain)
        inner = rows if inner is None else inner.unionByName(rows)
    copied = inner.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), _copies(F.col("load")) - 1)))
    return Tree(leaves, staged(copied, "tree"), root[0] if root else None)


# climbing

# A leaf takes the copy of the linked row that its own number says.
_LINK = "{0}.up_g AS at_g, {0}.up_l AS at_l, {0}.up_i AS at_i, pmod({1}, {0}.up_n) AS at_copy"
_FOLD = "aggregate(sequence(1, size({1}.before)), {0}, (x, k) -> unhex(sha2(lower(hex(concat({1}.before[k - 1], x, {1}.after[k - 1]))), 256)))"
_FOLDED = "CASE WHEN size({1}.before) = 0 THEN {0} ELSE " + _FOLD + " END"
# One buffer of the siblings of all levels of a row.
_SIBLINGS = "unhex(array_join(transform(sequence(1, greatest(size({0}.before), 1)), k -> coalesce(hex(concat(try_element_at({0}.before, k), try_element_at({0}.after, k))), '')), ''))"

_CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT n.doc_id, n.digest AS leaf, n.salt, CAST(NULL AS BINARY) AS subroot, {_LINK.format("n", "n.salt")},
    {_FOLDED.format("n.now", "n")} AS folded, {_SIBLINGS.format("n")} AS proof
  FROM {{leaves}} n
  UNION ALL
  SELECT c.doc_id, c.leaf, c.salt, CASE WHEN n.g = {TOP} AND n.l = 0 THEN n.digest ELSE c.subroot END, {_LINK.format("n", "c.salt")},
    {_FOLDED.format("c.folded", "n")}, concat(c.proof, {_SIBLINGS.format("n")})
  FROM climb c JOIN {{inner}} n ON c.at_g = n.g AND c.at_l = n.l AND c.at_i = n.i AND c.at_copy = n.copy)
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, sha2(lower(hex(proof)), 256) AS proof_sha256, lower(hex(folded)) AS folded_root
FROM climb WHERE at_g IS NULL
"""
_ENDLESS = "spark.sql.cteRecursionRowLimit"


def verify(tree: Tree, spark: SparkSession) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every leaf."""
    salted = tree.leaves.withColumn("salt", F.pmod(F.xxhash64("g", "i"), F.lit(1 << 40)))
    before = spark.conf.get(_ENDLESS, None)
    # The climb has a row per leaf and step; the setting is a limit on all of them.
    spark.conf.set(_ENDLESS, "-1")
    try:
        climbed = staged(spark.sql(_CLIMB.format(leaves="{leaves}", inner="{inner}"), leaves=salted, inner=tree.inner), "climbed")
    finally:
        spark.conf.unset(_ENDLESS) if before is None else spark.conf.set(_ENDLESS, before)
    root = F.lit(tree.root)
    return climbed.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def manifest(docs: DataFrame, current: Column | None = None) -> DataFrame:
    """Each document's leaf and proof, and the root that ``current`` (its text now) gives with that proof."""
    return verify(build(docs, current), docs.sparkSession)

"""N-gram Jaccard join by PartEnum signatures, and the groups it makes.

A document's set holds its distinct ``n``-word shingles (A-Z lower-cased; with fewer
words the whole sequence is the one shingle).  Two documents link when 100 * |A & B|
>= ``percent`` * |A | B|.

Sizes fall into bands [l, floor(l * 100 / percent)], so linked sets lie in the same
or in adjacent bands.  A set signs for its own band and for the one below.  For a
band with greatest size r, two sets that link differ in at most k shingles, so if the
domain is cut into k + 1 + m parts, at least m + 1 parts of both are equal.  Signatures
are the single parts, enumerated.  Parts with fewer than two shingles say little: a set
with at most m of them signs only the others, and still one equal part is among those.
A set with more signs parts of one shingle as well; one with more than m empty parts
signs the empty parts too, each with every part of a second, independent partition, where
one must be equal again.  So every pair that links shares a signature.

Documents with equal sets form one class, and all else runs on classes.  A class also
has a sketch: the parities of its shingles in 512 cells.  Sets that link differ in at
most (100 - p) / (100 + p) * (|r| + |s|) shingles and so in no more cells, so most pairs
that only share a signature end in the join.  The others are verified on the exact sets.
A signature with few classes gives all its pairs.  One with many first gives only pairs
with leaders, the classes in most of the large signatures; linked classes merge, and then
pairs of still separate classes are looked at.  Where a signature would give very many of those
(a passage that many unlinked texts share), they must also have an equal part of a second,
independent partition, which pairs that link have as well.  Links inside a component are not
all listed, but none that joins two is lost.

Null or blank text: n_shingles 0, linked with nothing.  Null doc_id: counted, never
linked, component_id null.  Rows that share a doc_id are told apart by their sets; an
equal row is in the same class.  Empty tables give no rows.  Extra columns of the input
are not in the result.  Sets and shingles are named by 64-bit hashes.  Signatures are
counted by an aggregate and joined with their counts, so no task gets all rows of one.
Large tables of signatures, sets and pairs are worked on in slices, whose shuffle files go
before the next slice begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tickloom.llm.components import components
from tickloom.llm.store import lean, staged, staged_parts, to_arrow
from tickloom.llm.text import mix, mix_one, shingle_sets
from tickloom.session import freed

SHINGLE = 4
PERCENT = 85
#: Parts beyond k + 1, as a share of them.
SPARE = 0.06
#: Signatures shared by at most so many classes give all their pairs.
SMALL = 12
#: Pairs of classes that one signature may compare in the last round by itself.  Beyond, a pair that is alike
#: comes once for each equal part of the second partition, which pays only where nearly all pairs are not.
LAST_PAIRS = 1_000_000_000
#: 64-bit words of a sketch.
SKETCH = 8
#: Work over more rows (signatures, shingles; pairs of sets) than these goes in slices, one after another, so
#: that only a slice's rows lie in shuffle files at a time.  Pairs are sliced by both of their classes.
SLICED_ROWS, SLICES = 10_000_000, 8
SLICED_PAIRS, PAIR_SLICES = 50_000, 3

_U = np.uint64


def bands(percent: int) -> Iterator[tuple[int, int]]:
    low = 1
    while True:
        high = max(low, low * 100 // percent)
        yield low, high
        low = high + 1


class Bands:
    """Band of a size, and parts of a band; grown as larger sets come."""

    def __init__(self, percent: int):
        self.percent, self._source = percent, bands(percent)
        self.highs: list[int] = []
        self._parts: dict[int, tuple[int, int, np.ndarray]] = {}

    def band(self, size: int) -> int:
        while not self.highs or self.highs[-1] < size:
            self.highs.append(next(self._source)[1])
        return int(np.searchsorted(self.highs, size))

    def parts(self, band: int) -> tuple[int, int, np.ndarray]:
        """k + 1 + m, m, and where the parts of the hashes begin; a part is a range of hashes.

        For sets r of this band and s of at most r * 100 / percent,
        |r ^ s| <= (100 - p) / (100 + p) * (|r| + |s|) <= |r| * (100 - p) / p = k.
        """
        found = self._parts.get(band)
        if found is None:
            least = self.highs[band] * (100 - self.percent) // self.percent + 1
            spare = round(SPARE * least) + 1 if least > 8 else 0
            parts = least + spare
            edges = np.array([(j << 64) // parts for j in range(1, parts)], _U)
            found = self._parts[band] = (parts, spare, edges)
        return found


def _contents(shingles: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and size of each part of a sorted set."""
    cuts = np.concatenate(([0], np.searchsorted(shingles, edges), [len(shingles)]))
    sums = np.zeros(len(shingles) + 1, _U)
    np.cumsum(mix(shingles ^ _U(0xA5A5A5A5A5A5A5A5)), out=sums[1:])
    sizes = np.diff(cuts)
    return mix(sums[cuts[1:]] - sums[cuts[:-1]] + sizes.astype(_U)), sizes


def signatures(shingles: np.ndarray, limits: Bands) -> np.ndarray:
    """All signatures of a sorted set."""
    if not len(shingles):
        return np.zeros(0, _U)
    own = limits.band(len(shingles))
    found, second = [], None
    for band in range(max(0, own - 1), own + 1):
        parts, spare, edges = limits.parts(band)
        hashes, sizes = _contents(shingles, edges)
        place = mix(np.arange(parts, dtype=_U) + _U(mix_one(band + 1)))
        signed = mix(hashes ^ place)
        if int((sizes < 2).sum()) <= spare:
            found.append(signed[sizes > 1])
            continue
        found.append(signed[sizes > 0])
        empty = np.flatnonzero(sizes == 0)
        if len(empty) > spare:
            if second is None:
                second = np.sort(mix(shingles + _U(0x51ED270B9F3C4D21)))
            again, _ = _contents(second, edges)
            found += [mix(mix(again ^ place) + signed[e]) for e in empty]
    return np.concatenate(found)


def second_signatures(shingles: np.ndarray, limits: Bands) -> np.ndarray:
    """All parts of a sorted set in a partition of its own, empty ones too."""
    mixed, found, own = np.sort(mix(shingles + _U(0x8CB92BA72F3D8DD7))), [], limits.band(len(shingles))
    for band in range(max(0, own - 1), own + 1):
        parts, _, edges = limits.parts(band)
        hashes, _ = _contents(mixed, edges)
        found.append(mix(hashes ^ mix(np.arange(parts, dtype=_U) + _U(mix_one(band + 1) ^ 0x5851F42D4C957F2D))))
    return np.unique(np.concatenate(found))


def set_id(shingles: np.ndarray) -> int:
    """64 bits that name a set; 0 is the empty set."""
    if not len(shingles):
        return 0
    with np.errstate(over="ignore"):
        total = int(np.add.reduce(mix(shingles + _U(0x2545F4914F6CDD1D)))) + len(shingles)
    return mix_one(total) or 1


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles in each of 64 * SKETCH cells."""
    cells = (mix(shingles ^ _U(0x1F83D9ABFB41BD6B)) & _U(64 * SKETCH - 1)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=64 * SKETCH) & 1).astype(np.uint8)).view(np.int64)


_SETS = StructType([StructField("doc_id", LongType()), StructField("n_shingles", LongType()), StructField("class", LongType()), StructField("signatures", ArrayType(LongType())), StructField("sketch", ArrayType(LongType()))])
_MEMBER = StructType([StructField("class", LongType()), StructField("shingles", ArrayType(LongType()))])
_LINK = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _set_rows(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, limits, seen = to_arrow(_SETS), Bands(percent), {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                sizes, names, signed, sketches = [], [], [], []
                for s, doc in zip(shingle_sets(part.column(1), shingle), part.column(0).to_pylist(), strict=True):
                    name = _signed(set_id(s))
                    sizes.append(len(s))
                    names.append(name)
                    # A task signs an equal set again only for a smaller id, which may be the class's least.
                    if doc is None or name == 0 or seen.get(name, doc + 1) <= doc:
                        signed.append(None)
                        sketches.append(None)
                    else:
                        seen[name] = doc
                        signed.append(np.unique(signatures(s, limits)).view(np.int64))
                        sketches.append(sketch(s))
                columns = [part.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(signed, types.field(3).type), pa.array(sketches, types.field(4).type)]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return run


def _shingle_rows(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow(_MEMBER)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                sets = list(shingle_sets(part.column(0), shingle))
                yield pa.RecordBatch.from_arrays([pa.array([_signed(set_id(s)) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], types.field(1).type)], schema=types)

    return run


def _second_rows(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, limits = to_arrow(_MEMBER), Bands(percent)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                signed = [second_signatures(s.values.to_numpy().view(_U), limits).view(np.int64) for s in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(signed, types.field(1).type)], schema=types)

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow(_LINK)
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=types).filter(mask)

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int, slices: int = 1, cell: tuple[int, int] = (0, 0)) -> DataFrame:
    """The pairs (a, b) of classes whose sets link; all a and all b are of one slice each."""
    left, right = (sets.where(_slice("class", slices, i)) for i in cell)
    a = left.select(F.col("class").alias("a"), F.col("shingles").alias("left"))
    b = right.select(F.col("class").alias("b"), F.col("shingles").alias("right"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(lean(_verified(percent)), _LINK)


def _slice(column: str, slices: int, i: int):
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(slices)) == i


def _slices(rows: DataFrame) -> int:
    """The slices of so many rows as the only value of a table says."""
    return SLICES if (rows.first()[0] or 0) > SLICED_ROWS else 1


def _sliced_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``_links``, stored."""
    pairs = staged(pairs, "candidates")
    slices = PAIR_SLICES if pairs.count() > SLICED_PAIRS else 1
    cells = ((i, j) for i in range(slices) for j in range(slices))
    links = staged_parts((_links(pairs.where(_slice("a", slices, i) & _slice("b", slices, j)), sets, percent, slices, (i, j)) for i, j in cells), "links")
    freed(pairs)
    return links


def _like(percent: int):
    """Whether classes x and y may link, by sizes and sketches."""
    cells = sum((F.bit_count(F.col(f"x.k{i}").bitwiseXOR(F.col(f"y.k{i}"))) for i in range(SKETCH)), F.lit(0))
    sizes = F.col("x.size") + F.col("y.size")
    near = 100 * F.least("x.size", "y.size") >= percent * F.greatest("x.size", "y.size")
    return near & ((100 + percent) * cells <= (100 - percent) * sizes)


def _pairs(x: DataFrame, y: DataFrame, percent: int, apart=None) -> DataFrame:
    """Distinct pairs (a < b) of classes that share a signature, may link and are ``apart``."""
    met = (F.col("x.signature") == F.col("y.signature")) & (F.col("x.class") != F.col("y.class")) & _like(percent)
    joined = x.alias("x").join(y.alias("y"), met if apart is None else met & apart)
    return joined.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members with the component of each class (itself where it has no link)."""
    found = labels.select(F.col("vertex").alias("class"), "component")
    return members.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links."""
    return components(labels.select(F.col("vertex").alias("a"), F.col("component").alias("b")).union(links))


def link_components(members: DataFrame, sets_of, percent: int) -> DataFrame:
    """(vertex, component) of all links of signature members (signature, class, n, size, sketch).

    ``sets_of`` gives the exact sets of a table of classes, stored.
    """
    small, large = members.where(F.col("n") <= SMALL), members.where(F.col("n") > SMALL)
    slices = SLICES if small.count() > SLICED_ROWS else 1
    by_slice = (small.where(_slice("signature", slices, i)) for i in range(slices))
    pairs = staged_parts((_pairs(part, part, percent, F.col("x.class") < F.col("y.class")) for part in by_slice), "pairs")
    if slices > 1:
        met, pairs = pairs, staged(pairs.distinct(), "pairs")
        freed(met)
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).union(large.select("class"))
    sets = sets_of(wanted.distinct())
    if large.isEmpty():
        links = _sliced_links(pairs, sets, percent)
        freed(pairs, sets)
        return components(links)
    support = large.groupBy("class").agg(F.sum("n").alias("support"))
    large = staged(large.join(support, "class"), "large")
    best = F.max(F.struct("support", "class")).alias("best")
    leaders = large.groupBy("signature").agg(best).select("signature", F.col("best.class").alias("class"))
    led = _pairs(large.join(leaders, ["signature", "class"], "left_semi"), large, percent)
    links = _sliced_links(pairs.union(led).distinct(), sets, percent)
    freed(pairs)
    labels = components(links)
    freed(links)
    # Signatures whose classes are not one component yet: the best class outside of the largest component leads,
    # then whatever is outside of it meets all that is apart from it.
    for last in (False, True):
        labelled = staged(_labelled(large, labels), "labelled")
        sizes = labelled.groupBy("signature", "component").agg(F.count("*").alias("count"), best)
        largest = sizes.groupBy("signature").agg(F.max(F.struct("count", "component")).alias("t"), F.count("*").alias("parts")).where("parts > 1")
        largest = staged(largest.select("signature", F.col("t.component").alias("main")), "main")
        if largest.isEmpty():
            break
        outside = labelled.join(largest, "signature").where("component != main")
        if not last:
            leaders = outside.groupBy("signature").agg(best).select("signature", F.col("best.class").alias("class"))
            outside = outside.join(leaders, ["signature", "class"], "left_semi")
        inside = labelled.join(largest.select("signature"), "signature", "left_semi")
        apart = F.col("x.component") != F.col("y.component")
        if last:
            outside, inside = _narrowed(outside, inside, sets, percent)
        links = _sliced_links(_pairs(outside, inside, percent, apart), sets, percent)
        labels = _joined(labels, links)
        freed(links, labelled)
    freed(sets, large)
    return labels


def _narrowed(outside: DataFrame, inside: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Both sides, where the signatures that would give too many pairs are replaced by them and a second equal part."""
    few = outside.groupBy("signature").agg(F.count("*").alias("o")).join(inside.groupBy("signature").agg(F.count("*").alias("i")), "signature")
    heavy = staged(few.where(F.col("o") * F.col("i") > LAST_PAIRS).select("signature"), "heavy")
    if heavy.isEmpty():
        return outside, inside
    classes = staged(inside.join(heavy, "signature", "left_semi").select("class").distinct(), "heavy-classes")
    second = staged(sets.join(classes, "class", "left_semi").mapInArrow(lean(_second_rows(percent)), _MEMBER), "second")

    def spread(side: DataFrame) -> DataFrame:
        narrow = side.join(heavy, "signature", "left_semi").join(second, "class").withColumn("second", F.explode("shingles"))
        narrow = narrow.withColumn("signature", F.xxhash64("signature", "second")).select(*side.columns)
        return side.join(heavy, "signature", "left_anti").select(*side.columns).unionByName(narrow)

    return spread(outside), spread(inside)


def near_copies(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """A row per document: doc_id, n_shingles, class (64-bit name of its set), component (a class of its group) and component_id."""
    everything = staged(docs.select("doc_id", "text").mapInArrow(lean(_set_rows(shingle, percent)), _SETS), "signed-sets")
    rows = staged(everything.select("doc_id", "n_shingles", "class"), "sets")
    known = everything.where("class != 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("class").agg(F.min("doc_id").alias("least"), F.max("n_shingles").alias("size"), F.max("sketch").alias("sketch"))
    classes = staged(classes.select("class", "least", "size", *(F.col("sketch")[i].alias(f"k{i}") for i in range(SKETCH))), "classes")
    # Signatures are most of what is stored here, so they are looked at slice by slice.  Equal sets that several
    # tasks signed have the same ones: a signature is shared where its classes differ.
    signed = everything.where("signatures IS NOT NULL")
    slices = _slices(signed.agg(F.sum(F.size("signatures"))))
    spread = signed.select("class", F.explode("signatures").alias("signature"))

    def shared() -> Iterator[DataFrame]:
        for i in range(slices):
            part = spread.where(_slice("signature", slices, i))
            ends = part.groupBy("signature").agg(F.min("class").alias("low"), F.max("class").alias("high"))
            several = staged(ends.where("low != high").select("signature"), "shared")
            met = staged(part.join(several, "signature").distinct(), "met")
            freed(several)
            counts = met.groupBy("signature").agg(F.count("*").alias("n"))
            yield met.join(counts, "signature").join(classes.drop("least"), "class")
            freed(met)

    members = staged_parts(shared(), "members")
    freed(everything)

    def sets_of(wanted: DataFrame) -> DataFrame:
        chosen = staged(wanted.join(classes, "class").select("class", "least", "size"), "wanted")
        slices = _slices(chosen.agg(F.sum("size")))

        def part(i: int) -> DataFrame:
            mine = chosen.where(_slice("least", slices, i))
            some = docs.where(_slice("doc_id", slices, i))
            texts = some.join(mine.select(F.col("least").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
            found = texts.mapInArrow(lean(_shingle_rows(shingle)), _MEMBER).join(mine.select("class"), "class", "left_semi")
            return found.dropDuplicates(["class"])

        found = staged_parts(map(part, range(slices)), "shingles")
        freed(chosen)
        return found

    labels = link_components(members, sets_of, percent)
    freed(members)
    named = _labelled(classes.select("class", "least"), labels)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("class", "component", "component_id")
    joined = rows.join(named, "class", "left")
    alone = F.when(F.col("class") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return joined.select("doc_id", "n_shingles", "class", "component", alone.alias("component_id"))


def with_class(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the class of each text as LONG column ``name``."""
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow(schema)
        for batch in batches:
            names = pa.array([_signed(set_id(s)) for s in shingle_sets(batch.column(place), shingle)], pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(batch.columns, types, strict=False)), names], schema=types)

    return docs.mapInArrow(lean(run), schema)


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: the one with the least doc_id; rows without words or doc_id stay."""
    found = near_copies(docs, shingle, percent).where("doc_id = component_id AND class != 0")
    kept = staged(found.groupBy("component").agg(F.min(F.struct("class", "doc_id")).alias("k")).select("k.class", "k.doc_id"), "kept")
    kept = kept.select(F.col("class").alias("__kept"), F.col("doc_id").alias("__id"))
    rows = with_class(docs, "__class", shingle)
    joined = rows.join(kept, (F.col("__class") == F.col("__kept")) & (F.col("doc_id") == F.col("__id")), "left")
    first = Window.partitionBy("__class", "doc_id").orderBy(*(F.col(c) for c in docs.columns))
    numbered = joined.withColumn("__row", F.row_number().over(first))
    unlinked = (F.col("__class") == 0) | F.col("doc_id").isNull()
    return numbered.where(unlinked | (F.col("__kept").isNotNull() & (F.col("__row") == 1))).select(*docs.columns)

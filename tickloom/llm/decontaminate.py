"""Benchmark decontamination by template canonicalisation.

Texts become templates: words lose outer punctuation and case; numbers, capitalised
names and units (after a number) become typed placeholders that remember their values.
Windows of ``width`` template words of documents are hash-joined with those of benchmark
items (items shorter than that by their whole length).  Windows of a document and an
item that lie on one diagonal are one occurrence.  It counts as a whole if its slots are
consistent: each changed value of the item stands against one value of the document, and
the other way round; a value that stands against itself is no change.  Of an occurrence that
is not, the windows without any change count.  So a passage is caught as it is, with
its numbers and names exchanged, and with a few of them edited.  A document is
contaminated by an item when what counts covers
``run`` of the item's words, or all of a shorter item.

A template of few literal words would meet any text, so a window of them is joined by its
own words instead, without case; so is an item of fewer than ``LEAST_WORDS`` words, by its
whole length.  The other windows are joined in both ways, so that a copy in other case, all in
capitals too, is found.  Operators between words count there.

Documents' windows are looked up in a bitmap before the join, so nearly none of them are
shuffled; the join is exact.  The bitmap is made by the tasks that read the benchmark and grows
with its windows up to ``BITMAP_BITS[1]``.  The benchmark's windows are broadcast only when
counted to be few, in rows and bytes.

Null or empty texts and items hold nothing, nor does mere punctuation.  Null ids are matched like
others.  Rows that share a doc_id are told apart by their text.  Extra columns stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from tickloom.llm.store import lean, staged, to_arrow
from tickloom.llm.text import WORD, mix
from tickloom.session import BROADCAST_ROWS

WIDTH, RUN, LEAST_WORDS = 8, 13, 5
#: Windows joined as templates are few placeholders in the main: at least this share is literal words.
LITERAL_SHARE = 0.5
#: Bits that a window's hash is looked up by, at least and at most, and places of the bitmap for a window.
BITMAP_BITS, PLACES = (22, 28), 32
BROADCAST_BYTES = 64_000_000
CACHE = 400_000

#: Words that are units when they follow a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "$ usd dollar dollars cent cents eur euro euros gbp pound pounds % percent degrees kwh w kw v hz kb mb gb tb mph kmh".split()
)
#: Words that are numbers.
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split())
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?")
_GLUED = re.compile(r"\d[\d.,]*([a-z%]+)")
#: Lone signs that tell one calculation from another.
_OPERATORS = frozenset("+ - − * × · / ÷ = ≠ < > ≤ ≥ ^ ** == != <= >=".split())
_EDGES = "!\"#&'()*+,-./:;<=>?@[\\]^_`{|}~¡«»¿‘’“”…"

_LITERAL, _NUM, _UNIT, _NAME, _NUM_UNIT = range(5)
_U = np.uint64
_BASE = _U(0x9FB21C651E98DF25)
_PLACEHOLDER = mix(np.arange(5, dtype=_U) + _U(0xC0FFEE))
#: Windows are joined as templates, by their words, or both (the words of a template).
_TEMPLATE, _EXACT, _FOLDED = range(3)
_SALT = mix(np.arange(3, dtype=_U) + _U(0x5EED))


def canonical(word: str) -> tuple[int, str] | None:
    """(kind, value) of a word; None for mere punctuation.  A unit is one only after a number."""
    core = word.strip(_EDGES + "$%") or ("%" if "%" in word and len(word) == 1 else "")
    if not core:
        return None
    low = core.lower()
    if _NUMBER.fullmatch(low) or low in NUMBER_WORDS:
        return _NUM, low
    glued = _GLUED.fullmatch(low)
    if glued and glued[1] in UNITS:
        return _NUM_UNIT, low
    if low in UNITS:
        return _UNIT, low
    if core[0].isupper() and core[1:] and not core.isupper():
        return _NAME, low
    return _LITERAL, low


class Words(NamedTuple):
    """Of each template word: row, kind, template hash, number, hash of the word without case, and of the operator before it, whether it may be a unit."""

    row: np.ndarray
    kind: np.ndarray
    template: np.ndarray
    number: np.ndarray
    literal: np.ndarray
    operator: np.ndarray
    unit: np.ndarray


class Templates:
    """The template words of texts; words of before are remembered."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self._ids: dict[str, int] = {}
        self._kinds: list[int] = []
        self._values: list[str] = []
        self._hashes: list[int] = []
        self._operators: list[int] = []
        self._done = 0
        self._tables: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, _U)]

    def _id(self, word: str) -> int:
        found = canonical(word)
        if found is None:
            number = -1
            if word in _OPERATORS:
                self._operators.append(xxhash.xxh3_64_intdigest(word))
                number -= len(self._operators)
        else:
            number = len(self._kinds)
            self._kinds.append(found[0])
            self._values.append(found[1])
            self._hashes.append(xxhash.xxh3_64_intdigest(found[1]))
        self._ids[word] = number
        return number

    def of(self, texts: list[str | None]) -> Words:
        if len(self._ids) > CACHE:
            self._clear()
        ids, get, rows = [], self._ids.get, []
        for text in texts:
            own = WORD.findall(text or "")
            numbers = [get(w) for w in own]
            if None in numbers:
                numbers = [self._id(w) if (n := get(w)) is None else n for w in own]
            ids += numbers
            rows.append(len(numbers))
        number = np.array(ids, np.int64)
        row = np.repeat(np.arange(len(texts)), rows)
        real = number >= 0
        signs = np.zeros(len(number), _U)
        at = np.flatnonzero(number < -1) + 1
        at = at[at < len(number)]
        signs[at] = np.array(self._operators, _U)[-2 - number[at - 1]]
        number, row, signs = number[real], row[real], signs[real]
        if len(self._kinds) > self._done:
            self._tables = [np.array(self._kinds, np.int64), np.array(self._hashes, _U)]
            self._done = len(self._kinds)
        kind, literal = (t[number] for t in self._tables)
        unit = kind == _UNIT
        lone = unit.copy()
        lone[1:] &= ~((kind[:-1] == _NUM) & (row[1:] == row[:-1]))
        kind[lone] = _LITERAL
        return Words(row, kind, np.where(kind == _LITERAL, literal, _PLACEHOLDER[kind]), number, literal, signs, unit)

    def value(self, number: int) -> str:
        return self._values[number]


def _rolled(words: Words, n: int, template: bool) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each window; of templates, or of words with the operators between them."""
    first = words.template if template else words.literal
    later = first if template else first + words.operator
    count = len(first) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    total = np.full(count, n, _U) * _BASE + first[:count]
    for j in range(1, n):
        total = total * _BASE + later[j : j + count]
    at = np.flatnonzero(words.row[:count] == words.row[n - 1 :])
    return at, mix(total[at])


def _in_window(flags: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """How many words of each window have a flag."""
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[at + n] - sums[at]


_SLOTS = ArrayType(StringType())


def _schema(id_name: str) -> StructType:
    return StructType([StructField(c, LongType()) for c in (id_name, "text_key", "window", "n", "way", "at", "words")] + [StructField("slots", _SLOTS)])


def _window_rows(id_name: str, sought: list[tuple[int, int]] | None, width: int, bitmap: np.ndarray | None):
    """Windows of rows (id, text_key, text): of ``sought`` (n, way), in the bitmap; or each item's windows of its own length."""

    def found(words: Words, sizes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """n, way, first words and hashes."""
        wanted: dict[tuple[int, bool], list[int]] = {}
        for n, way in sought if bitmap is not None else [(n, way) for n in range(1, width + 1) for way in (_TEMPLATE, _EXACT, _FOLDED)]:
            wanted.setdefault((n, way == _TEMPLATE), []).append(way)
        for (n, template), ways in wanted.items():
            at, hashes = _rolled(words, n, template)
            for way in ways:
                window = hashes ^ _SALT[way]
                if bitmap is not None:
                    place = window >> _U(64 - _bits(bitmap))
                    keep = (bitmap[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)) & 1 == 1
                else:
                    good = (_in_window(words.kind == _LITERAL, at, n) >= LITERAL_SHARE * n) & (n >= LEAST_WORDS)
                    # Whether a first word is a unit depends on what stands before the copy.
                    keep = (np.minimum(sizes[words.row[at]], width) == n) & (~good | words.unit[at] if way == _EXACT else good)
                taken, window = at[keep], window[keep]
                if bitmap is not None and n < LEAST_WORDS:
                    # A whole item: one place of it is as good as all.
                    _, once = np.unique(np.stack([words.row[taken].astype(_U), window]), axis=1, return_index=True)
                    taken, window = taken[once], window[once]
                if len(taken):
                    yield n, way, taken, window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, templates = to_arrow(_schema(id_name)), Templates()
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                words = templates.of(batch.column(2).to_pylist())
                firsts = np.searchsorted(words.row, np.arange(batch.num_rows + 1))
                sizes = np.diff(firsts)
                for n, way, at, window in found(words, sizes):
                    own = words.row[at]
                    slots = [[templates.value(words.number[j]) for j in range(a, a + n) if words.kind[j] != _LITERAL] if way == _TEMPLATE else [] for a in at.tolist()]
                    taken = pa.array(own)
                    columns = [batch.column(0).cast(pa.int64()).take(taken), batch.column(1).take(taken)]
                    columns += [pa.array(c.astype(np.int64)) for c in (window.view(np.int64), np.full(len(at), n), np.full(len(at), way), at - firsts[own], sizes[own])]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(slots, types.field("slots").type)], schema=types)

    return run


def _bits(bitmap: np.ndarray) -> int:
    """How many bits of a hash are its place in a bitmap."""
    return (8 * len(bitmap)).bit_length() - 1


def _mapped(bits: int):
    """The bitmap of a task's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            place = batch.column(0).to_numpy().view(_U) >> _U(64 - bits)
            np.bitwise_or.at(bitmap, place >> _U(3), _U(1).astype(np.uint8) << (place & _U(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([bitmap.tobytes()], pa.binary())], names=["bitmap"])

    return run


def _bitmap(items: DataFrame, count: int) -> np.ndarray:
    """The places of all windows of the benchmark, merged from a few tasks."""
    bits = min(max((PLACES * count).bit_length(), BITMAP_BITS[0]), BITMAP_BITS[1])
    merged = np.zeros(1 << (bits - 3), np.uint8)
    for r in items.select("window").coalesce(8).mapInArrow(_mapped(bits), "bitmap binary").toLocalIterator():
        merged |= np.frombuffer(r["bitmap"], np.uint8)
    return merged


def _keyed(df: DataFrame, id_name: str) -> DataFrame:
    return df.select(F.col(id_name).cast("long").alias(id_name), F.xxhash64("text").alias("text_key"), "text")


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, run: int = RUN) -> DataFrame:
    """(doc_id, text_key, item_id, n_covered, n_item_words): documents that hold an item, and how many of its words."""
    schema = _schema("item_id")
    items = staged(_keyed(benchmark, "item_id").mapInArrow(_window_rows("item_id", None, width, None), schema), "items")
    count, size = items.agg(F.count("*"), F.sum(F.lit(80) + F.octet_length(F.array_join("slots", "")) + 24 * F.size("slots"))).first()
    sought = sorted((r["n"], r["way"]) for r in items.select("n", "way").distinct().collect())
    bitmap = _bitmap(items, count)
    rows = _keyed(docs, "doc_id").mapInArrow(lean(_window_rows("doc_id", sought, width, bitmap)), _schema("doc_id"))
    of_item = items.select("item_id", F.col("text_key").alias("item_key"), "window", "n", "way", F.col("at").alias("item_at"), F.col("words").alias("n_item_words"), F.col("slots").alias("item_slots"))
    if count <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES:
        of_item = F.broadcast(of_item)
    same = F.col("item_slots") == F.col("slots")
    met = rows.drop("words").join(of_item, ["window", "n", "way"])
    pairs = F.arrays_zip("item_slots", "slots")
    occurrence = ["doc_id", "text_key", "item_id", "item_key", "n_item_words", (F.col("at") - F.col("item_at")).alias("shift")]
    found = met.groupBy(*occurrence).agg(
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
        F.collect_set(F.struct("item_at", "n", same.alias("same"))).alias("windows"),
    )
    found = found.withColumn("pairs", F.filter("pairs", lambda p: p["item_slots"] != p["slots"]))
    one_to_one = (F.size(F.array_distinct("pairs.item_slots")) == F.size("pairs")) & (F.size(F.array_distinct("pairs.slots")) == F.size("pairs"))
    counted = F.when(one_to_one, F.col("windows")).otherwise(F.filter("windows", lambda w: w["same"]))
    words = found.select("doc_id", "text_key", "item_id", "item_key", "n_item_words", F.explode(counted).alias("w"))
    words = words.select("*", F.explode(F.sequence("w.item_at", F.col("w.item_at") + F.col("w.n") - 1)).alias("word"))
    covered = words.groupBy("doc_id", "text_key", "item_id", "item_key", "n_item_words").agg(F.size(F.collect_set("word")).cast("long").alias("n_covered"))
    leaked = covered.where(F.col("n_covered") >= F.least(F.lit(run), "n_item_words"))
    return leaked.select("doc_id", "text_key", "item_id", "n_covered", "n_item_words")


def drop(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows."""
    bad = staged(contaminated(docs, benchmark).select("doc_id", "text_key").distinct(), "leaks")
    bad = bad.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    rows = docs.withColumn("__text_key", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key"))
    return rows.join(bad, same, "left_anti").select(*docs.columns)

"""Personal data in texts: fixed forms, and further identifiers found by bootstrapping on their contexts.

Base: emails, IPv4 addresses, card numbers and phone numbers by their forms, leftmost and
non-overlapping per kind, in whole texts, as code point offsets (end exclusive).

Bootstrapping: the base spans are seeds.  A seed, and every other identifier-like word
(``CANDIDATE``), has two lexical patterns: the two words before it, and the words on both
sides, with case folded and digits as 0.  Patterns and instances form a graph.  In each round
a pattern's confidence for a kind is the share of its distinct instances that are known to be
of that kind; instances without a kind whose shape fits (``_fits``) get one where the
confidences of their trusted patterns, taken as independent, leave little doubt.  New instances count as
known in the next round.  All places of an instance that got a kind are added to the base spans.

Null or empty text: no spans.  Null and repeated doc_ids and repeated rows are results of
their own; for the graph, copies of a text count once, since it holds distinct pairs.  Equal
confidences go to the kind that is listed first.  No documents: no rows.  Other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tickloom.llm.store import staged, to_arrow
from tickloom.session import BROADCAST_ROWS

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: A pattern is trusted from so many known instances, and from this share of all its instances.
SUPPORT, CONFIDENCE = 8, 0.5
#: An instance is taken from this joint confidence.
ACCEPT = 0.8
ROUNDS = 5
#: Characters of a candidate, and of its context on the left and right.
LENGTHS, LEFT, RIGHT = (4, 64), 64, 32

# The forms, without the backtracking that would make them quadratic on long runs.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){12,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_EDGES = r"""\s"'=:;,!?()\[\]{}<>|&*$\\`~^"""
#: A run of characters other than space and brackets that holds a digit or @; more runs that begin with a digit may follow after a space.
CANDIDATE = re.compile(rf"(?<![^{_EDGES}])[^{_EDGES}0-9@]*+[0-9@][^{_EDGES}]*+(?: \(?[0-9][^{_EDGES}]*+)*+")
_TRIM = ".-/%_#"
_DIGIT = re.compile("[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    low, at = 0, text.find("@")
    while at >= 0:
        own = _LOCAL.match(text[low:at][::-1])
        rest = _DOMAIN.match(text, at + 1) if own else None
        if rest:
            yield at - own.end(), rest.end()
        low = rest.end() if rest else at + 1
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    found = [(EMAIL, a, b) for a, b in _emails(text)]
    found += [(IP, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m.group()))
        if len(digits) <= 19 and luhn(digits):
            found.append((CARD, m.start(), m.end()))
    found += [(PHONE, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]
    return found


def _fits(value: str) -> int:
    """Which kinds an instance may be of, as bits."""
    digits = len(_DIGIT.findall(value))
    bits = (1 << EMAIL) * ("@" in value and value.strip("@") != "")
    bits |= (1 << IP) * (value.count(".") >= 3 and digits >= 4 and digits + value.count(".") == len(value))
    return bits | (1 << CARD) * (12 <= digits <= 19) | (1 << PHONE) * (6 <= digits <= 15)


def _hash(*parts: str) -> int:
    value = xxhash.xxh3_64_intdigest("\0".join(parts))
    return value - (1 << 64) if value >> 63 else value


def _word(word: str) -> str:
    return _DIGIT.sub("0", word.lower())


def _patterns(text: str, start: int, end: int) -> list[int]:
    before = text[max(0, start - LEFT) : start].split()
    after = text[end : end + RIGHT].split()
    one, two = (_word(before[-k]) if len(before) >= k else "" for k in (1, 2))
    return [_hash("before", two, one), _hash("around", one, _word(after[0]) if after else "")]


def candidates(text: str, known: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds and other identifier-like words, which no seed overlaps, with their patterns."""
    places = [(a, b, kind) for kind, a, b in known]
    taken = sorted((a, b) for _, a, b in known)
    at = reach = 0
    for m in CANDIDATE.finditer(text):
        whole = m.group()
        start, end = m.start() + len(whole) - len(whole.lstrip(_TRIM)), m.end() - len(whole) + len(whole.rstrip(_TRIM))
        while at < len(taken) and taken[at][0] < end:
            reach, at = max(reach, taken[at][1]), at + 1
        if start >= reach and LENGTHS[0] <= end - start <= LENGTHS[1]:
            places.append((start, end, None))
    out = []
    for start, end, kind in places:
        value = "".join(text[start:end].lower().split())
        out.append({"start": start, "end": end, "instance": _hash(value), "kind": kind, "fits": _fits(value), "patterns": _patterns(text, start, end)})
    return out


# scanning texts

_SPAN = StructType([StructField("kind", IntegerType()), StructField("start", LongType()), StructField("end", LongType())])
_PLACE = StructType(
    [StructField("start", LongType()), StructField("end", LongType()), StructField("instance", LongType()), StructField("kind", IntegerType()), StructField("fits", IntegerType()), StructField("patterns", ArrayType(LongType()))]
)
_COUNTS = [f"n_{k}" for k in KINDS]


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = [pa.field(c, pa.int64()) for c in _COUNTS]
    more = to_arrow(StructType([StructField("base_sha256", StringType()), StructField("base", ArrayType(_SPAN)), StructField("places", ArrayType(_PLACE))]))
    for whole in batches:
        for first in range(0, whole.num_rows, 512):
            batch = whole.slice(first, 512)
            found, digests, places = [], [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                found.append(base(text))
                digests.append(hashlib.sha256(_listed(found[-1]).encode()).hexdigest())
                places.append(candidates(text, found[-1]))
            numbers = [pa.array([sum(s[0] == k for s in spans) for spans in found], pa.int64()) for k in range(len(KINDS))]
            spans = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in found], more[1].type)
            columns = [batch.column(0), batch.column(1), *numbers, pa.array(digests), spans, pa.array(places, more[2].type)]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([batch.schema.field(0), batch.schema.field(1), *counts, *more]))


def scan(docs: DataFrame) -> DataFrame:
    """Base spans and places of identifier-like words, a stored row per row of ``docs``."""
    schema = StructType(
        [StructField("at", LongType()), StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [StructField(c, LongType()) for c in _COUNTS]
        + [StructField("base_sha256", StringType()), StructField("base", ArrayType(_SPAN)), StructField("places", ArrayType(_PLACE))]
    )
    rows = docs.select(F.monotonically_increasing_id().alias("at"), "doc_id", F.col("text").cast("string"))
    return staged(rows.mapInArrow(_scan, schema), "scanned")


# the graph


def edges(scanned: DataFrame) -> DataFrame:
    """(pattern, instance, fits, kind): distinct pairs; ``kind`` is null where it is not known."""
    places = scanned.select(F.inline("places")).select("instance", "kind", "fits", F.explode("patterns").alias("pattern"))
    pairs = staged(places.groupBy("pattern", "instance").agg(F.min("kind").alias("kind"), F.bit_or("fits").alias("fits")), "pairs")
    # A value that is a seed anywhere is one everywhere.
    seeds = pairs.where("kind IS NOT NULL").groupBy("instance").agg(F.min("kind").alias("seed"))
    return pairs.where("kind IS NULL").join(_small(seeds), "instance", "left").select("pattern", "instance", "fits", F.col("seed").alias("kind")).unionByName(pairs.where("kind IS NOT NULL").select("pattern", "instance", "fits", "kind"))


def _small(df: DataFrame) -> DataFrame:
    """``df`` stored, and broadcast if it has few rows."""
    df = staged(df, "small")
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def trusted(graph: DataFrame) -> DataFrame:
    """(pattern, of, confidence) of the trusted patterns."""
    shares = [(F.count_if(F.col("kind") == k) / F.count("*")).alias(f"c{k}") for k in range(len(KINDS))]
    known = [F.count_if(F.col("kind") == k).alias(f"k{k}") for k in range(len(KINDS))]
    per = graph.groupBy("pattern").agg(*shares, *known)
    best = F.greatest(*(F.col(f"c{k}") for k in range(len(KINDS))))
    of = F.coalesce(*(F.when(F.col(f"c{k}") == best, k) for k in range(len(KINDS))))
    support = F.coalesce(*(F.when(of == k, F.col(f"k{k}")) for k in range(len(KINDS))))
    return per.where((best >= CONFIDENCE) & (support >= SUPPORT)).select("pattern", of.alias("of"), best.alias("confidence"))


def accepted(graph: DataFrame, patterns: DataFrame) -> DataFrame:
    """(instance, found): instances that trusted patterns give a kind to."""
    fits = F.expr("(fits & shiftleft(1, of)) != 0")
    doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))
    per = graph.where("kind IS NULL").join(patterns, "pattern").where(fits).groupBy("instance", "of").agg((1 - F.exp(doubt)).alias("score"))
    best = per.groupBy("instance").agg(F.max(F.struct("score", (-F.col("of")).alias("of"))).alias("best"))
    return best.where(F.col("best.score") >= ACCEPT).select("instance", (-F.col("best.of")).alias("found"))


def discover(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame | None:
    """(instance, found) of all instances that got a kind; None if none did."""
    graph, total = staged(graph, "graph"), None
    for _ in range(rounds):
        new = _small(accepted(graph, _small(trusted(graph))))
        if new.isEmpty():
            break
        total = new if total is None else total.unionByName(new)
        graph = staged(graph.join(new, "instance", "left").select("pattern", "instance", "fits", F.coalesce("kind", "found").alias("kind")), "graph")
    return total


def _spans_text(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, the counts and the digest of the base spans, and all spans, for each row of ``docs``."""
    scanned = scan(docs)
    found = discover(edges(scanned), rounds)
    if found is None:
        return scanned.select("doc_id", *_COUNTS, "base_sha256", _spans_text(F.col("base")).alias("spans"))
    places = scanned.select("at", F.inline("places")).where("kind IS NULL").select("at", "start", "end", "instance")
    added = places.join(_small(found), "instance").groupBy(F.col("at").alias("__at")).agg(F.collect_list(F.struct(F.col("found").alias("kind"), "start", "end")).alias("__added"))
    joined = scanned.drop("places").join(_small(added), F.col("at") == F.col("__at"), "left")
    every = F.when(F.col("__added").isNull(), F.col("base")).otherwise(F.concat("base", "__added"))
    return joined.select("doc_id", *_COUNTS, "base_sha256", _spans_text(every).alias("spans"))

"""Best-fit packing: tokenized documents into as few sequences of ``capacity`` tokens as possible.

Hierarchical: each task packs the pieces of its documents by best fit (largest first,
into the fullest bin that takes it) and passes on bins with at most ``slack`` free
tokens.  The other bins are items of the next round (one below three quarters is taken
apart into its pieces), in an eighth of the tasks and never more than ``round_items`` to a task, until one task has held all that are left
or a round merges less than a hundredth.  Only piece lengths and checksums move, not
token ids, unless they are asked for.

A document is its ids and ``end_id``.  Only a longer one is cut, into pieces of
``capacity``, of which the first may be shorter.  Null or empty text: the end id alone.
Null and repeated doc_ids are packed row by row.  Empty tables give no rows.  Other
columns of the input are not looked at.

Ids are those of the ``tokenizers`` file.  Where that file is plain byte-level BPE
whose ids follow its merges, the same ids come from ``tiktoken``, which is several
times as fast; texts that hold one of the file's added tokens, and any other file, go
through ``tokenizers`` itself.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tickloom.llm.store import lean, staged, to_arrow

CAPACITY = 1024
END_ID = 2
#: Free tokens of a bin that is passed on as full.
SLACK = 2
#: Underfull bins that one task merges.
ROUND_ITEMS = 50_000
#: Pieces that a task packs together.
LOCAL_ITEMS = 200_000
#: Tokens that a task holds together when ids are kept.
LOCAL_TOKENS = 8_000_000

#: The pre-tokenizer of byte-level BPE (a fixed value of the format).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_symbols() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {chr(b): b for b in shown}
    symbols |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    return symbols


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """Text to an array of ids, for the tokenizer file at ``path``."""
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, added = spec["model"], [t["content"] for t in spec.get("added_tokens", [])]

    def slow(text: str) -> np.ndarray:
        return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)

    pre = spec.get("pre_tokenizer") or {}
    plain = model.get("type", "BPE") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not model.get("byte_fallback") and not model.get("dropout")
    vocab = {token: i for token, i in model["vocab"].items() if token not in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    if not plain or not all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs)) or len(vocab) != 256 + len(pairs):
        return slow
    import tiktoken

    symbols = _byte_symbols()
    ranks = {bytes(symbols[c] for c in token): i for token, i in vocab.items()}
    fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(token in text for token in added):
            return slow(text)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items by bin: largest first, each into the fullest bin that still takes it."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_spaces, bins = 0, []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        fits = open_spaces >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            chosen = free[space].pop()
            if not free[space]:
                open_spaces ^= 1 << space
            bins[chosen].append(item)
        else:
            space, chosen = capacity, len(bins)
            bins.append([item])
        if space > size:
            free[space - size].append(chosen)
            open_spaces |= 1 << (space - size)
    return bins


def _piece_type(with_ids: bool) -> StructType:
    fields = [StructField(c, LongType()) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "offset")]
    return StructType(fields + [StructField("ids", ArrayType(IntegerType()))] * with_ids)


def _bin_type(with_ids: bool) -> StructType:
    return StructType([StructField("filled", LongType()), StructField("pieces", ArrayType(_piece_type(with_ids)))])


def _binned(pieces: pa.StructArray, counts: list[int], types: pa.Schema) -> pa.RecordBatch:
    """Bins of consecutive pieces, ``counts`` in each, with each piece's place in its bin."""
    names = [f.name for f in pieces.type]
    columns = dict(zip(names, pieces.flatten(), strict=True))
    lengths = columns["length"].to_numpy()
    ends = np.cumsum(lengths)
    edges = np.r_[0, np.cumsum(counts)]
    before = np.r_[0, ends][edges]
    columns["offset"] = pa.array(ends - lengths - np.repeat(before[:-1], counts), pa.int64())
    values = pa.StructArray.from_arrays(list(columns.values()), fields=list(types.field("pieces").type.value_type))
    listed = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values).cast(types.field("pieces").type)
    return pa.RecordBatch.from_arrays([pa.array(np.diff(before), pa.int64()), listed], schema=types)


def _packed_pieces(path: str, capacity: int, end_id: int, local_items: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, encode = to_arrow(_bin_type(with_ids)), encoder(path)
        struct = types.field("pieces").type.value_type
        columns: list[list] = [[] for _ in struct]

        def flush() -> pa.RecordBatch:
            bins = best_fit(columns[3], capacity)
            order = [i for b in bins for i in b]
            arrays = [pa.array([column[i] for i in order], f.type) for column, f in zip(columns, struct, strict=True)]
            for column in columns:
                column.clear()
            return _binned(pa.StructArray.from_arrays(arrays, fields=list(struct)), [len(b) for b in bins], types)

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                start, length = 0, (len(ids) - 1) % capacity + 1
                piece = 0
                while start < len(ids):
                    part = ids[start : start + length]
                    for column, value in zip(columns, (doc.as_py(), piece, start, length, zlib.crc32(part.tobytes()), 0, part.astype(np.int32)), strict=False):
                        column.append(value)
                    start, length, piece = start + length, capacity, piece + 1
            if len(columns[3]) >= (min(local_items, LOCAL_TOKENS // capacity) if with_ids else local_items):
                yield flush()
        if columns[3]:
            yield flush()

    return run


def _merged(capacity: int, with_ids: bool):
    """One round: bins are items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow(_bin_type(with_ids))
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        listed = rows.column("pieces").chunk(0)
        starts, filled = listed.offsets.to_numpy(), rows.column("filled").to_numpy()
        lengths = listed.values.field("length").to_numpy()
        # A bin that is far from full gives its pieces back, since smaller items fit better.
        whole = np.repeat(filled * 4 >= 3 * capacity, np.diff(starts))
        first = np.ones(len(lengths), bool)
        first[whole] = False
        first[starts[:-1]] = True
        edges = np.r_[np.flatnonzero(first), len(lengths)]
        bins = best_fit(np.add.reduceat(lengths, edges[:-1]).tolist(), capacity)
        order = np.concatenate([np.arange(edges[i], edges[i + 1]) for b in bins for i in b])
        counts = [int(sum(edges[i + 1] - edges[i] for i in b)) for b in bins]
        yield _binned(listed.values.take(pa.array(order)), counts, types)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    slack: int = SLACK,
    round_items: int = ROUND_ITEMS,
    local_items: int = LOCAL_ITEMS,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    path, schema = tokenizer or default_tokenizer(), _bin_type(with_ids)
    first = docs.select("doc_id", "text").mapInArrow(lean(_packed_pieces(path, capacity, end_id, local_items, with_ids)), schema)
    bins = staged(first, "bins")
    full = bins.where(F.col("filled") >= capacity - slack)
    left = bins.where(F.col("filled") < capacity - slack)
    count, tasks = left.count(), None
    while count > 1:
        tasks = -(-count // round_items) if tasks is None else max(-(-count // round_items), tasks // 8)
        merged = staged(left.repartition(max(1, tasks)).mapInArrow(lean(_merged(capacity, with_ids)), schema), "bins")
        full = full.union(merged.where(F.col("filled") >= capacity - slack))
        left = merged.where(F.col("filled") < capacity - slack)
        before, count = count, merged.count()
        if tasks <= 1 or count > 0.99 * before:
            break
        count = left.count()
    placed = full.union(left).withColumn("sequence_id", F.monotonically_increasing_id())
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return placed.select("sequence_id", F.explode("pieces").alias("p")).select("sequence_id", "p.*").select(*columns)


def sequences(docs: DataFrame, **options) -> DataFrame:
    """(sequence_id, ids): the packed token sequences themselves."""
    pieces = pack(docs, with_ids=True, **options)
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))

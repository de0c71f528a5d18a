"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

A window is ``width`` consecutive words of one document.  Each word covered by a
window whose word sequence also starts in a document with a smaller doc_id is
removed.  The removed windows of a document merge into maximal intervals.

Null or empty text: no words, nothing removed.  Null doc_id: the row stays whole
and removes nothing from others.  Rows that share a doc_id do not remove words from
each other (neither id is smaller) and all lose what a smaller id has.  Long texts
are hashed whole.  Extra columns pass through; a column named like one of the
results is replaced.  Two different windows meet in 64 bits with a chance of
2^-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tickloom.llm.store import lean, release, staged, to_arrow
from tickloom.llm.text import mix, tokens, windows

WIDTH = 13
#: Windows that a task compares among themselves before they are shuffled.
BUFFER_WINDOWS = 400_000

#: ``hash`` is null where it equals ``key``.
_ROWS = StructType([StructField(c, LongType()) for c in ("key", "doc_id", "hash")])


def _window_rows(width: int, buffer: int):
    """(key, doc_id, hash) once per document and window.

    Of a buffer's documents with the same window only the smallest goes on to be
    compared under that window's hash, so a window shared by very many documents
    sends a row per buffer; the larger ones are known to lose it and are spread.
    Rows keep the order of the documents, in which ids repeat and compress well.
    """

    def flush(hashes: list[np.ndarray], docs: list[np.ndarray]) -> pa.RecordBatch:
        h, d = np.concatenate(hashes), np.concatenate(docs)
        order = np.lexsort((d, h))
        by_hash, by_doc = h[order], d[order]
        new_hash = np.ones(len(h), bool)
        new_hash[1:] = by_hash[1:] != by_hash[:-1]
        once = new_hash.copy()
        once[1:] |= by_doc[1:] != by_doc[:-1]
        least = by_doc[np.flatnonzero(new_hash)][np.cumsum(new_hash) - 1]
        kept, known = np.zeros(len(h), bool), np.zeros(len(h), bool)
        kept[order[once]] = True
        known[order[by_doc > least]] = True
        h, d, known = h[kept], d[kept], known[kept]
        key = np.where(known, mix(h ^ mix(d.view(np.uint64))), h)
        arrays = [pa.array(key.view(np.int64)), pa.array(d), pa.array(h.view(np.int64), mask=~known)]
        return pa.RecordBatch.from_arrays(arrays, schema=to_arrow(_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, docs, held = [], [], 0
        for batch in batches:
            ids = batch.column(0)
            valid = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).cast(pa.int64()).to_numpy()
            for t in tokens(batch.column(1)):
                at, h = windows(t, width)
                keep = valid[t.row[at]]
                hashes.append(h[keep])
                docs.append(ids[t.row[at][keep]])
                held += len(h)
                if held >= buffer:
                    yield flush(hashes, docs)
                    hashes, docs, held = [], [], 0
                    release()
        if held:
            yield flush(hashes, docs)

    return run


def repeated_windows(docs: DataFrame, width: int = WIDTH, buffer: int = BUFFER_WINDOWS) -> DataFrame:
    """(doc_id, hash) of each window that also starts in a document with a smaller doc_id."""
    rows = docs.select("doc_id", "text").mapInArrow(lean(_window_rows(width, buffer)), _ROWS)
    first = F.min("doc_id").over(Window.partitionBy("key"))
    lost = rows.withColumn("first", first).where("hash IS NOT NULL OR doc_id > first")
    return lost.select("doc_id", F.coalesce("hash", "key").alias("hash"))


def _cut(width: int):
    def run(batch: pa.RecordBatch):
        """Kept text, counts and removed intervals of each row, given its repeated hashes."""
        flagged = batch.column("__hashes")
        n_words, n_removed, kept, spans = [], [], [], []
        for t in tokens(batch.column("text")):
            at, hashes = windows(t, width)
            cuts = np.searchsorted(t.row[at], np.arange(t.rows + 1) + t.first)
            bounds = t.bounds()
            for i in range(t.rows):
                lo, hi = bounds[i], bounds[i + 1]
                n_words.append(int(hi - lo))
                row_spans: list[dict] = []
                keep = np.ones(hi - lo, bool)
                if flagged[t.first + i].is_valid and len(flagged[t.first + i]):
                    mine = slice(cuts[i], cuts[i + 1])
                    bad = flagged[t.first + i].values.to_numpy().view(np.uint64)
                    hit = at[mine][np.isin(hashes[mine], bad)] - lo
                    if len(hit):
                        breaks = np.flatnonzero(hit[1:] > hit[:-1] + width) + 1
                        for a, b in zip(hit[np.r_[0, breaks]], hit[np.r_[breaks - 1, len(hit) - 1]] + width, strict=True):
                            keep[a:b] = False
                            row_spans.append({"start": int(a), "end": int(b)})
                n_removed.append(int((~keep).sum()))
                spans.append(row_spans)
                raw = t.data
                kept.append(b" ".join(raw[a:b].tobytes() for a, b in zip(t.start[lo:hi][keep].tolist(), t.end[lo:hi][keep].tolist(), strict=True)).decode())
        return n_words, n_removed, kept, spans

    return run


SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))
_RESULT = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType()), StructField("removed", SPANS)]


def remove_repeats(docs: DataFrame, width: int = WIDTH, buffer: int = BUFFER_WINDOWS) -> DataFrame:
    """``docs`` with n_words, n_removed, kept_text (kept words joined by one space) and removed (word intervals)."""
    flags = staged(repeated_windows(docs, width, buffer), "repeats")
    per_doc = flags.groupBy("doc_id").agg(F.collect_list("hash").alias("__hashes")).withColumnRenamed("doc_id", "__doc")
    others = [c for c in docs.columns if c not in {f.name for f in _RESULT}]
    joined = docs.select(*others).join(per_doc, docs["doc_id"] == per_doc["__doc"], "left").drop("__doc")
    schema = StructType([docs.schema[c] for c in others] + _RESULT)
    cut = _cut(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow(schema)
        for whole in batches:
            # Short runs of rows: kept words are Python objects for a moment.
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                results = [pa.array(x, types.field(len(others) + i).type) for i, x in enumerate(cut(batch))]
                yield pa.RecordBatch.from_arrays([batch.column(c).cast(types.field(c).type) for c in others] + results, schema=types)

    return joined.mapInArrow(lean(run), schema)

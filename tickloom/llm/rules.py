"""Quality rules with DataFrame functions only: base counts, then a log-likelihood ratio.

Words and word pairs are hashed to ``buckets``.  Their counts over the trusted target
(documents labelled as of good quality) and over the whole corpus are two smoothed
multinomials.  A document's mean, over its words and pairs, of the log-ratio of the two is
held against ``least``.  Log-ratios are whole millionths, so sums and the verdict do not hang
on the order of work.

Null text: no words, base_failed.  Null doc_id: judged, never in the target.  Repeated rows
are judged alike, and each counts in the corpus.  An empty target, or no labels: every ratio
is 0.  Extra columns are left out.  Long texts are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import staged
from tickloom.session import BROADCAST_ROWS

LEAST_WORDS, REPEAT_PERCENT = 50, 50
BUCKETS = 1 << 16
SMOOTHING = 1.0
#: Least mean log-ratio of a document that is kept.
LEAST = -0.1
MILLION = 1_000_000

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
WINDOW = 3


def words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _hashed(docs: DataFrame) -> DataFrame:
    """docs with the hashes of the words of the text."""
    return docs.withColumn("__hashes", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)))


def _features(hashes: Column, buckets: int) -> Column:
    """The buckets of words and of pairs of words."""
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)))
    pairs = F.when(F.size(hashes) < 2, F.array().cast("array<bigint>")).otherwise(
        F.zip_with(
            F.slice(hashes, F.lit(1), F.size(hashes) - 1),
            F.slice(hashes, F.lit(2), F.size(hashes) - 1),
            lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)),
        )
    )
    return F.concat(single, pairs)


def _base(docs: DataFrame) -> DataFrame:
    """docs with the base columns and the hashes of the words."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_SPACE)) != "")
    counted = _hashed(docs).withColumns(
        {
            "n_words": F.size("__hashes").cast("long"),
            "word_chars": F.char_length(F.translate(text, _SPACE, "")).cast("long"),
            "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, _SYMBOLS, ""))).cast("long"),
            "__lines": lines,
            "__grams": F.when(
                F.size("__hashes") >= WINDOW,
                F.zip_with(
                    F.slice("__hashes", F.lit(1), F.size("__hashes") - 2),
                    F.zip_with(F.slice("__hashes", F.lit(2), F.size("__hashes") - 2), F.slice("__hashes", F.lit(3), F.size("__hashes") - 2), lambda b, c: F.xxhash64(b, c)),
                    lambda a, bc: F.xxhash64(a, bc),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    )
    # Only texts with a repeated window sort their windows; equal ones are neighbours then.
    repeats = F.size(F.array_distinct("__grams")) < F.size("__grams")
    placed = F.sort_array(F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    sorted_ = counted.withColumns(
        {
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__placed": F.when(repeats, placed).otherwise(F.array().cast("array<struct<g:bigint,i:int>>")),
        }
    ).drop("__lines", "__grams")
    count = F.size("__placed")
    places = F.filter(
        F.transform(
            "__placed",
            lambda p, j: F.when(
                ((j > 0) & (F.get("__placed", j - 1)["g"] == p["g"])) | ((j < count - 1) & (F.get("__placed", j + 1)["g"] == p["g"])),
                p["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.aggregate(
        F.sort_array(places),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, i: F.struct((s["n"] + i + WINDOW - F.greatest(i, s["end"])).alias("n"), (i + WINDOW).alias("end")),
        lambda s: s["n"],
    )
    return sorted_.withColumn("n_repeat_words", covered.cast("long")).drop("__placed")


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, ratio): whole millionths of the log-ratio of target and corpus, of every bucket that occurs."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__good")).distinct()
    if good.count() <= BROADCAST_ROWS:
        good = F.broadcast(good)
    known = docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("__good"), "left")
    hashed = _hashed(known).select("__good", "__hashes")
    spread = hashed.select(F.col("__good").isNotNull().cast("long").alias("good"), F.explode(_features(F.col("__hashes"), buckets)).alias("bucket"))
    counts = staged(spread.groupBy("bucket").agg(F.sum("good").alias("target"), F.count("*").alias("raw")), "buckets")
    total = counts.agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).first()
    if not total["target"]:
        return counts.select("bucket", F.lit(0).cast("long").alias("ratio"))
    part = lambda name: (F.col(name) + SMOOTHING) / (total[name] + SMOOTHING * buckets)
    return counts.select("bucket", F.round(F.log(part("target") / part("raw")) * MILLION).cast("long").alias("ratio"))


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, least: float = LEAST) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, mean log-ratio (in whole millionths) and kept of every document."""
    ratios = F.broadcast(log_ratios(docs, labels, buckets))  # at most a row per bucket
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counted = _base(docs.select("doc_id", "text")).select(F.monotonically_increasing_id().alias("__row"), "doc_id", *base, _features(F.col("__hashes"), buckets).alias("__features"))
    spread = counted.select("__row", "doc_id", *base, F.explode_outer("__features").alias("bucket")).join(ratios, "bucket", "left")
    # A row's features are in one task, so what is shuffled is one row each.
    summed = spread.groupBy("__row", "doc_id", *base).agg(F.coalesce(F.sum("ratio"), F.lit(0)).alias("total"), F.greatest(F.count("bucket"), F.lit(1)).alias("n"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return summed.select(
        "doc_id",
        *base,
        failed.alias("base_failed"),
        (~failed & (F.col("total") >= F.lit(round(least * MILLION)) * F.col("n"))).alias("kept"),
        F.floor(F.col("total") / F.col("n")).alias("log_ratio"),
    )

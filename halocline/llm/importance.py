"""Quality selection by importance resampling.

Words and word pairs are hashed to buckets. Two generative models, the smoothed bucket counts of
the target texts and of all texts, give each document its log importance weight: the sum of the
log ratios of its n-grams. Adding Gumbel noise and keeping the k largest keys samples k
documents without replacement in proportion to the weights (Gumbel top-k).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import members
from .shared import stored, table
from .words import Block, blocks, mix, windows

BUCKETS = 1 << 14
SMOOTHING = 1.0
SEED = 20


def _grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of the words and the pairs of neighbouring words."""
    h = block.hashes()
    doc, room = block.doc_of_word(), block.room(2)
    both = np.concatenate([mix(h), mix(windows(h, 2)[room] ^ np.uint64(2))])
    return np.concatenate([doc, doc[room]]), (both % np.uint64(BUCKETS)).astype(np.int64)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Counts of all n-grams of a one-column table of texts. Each task sends BUCKETS sums at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                total += np.bincount(_grams(block)[1], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    rows = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows
    out = np.zeros(BUCKETS)
    out[rows["bucket"].to_numpy(int)] = rows["n"].to_numpy(float)
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    p = lambda c: np.log((c + smoothing) / (c.sum() + smoothing * len(c)))
    return p(target) - p(raw)


def weigh(docs: DataFrame, ratio: np.ndarray, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(doc_id, n_grams, log_weight, key): key is log_weight plus Gumbel noise that depends on doc_id and seed alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                doc, bucket = _grams(block)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.n_docs), pa.array(np.bincount(doc, minlength=block.n_docs)), pa.array(np.bincount(doc, ratio[bucket], block.n_docs).astype(float))], ["doc_id", "n_grams", "log_weight"]
                )

    scored = docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(work, "doc_id long, n_grams long, log_weight double")
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    return scored.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))


def kth_largest(df: DataFrame, key: str, k: int, exact_rows: int = 10_000, bins: int = 4096) -> float:
    """The k-th largest value: counts in bins narrow the range until exact_rows values or fewer are left to fetch."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    above = 0
    while True:
        part = df.where(F.col(key).between(low, high))
        step = (high - low) / bins
        if part.count() <= exact_rows or not step or low + step == low:
            values = sorted((r[0] for r in part.select(key).orderBy(F.desc(key)).limit(exact_rows).collect()), reverse=True)
            return values[min(k - above, len(values)) - 1]
        at = F.least(F.floor((F.col(key) - low) / step), F.lit(bins - 1))
        for r in sorted(part.groupBy(at.alias("b")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect(), key=lambda r: -r["b"]):
            if above + r["n"] >= k:
                low, high = r["lo"], r["hi"]
                break
            above += r["n"]


def select(docs: DataFrame, target_ids: DataFrame, share: float, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """One row for each row of docs: doc_id, n_grams, log_weight, key, kept: among the round(share * rows) largest keys.

    target_ids: one column of ids of the target texts, all of which are read. Null and empty texts have no n-grams and
    weight 0. Equal keys, as of repeated rows, are kept or not together; a null doc_id has noise of its own. No target
    text, or no rows, keeps what the noise says. N-grams of texts of any length are counted whole, and an empty table
    gives no rows. Further columns of docs are ignored.
    """
    ids = stored(target_ids.toDF(doc_id).where(F.col(doc_id).isNotNull()).distinct(), "targets")
    known = docs.select(doc_id, text).where(F.col(doc_id).isNotNull())
    # Target texts are counted where they are read: all that the filter lets pass, less the few that it lets pass wrongly. Only those are joined.
    wrong = stored(members(known.select(doc_id), doc_id, ids).distinct().join(ids.withColumn("_is", F.lit(True)), doc_id, "left").where("_is is null").select(doc_id), "wrong")
    passed = bucket_counts(members(known, doc_id, ids).select(text))
    less = bucket_counts(members(known, doc_id, wrong).join(wrong, doc_id).select(text))
    ratio = log_ratio(passed - less, bucket_counts(docs.select(text)))
    scored = stored(weigh(docs, ratio, doc_id, text, seed), "weights")
    rows = scored.count()
    k = round(share * rows)
    least = kth_largest(scored, "key", k) if k else float("inf")
    return scored.withColumn("kept", F.col("key") >= F.lit(least))


def query(spark, sf_dir: str) -> DataFrame:
    """Target: the documents labelled good and not toxic; as large a share is kept as the good have among the labelled."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    share = labels.where("quality is not null").agg(F.avg(F.when(F.col("quality") == 1, 1.0).otherwise(0.0))).first()[0] or 0.0
    return select(table(spark, sf_dir, "documents"), labels.where(good).select("doc_id"), share)

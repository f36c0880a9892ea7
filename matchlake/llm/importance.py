"""Quality classifier by importance resampling of hashed n-grams.

Two bag-of-n-gram models are counted over hashed words and word pairs: the raw one over
all documents, the target one over all documents that are labelled good. The log importance weight
of a document is the sum, over its n-grams, of the log ratio of the two models. Gumbel noise from a
hash of the document is added and the highest scores are kept, which samples without
replacement in proportion to the weights. How many are kept is given, or calibrated on a fifth of the good
documents, which the target model doesn't see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm import textscan
from matchlake.llm.common import Scratch, bounded, number_rows

BITS = 17
CHUNK = 2048
#: Groups of input tasks whose counts are added first.
DEALS = 512
HOLDOUT = 5
KEEP_GOOD = 0.95
#: Added to each bucket's count, times its share of the raw model.
PRIOR = 1.0


def _buckets(column: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(texts, number of the text, bucket) of all words and word pairs, by runs of texts."""
    shift = np.uint64(64 - bits)
    for _, data, offsets in textscan.runs(column):
        doc, hashes = textscan.words(data, offsets, textscan.LOWER)
        first, pairs = textscan.windows(doc, hashes, 2)
        both = np.concatenate([hashes, textscan.mix(pairs + np.uint64(1))])
        yield len(offsets) - 1, np.concatenate([doc, doc[first]]), (both >> shift).astype(np.int64)


def _models(docs: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each bucket over all documents, and over those with ``_target``."""
    size = 1 << bits
    rows = -(-size // CHUNK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(rows * CHUNK, np.int64), np.zeros(rows * CHUNK, np.int64)
        for batch in batches:
            target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            at = 0
            for n, doc, bucket in _buckets(batch.column(0), bits):
                raw += np.bincount(bucket, minlength=rows * CHUNK)
                good += np.bincount(bucket[target[at : at + n][doc]], minlength=rows * CHUNK)
                at += n
        ends = pa.array(np.arange(rows + 1, dtype=np.int32) * CHUNK)
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (raw, good)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows)), *lists], names=["chunk", "raw", "good"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        sums = {x: [np.stack(frame[x].to_list()).sum(axis=0)] for x in ("raw", "good")}
        return pd.DataFrame({"chunk": frame["chunk"].iloc[:1].to_list(), **sums})

    schema = "chunk long, raw array<long>, good array<long>"
    parts = docs.select("text", "_target").mapInArrow(count, schema)
    # in two steps, so that no task stacks the counts of all input tasks
    dealt = parts.withColumn("deal", F.spark_partition_id() % DEALS)
    some = dealt.groupBy("chunk", "deal").applyInPandas(lambda frame: add(frame.drop(columns="deal")), schema)
    sums = some.groupBy("chunk").applyInPandas(add, schema)
    raw, good = np.zeros(rows * CHUNK), np.zeros(rows * CHUNK)
    for row in sums.toLocalIterator():  # as many numbers as there are buckets
        place = slice(row.chunk * CHUNK, (row.chunk + 1) * CHUNK)
        raw[place], good[place] = row.raw, row.good
    return raw[:size], good[:size]


def log_ratios(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw), smoothed towards the raw model."""
    p_raw = (raw + 1.0) / (raw.sum() + len(raw))
    strength = PRIOR * max(1, (raw > 0).sum())
    p_good = (good + strength * p_raw) / (good.sum() + strength)
    return np.log(p_good) - np.log(p_raw)


def importance_scores(docs: DataFrame, labels: DataFrame, bits: int = BITS, seed: int = 11) -> DataFrame:
    """Per row of ``docs``: doc_id, log_weight, score (with Gumbel noise), both NULL without words.

    ``_held`` marks the good documents that were kept out of the target model.
    """
    good = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_good_id"))
        .agg(F.min((F.col("quality") > 0) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).alias("_good"))
        .where("_good")
        .withColumn("_held", F.pmod(F.xxhash64("_good_id", F.lit(seed)), F.lit(HOLDOUT)) == 0)
        .drop("_good")
    )
    marked = docs.select("doc_id", "text").join(bounded(good), F.col("doc_id") == F.col("_good_id"), "left")
    # labelled good, and not held out
    target = F.coalesce(~F.col("_held"), F.lit(False))
    ratios = log_ratios(*_models(marked.withColumn("_target", target), bits))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, seen = [np.zeros(0)], [np.zeros(0, bool)]
            for n, doc, bucket in _buckets(batch.column(1), bits):
                sums.append(np.bincount(doc, weights=ratios[bucket], minlength=n))
                seen.append(np.bincount(doc, minlength=n) > 0)
            weight = pa.array(np.concatenate(sums), mask=~np.concatenate(seen))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), weight, batch.column(2), batch.column(3)], names=["doc_id", "log_weight", "_mark", "_held"]
            )

    slim = marked.select("doc_id", "text", F.xxhash64("text").alias("_mark"), F.coalesce("_held", F.lit(False)).alias("_held"))
    weighed = slim.mapInArrow(weigh, "doc_id long, log_weight double, _mark long, _held boolean")
    # 53 bits of a hash, strictly between 0 and 1
    unit = (F.shiftrightunsigned(F.xxhash64("doc_id", "_mark", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(2.0**53)
    return weighed.withColumn("score", F.col("log_weight") - F.log(-F.log(unit)))


def resample(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    keep_good: float = KEEP_GOOD,
    bits: int = BITS,
    seed: int = 11,
) -> DataFrame:
    """Per row of ``docs``: doc_id, log_weight, score, kept.

    Of all n rows the highest scores are kept: ``round(share * n)`` of them, or by default as many as
    it takes to keep ``keep_good`` of the good documents that the target model hasn't seen (all,
    without such documents). NULL and empty texts have no weight and are never kept. Equal scores
    (rows of one id and text) are ordered by id and text hash. Without any good label the weights are
    alike up to noise. A labelled document is good if all its labels say so. Extra columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    scored = scratch.save(importance_scores(docs, labels, bits, seed), "scores")
    ranked = number_rows(scored, [F.col("score").desc_nulls_last(), "doc_id", "_mark"], scratch, "ranks")
    if share is not None:
        last = round(share * scored.count()) - 1
    else:
        held = ranked.where("_held AND score IS NOT NULL")
        last = held.agg(F.percentile_approx("_index", keep_good, 100_000)).first()[0]
    kept = F.col("score").isNotNull()
    if last is not None:
        kept = kept & (F.col("_index") <= last)
    return ranked.select("doc_id", "log_weight", "score", kept.alias("kept"))

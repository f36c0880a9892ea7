"""Quality rules whose cutoffs are certified to reject few good documents.

Every rule rejects what lies beyond a cutoff of one integer measure. All labelled documents
are the holdout, as nothing is trained on them. Per stratum and rule the cutoffs of a fixed
grid are tested from the mildest to the strictest: the exact binomial probability of seeing so
few rejected good documents, were the true rate ``alpha / rules``, has to be at most
``delta / (strata * rules)``. The first cutoff that fails ends its sequence, so no further
correction is due inside it (fixed-sequence testing), and Bonferroni covers the sequences:
with probability 1 - delta no stratum loses more than ``alpha`` of its good documents. Among
the certified cutoffs the one that serves best is taken: most rejected bad documents less
``good_weight`` times the rejected good ones, and none if that isn't positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm import textscan
from matchlake.llm.common import Scratch, bounded

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
ALPHA, DELTA, GOOD_WEIGHT = 0.02, 0.05, 10
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: measure: (SQL, +1 rejects from the cutoff up, -1 down, cutoffs from mild to strict)
RULES = {
    "symbols_per_1000_words": ("n_symbols * 1000 div n_words", 1, [2000, 1000, 700, 500, 350, 250, 180, 120, 90, 60, 40, 25, 15]),
    "dup_lines_per_1000_words": ("n_dup_lines * 1000 div n_words", 1, [200, 140, 100, 70, 50, 35, 25, 18, 12, 8, 5, 3, 1]),
    "repeats_per_1000_words": ("n_repeat_words * 1000 div n_words", 1, [200, 180, 160, 140, 120, 100, 80, 60, 45, 30, 20, 10]),
    "long_words_tenths": ("word_chars * 10 div n_words", 1, [400, 300, 200, 150, 120, 110, 100, 95, 90, 85, 80, 75, 70]),
    "short_words_tenths": ("word_chars * 10 div n_words", -1, [10, 15, 20, 23, 26, 29, 32, 35, 38, 40, 42, 44, 46]),
    "few_words": ("n_words", -1, [10, 12, 15, 18, 22, 26, 32, 40, 50, 60, 75, 90]),
}
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_PREFIX = "_q_"


def text_counts(column: pa.Array) -> list[pa.Array]:
    """``COUNTS`` of every text, from the whole text."""
    parts: list[list[np.ndarray]] = [[] for _ in COUNTS]
    for _, data, offsets in textscan.runs(column):
        n = len(offsets) - 1
        doc, starts, ends = textscan.word_ranges(data, offsets)
        n_words = np.bincount(doc, minlength=n)
        solid = ~textscan.SPACE[data]
        chars = textscan.per_text(solid & ((data & 0xC0) != 0x80), offsets)
        symbols = textscan.per_text(_SYMBOL[data], offsets)

        line_doc, a, b = textscan.line_ranges(data, offsets)
        keys = textscan.mix(textscan.hash_ranges(data, a, b) + textscan.mix(line_doc.astype(np.uint64)))
        _, first = np.unique(keys, return_index=True)
        dup_lines = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[first], minlength=n)

        at, grams = textscan.windows(doc, textscan.hash_ranges(data, starts, ends), 5)
        grams = textscan.mix(grams + textscan.mix(doc[at].astype(np.uint64)))
        ranked = np.sort(grams)
        again = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
        covered = np.zeros(len(doc) + 6, np.int64)
        if len(again):
            place = np.minimum(np.searchsorted(again, grams), len(again) - 1)
            hit = at[again[place] == grams]
            covered[hit] += 1
            covered[hit + 5] -= 1
        repeats = np.bincount(doc[np.cumsum(covered)[: len(doc)] > 0], minlength=n)
        for part, x in zip(parts, (n_words, chars, symbols, dup_lines, repeats), strict=True):
            part.append(x)
    return [pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)) for x in parts]


def with_counts(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the ``COUNTS`` of ``text_col`` under ``_q_`` names."""
    kept = [x for x in docs.columns if keep_text or x != text_col]
    schema = ", ".join(
        [f"`{x}` {docs.schema[x].dataType.simpleString()}" for x in kept]
        + [f"{_PREFIX}{x} bigint" for x in COUNTS]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(x)) for x in kept]
            yield pa.RecordBatch.from_arrays(
                columns + text_counts(batch.column(batch.schema.get_field_index(text_col))),
                names=kept + [_PREFIX + x for x in COUNTS],
            )

    return docs.mapInArrow(scan, schema)


def base_failed(n_words: str = "n_words", repeats: str = "n_repeat_words") -> Column:
    """Fewer than 10 words, or over 20% of them in repeated 5-word windows."""
    return F.expr(f"{n_words} < {MIN_WORDS} OR 100 * {repeats} > {MAX_REPEAT_PERCENT} * {n_words}")


def tail(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` of ``n`` events of probability ``p``, exact up to rounding."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log((n - i[:-1]) / (i[:-1] + 1.0)))])
    logs = logs + i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def choose(grid: list[int], good: list[int], bad: list[int], n: int, alpha: float, delta: float, weight: float) -> int | None:
    """The cutoff to use, given rejected good and bad holdout documents by cutoff."""
    best, gain = None, 0.0
    for cutoff, g, b in zip(grid, good, bad, strict=True):
        if not n or tail(g, n, alpha) > delta:
            break
        if b - weight * g > gain:
            best, gain = cutoff, b - weight * g
    return best


def _measure(sql: str) -> str:
    return "CASE WHEN n_words > 0 THEN " + sql + " END"


def calibrate(
    counts: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    stratum_col: str = "lang",
    alpha: float = ALPHA,
    delta: float = DELTA,
    good_weight: float = GOOD_WEIGHT,
) -> DataFrame:
    """One row per stratum with holdout documents: stratum and a cutoff (or NULL) per rule.

    ``counts`` has ``id_col``, ``stratum_col`` and ``COUNTS``. All labelled documents that
    pass the base rules count. Repeated labels of a document are taken as good if one is;
    labels without id or quality are left out. A NULL stratum is a stratum like others.
    """
    marks = (
        labels.where(f"`{id_col}` IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col(f"`{id_col}`").alias("_label_id"))
        .agg((F.max("quality") > 0).alias("_good"))
    )
    held = counts.where(~base_failed()).join(marks, F.col(f"`{id_col}`") == F.col("_label_id"))
    stratum = F.coalesce(F.concat(F.lit("="), F.col(f"`{stratum_col}`").cast("string")), F.lit(""))
    sums = [F.count_if("_good").alias("n")]
    for rule, (sql, sign, grid) in RULES.items():
        side = ">=" if sign > 0 else "<="
        for i, cutoff in enumerate(grid):
            hit = F.expr(f"coalesce(({_measure(sql)}) {side} {cutoff}, false)")
            sums.append(F.count_if(hit & F.col("_good")).alias(f"{rule}_g{i}"))
            sums.append(F.count_if(hit & ~F.col("_good")).alias(f"{rule}_b{i}"))
    tallies = held.groupBy(stratum.alias("stratum")).agg(*sums)
    strata = tallies.count()

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {"stratum": frame["stratum"]}
            for rule, (_, _, grid) in RULES.items():
                out[rule] = [
                    choose(
                        grid,
                        [row[f"{rule}_g{i}"] for i in range(len(grid))],
                        [row[f"{rule}_b{i}"] for i in range(len(grid))],
                        row["n"],
                        alpha / len(RULES),
                        delta / (strata * len(RULES)),
                        good_weight,
                    )
                    for row in frame.to_dict("records")
                ]
            yield pd.DataFrame(out).astype({x: "Int64" for x in RULES})

    schema = "stratum string, " + ", ".join(f"{x} long" for x in RULES)
    return tallies.mapInPandas(decide, schema)


def judged(counts: DataFrame, cutoffs: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """``counts`` with ``base_failed`` and ``kept``; strata without cutoffs only have the base rules."""
    limits = cutoffs.select(
        F.col("stratum").alias("_stratum"), *[F.col(x).alias(f"_c_{x}") for x in RULES]
    )
    stratum = F.coalesce(F.concat(F.lit("="), F.col(f"`{stratum_col}`").cast("string")), F.lit(""))
    rejected = " OR ".join(
        f"coalesce(({_measure(sql)}) {'>=' if sign > 0 else '<='} _c_{rule}, false)"
        for rule, (sql, sign, _) in RULES.items()
    )
    joined = counts.join(bounded(limits, 10_000), stratum == F.col("_stratum"), "left")
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~F.expr(rejected))
        .drop("_stratum", *[f"_c_{x}" for x in RULES])
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", **options) -> DataFrame:
    """Per document: doc_id, the stratum, ``COUNTS``, base_failed, kept; repeated rows stay.

    NULL and empty texts have no words and fail the base rule. Without labels only the base
    rules act. Extra columns are not read. The counts are written once and read twice.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    scanned = with_counts(docs.select("doc_id", F.col(f"`{stratum_col}`"), "text"), keep_text=False)
    renamed = scanned.withColumnsRenamed({_PREFIX + x: x for x in COUNTS})
    counts = scratch.save(renamed, "counts")
    cutoffs = scratch.save(calibrate(counts, labels, stratum_col=stratum_col, **options), "cutoffs")
    return judged(counts, cutoffs, stratum_col)


def filter_quality(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Texts are scanned a second time instead of being moved: nothing but the labelled counts
    is shuffled. Column names that begin with ``_q_`` are reserved.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    slim = with_counts(docs.select("doc_id", F.col(f"`{stratum_col}`"), "text"), keep_text=False)
    slim = slim.withColumnsRenamed({_PREFIX + x: x for x in COUNTS})
    cutoffs = scratch.save(calibrate(slim, labels, stratum_col=stratum_col, **options), "cutoffs")
    full = with_counts(docs)
    names = [F.col(_PREFIX + x).alias(x) for x in COUNTS]
    row = F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("_row")
    verdicts = judged(full.select(row, F.col(f"`{stratum_col}`").alias("_lang"), *names), cutoffs, "_lang")
    return verdicts.where("kept").select(*[F.col("_row")[x].alias(x) for x in docs.columns])

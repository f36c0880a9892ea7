"""Mixing sources to target weights by balanced (cube) sampling.

Every source has a target in words. A unit of a source is taken ``floor(target / size of the
source)`` times for sure, and once more with the fractional rest as inclusion probability. Which
units get the extra copy is settled by the cube method: the vector of fractional probabilities
moves at random along null-space directions of the constraints (sum of words, number of
documents) until each unit is at 0 or 1, so both totals stay as they are. Of three units one
is settled by each move, so a block of any size ends with at most two unsettled units; those of
all blocks meet in the next round. The last dozen units of a source are the landing problem: all their
outcomes are compared and the one nearest to the target is taken.

Blocks have a bounded number of units and are dealt by a hash of the content, so a source of any
size is worked on by many tasks, and reruns agree on any cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm import textscan
from matchlake.llm.common import Scratch, bounded, pack, replace_columns

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
UNITS_PER_BLOCK = 2_000
#: Units left for the landing problem beside the two that the flight can't settle.
LANDING = 12
#: Units by which landing may miss the expected number of documents.
NEAR = 4
EDGE = 1e-9


def word_sizes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text but with ``_size`` (words; 0 for NULL) and ``_mark`` (text hash)."""
    kept = [x for x in docs.columns if x != text_col]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"`{x}` {kinds[x]}" for x in kept] + ["_size bigint", "_mark bigint"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.zeros(0, np.int64)]
            texts = batch.column(batch.schema.get_field_index(text_col))
            for _, data, offsets in textscan.runs(texts):
                doc, _, _ = textscan.word_ranges(data, offsets)
                sizes.append(np.bincount(doc, minlength=len(offsets) - 1).astype(np.int64))
            columns = [batch.column(batch.schema.get_field_index(x)) for x in kept + ["_mark"]]
            yield pa.RecordBatch.from_arrays(
                [*columns[:-1], pa.array(np.concatenate(sizes)), columns[-1]],
                names=[*kept, "_size", "_mark"],
            )

    return docs.withColumn("_mark", F.xxhash64(f"`{text_col}`")).mapInArrow(scan, schema)


def source_targets(
    sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: float = MAX_REPEATS
) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.

    Sources in code point order, NULL last, weigh ``weights``, repeating, and share the sum of
    all sizes. A target stops at ``max_repeats`` times the size of its source and the excess is
    shared by weight among the others until none is above. In order of size by weight the capped
    sources come first, so the level of the rest is the largest quotient of what is left.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(float(x)) for x in weights])
    weighed = sources.withColumn(
        "_weight", listed[((F.row_number().over(order) - 1) % len(weights)).cast("int")]
    ).withColumn("_cap", F.col("source_size") * float(max_repeats))
    by_need = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before, all_rows = by_need.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    share = F.sum("_weight").over(all_rows) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    return (
        weighed.withColumn("_level", left / share)
        .withColumn("_level", F.max("_level").over(all_rows))
        .withColumn("target", F.least(F.col("_cap"), F.col("_level") * F.col("_weight")))
        .drop("_weight", "_cap", "_level")
    )


def flight(sizes: np.ndarray, counts: np.ndarray, chances: np.ndarray, rng: np.random.Generator, spare: int = 0) -> np.ndarray:
    """Move ``chances`` to 0 or 1, keeping the sums of chance * size and of chance * count.

    At most two stay between 0 and 1, besides the last ``spare`` units, which aren't moved.
    """
    out = chances.astype(float).tolist()
    size, count = sizes.astype(float).tolist(), counts.astype(float).tolist()
    open_units = [i for i, p in enumerate(out) if EDGE < p < 1 - EDGE]
    waiting = iter(open_units[: max(0, len(open_units) - spare)])
    draws = iter(rng.random(len(out) + 1).tolist())
    active: list[int] = []
    while True:
        while len(active) < 3 and (i := next(waiting, None)) is not None:
            active.append(i)
        if len(active) == 3:
            a, b, c = active
            move = [
                size[b] * count[c] - size[c] * count[b],
                size[c] * count[a] - size[a] * count[c],
                size[a] * count[b] - size[b] * count[a],
            ]
            if not any(move):  # all alike: two of them can change places
                move = [count[b], -count[a], 0.0]
        elif len(active) == 2 and size[active[0]] * count[active[1]] == size[active[1]] * count[active[0]]:
            a, b = active
            move = [count[b], -count[a]]
        else:
            break
        top = max(abs(u) for u in move)
        move = [u / top for u in move]
        up = min((1 - out[i] if u > 0 else out[i]) / abs(u) for i, u in zip(active, move) if u)
        down = min((out[i] if u > 0 else 1 - out[i]) / abs(u) for i, u in zip(active, move) if u)
        step = up if next(draws) * (up + down) < down else -down
        for i, u in zip(active, move):
            p = out[i] + step * u
            out[i] = 0.0 if p <= EDGE else 1.0 if p >= 1 - EDGE else p
        active = [i for i in active if 0.0 < out[i] < 1.0]
    return np.array(out)


def land(sizes: np.ndarray, counts: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Settle the last few units: all outcomes are compared.

    Those that keep the number of documents within ``NEAR`` of its expectation come first, and of
    them the one whose words are nearest: one long document weighs as much as a few short ones.
    """
    left = np.flatnonzero((chances > 0) & (chances < 1))
    out = chances.copy()
    if not len(left):
        return out
    outcomes = (np.arange(2 ** len(left))[:, None] >> np.arange(len(left)) & 1).astype(float)
    off = outcomes - chances[left]
    documents = np.abs(off @ counts[left])
    best = np.lexsort((documents, np.abs(off @ sizes[left]), documents > NEAR * counts[left].max()))[0]
    out[left] = outcomes[best]
    return out


def _settle(seed: int, last: bool):
    def settle(units: pd.DataFrame) -> pd.DataFrame:
        # the largest fly first; those left to land are of many sizes, from the median down
        units["_words"] = units["_size"] * units["_n"]
        units = units.sort_values(["_words", "_order", "_mark"], ascending=[False, True, True], kind="stable")
        landing = np.unique(np.linspace(len(units) // 2, len(units) - 1, LANDING).astype(int))
        flying = np.setdiff1d(np.arange(len(units)), landing)
        units = units.iloc[np.concatenate([flying, landing])].reset_index(drop=True).drop(columns="_words")
        rng = np.random.default_rng([seed, int(units["_block"].iloc[0]) % 2**32, len(units)])
        chances = flight(units["_size"].to_numpy() * units["_n"].to_numpy(), units["_n"].to_numpy(), units["_chance"].to_numpy(), rng, LANDING if last else 0)
        if last:
            chances = land(units["_size"].to_numpy(float) * units["_n"].to_numpy(), units["_n"].to_numpy(float), chances)
        units["_chance"] = chances
        return units

    return settle


def plan_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_repeats: float = MAX_REPEATS,
    seed: int = 17,
    units_per_block: int = UNITS_PER_BLOCK,
) -> DataFrame:
    """How often each unit is taken: doc_id, source, _size, _mark, _n, source_size, target, copies.

    A unit is all rows of one doc_id, source and text (``_n`` of them); each of its rows is
    taken ``copies`` times. NULL and empty texts have size 0. A source without any word has the
    target 0 and is taken 0 times.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sized = word_sizes(docs.select("doc_id", "source", "text"))
    units = scratch.save(
        sized.groupBy("doc_id", "source", "_size", "_mark").agg(F.count(F.lit(1)).alias("_n")), "units"
    )
    sources = units.groupBy("source").agg(
        F.sum(F.col("_size") * F.col("_n")).alias("source_size"), F.count(F.lit(1)).alias("_units")
    )
    targets = source_targets(sources, weights, max_repeats)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = scratch.save(
        targets.withColumn("_whole", F.floor(ratio + EDGE)).withColumn(
            "_part", F.greatest(ratio - F.col("_whole"), F.lit(0.0))
        ),
        "targets",
    )
    small = bounded(targets.withColumnRenamed("source", "_source"))
    open_units = (
        units.join(small, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source", "_whole", "source_size", "target")
        .where(f"_part > {EDGE} AND _part < 1 - {EDGE}")
        .withColumnRenamed("_part", "_chance")
        .withColumn("_order", F.xxhash64("doc_id", "_mark", F.lit(seed)))
    )
    names = ["doc_id", "source", "_size", "_mark", "_n", "_order", "_chance"]
    settled: list[DataFrame] = []
    most, level = targets.agg(F.max("_units")).first()[0] or 0, 0
    while most:
        last = most <= units_per_block
        blocks = F.lit(1) if last else F.ceil(F.col("_units") / units_per_block)
        dealt = open_units.withColumn("_block", F.pmod(F.xxhash64("_order", F.lit(level)), blocks))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
        moved = dealt.groupBy("source", "_block").applyInPandas(_settle(seed + level, last), schema)
        moved = scratch.save(moved, f"round{level}")
        settled.append(moved.where("_chance = 0 OR _chance = 1").select(*names))
        if last:
            break
        rest = moved.where("_chance > 0 AND _chance < 1")
        counts = scratch.save(rest.groupBy("source").agg(F.count(F.lit(1)).alias("_units")), f"left{level}")
        most, level = counts.agg(F.max("_units")).first()[0] or 0, level + 1
        again = bounded(counts.withColumnRenamed("source", "_source"))
        open_units = (
            rest.drop("_units", "_block")
            .join(again, F.col("source").eqNullSafe(F.col("_source")))
            .drop("_source")
        )
    extra = None
    for frame in settled:
        part = frame.where("_chance = 1").select("doc_id", "source", "_size", "_mark")
        extra = part if extra is None else extra.unionByName(part)
    known = units.join(small, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "_part", "_units")
    if extra is None:
        return known.withColumnRenamed("_whole", "copies")
    extra = extra.select(*[F.col(x).alias(f"_x{x}") for x in extra.columns], F.lit(1).alias("_extra"))
    same = [F.col(x).eqNullSafe(F.col(f"_x{x}")) for x in ("doc_id", "source", "_size", "_mark")]
    joined = known.join(extra, same, "left")
    copies = (F.col("_whole") + F.coalesce(F.col("_extra"), F.lit(0))).cast("long")
    return joined.withColumn("copies", copies).drop("_whole", "_extra", *[f"_x{x}" for x in ("doc_id", "source", "_size", "_mark")])


def mix_table(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken (words, repeats counted)."""
    plan = plan_mix(docs, **options)
    rows = plan.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return rows.select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.col("copies")).alias("taken"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, all columns kept."""
    plan = plan_mix(docs, **options).where("copies > 0")
    plan = plan.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("_mark").alias("_text"), "copies"
    )
    rows = docs.select(
        pack(docs),
        F.col("doc_id").alias("_doc_id"),
        F.col("source").alias("_doc_source"),
        F.xxhash64("text").alias("_doc_mark"),
    )
    same = (
        F.col("_doc_id").eqNullSafe(F.col("_id"))
        & F.col("_doc_source").eqNullSafe(F.col("_source"))
        & (F.col("_doc_mark") == F.col("_text"))
    )
    taken = rows.join(plan, same).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return replace_columns(taken, "_row", [])

"""The refresh of all layers, from bronze documents to gold tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake import config
from matchlake.operators import gold, silver
from matchlake.operators.incremental import incremental_slice
from matchlake.operators.quality import KEYS, SEARCH, watch_quality
from matchlake.operators.staging import stage_matches
from matchlake.plans.catalog import PARTITION, Catalog
from matchlake.sources.bronze import latest_matches


class Model(NamedTuple):
    layer: str
    kind: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]


# In lineage order.
MODELS: dict[str, Model] = {
    "stg_matches": Model("staging", "view", ("raw_matches",), stage_matches),
    "fact_player_results": Model("silver", "incremental", ("stg_matches",), silver.player_results),
    "fact_traits": Model("silver", "incremental", ("fact_player_results",), silver.trait_facts),
    "fact_units": Model("silver", "incremental", ("fact_player_results",), silver.unit_facts),
    "unit_winrate": Model("gold", "table", ("fact_units",), gold.unit_winrate),
    "core_comp_winrate": Model("gold", "table", ("fact_units", "fact_traits"), gold.core_comp_winrate),
    "item_combo_winrate": Model("gold", "table", ("fact_units",), gold.item_combo_winrate),
}
MODES = ("daily", "staging", "silver", "gold", "full")


def select_models(layers: list[str], ancestors: bool = False) -> list[str]:
    """Models of the layers in lineage order, with all they build upon if asked for."""
    chosen = {name for name, model in MODELS.items() if model.layer in layers}
    if ancestors:
        for name in reversed(MODELS):
            if name in chosen:
                chosen.update(need for need in MODELS[name].needs if need in MODELS)
    return [name for name in MODELS if name in chosen]


def run_model(
    catalog: Catalog,
    name: str,
    full_refresh: bool = False,
    as_of: Column | None = None,
    lookback_days: int = 0,
    on_duplicate: str = "error",
) -> DataFrame:
    """Build one model from the tables it needs and store it its own way."""
    model = MODELS[name]
    # The view is for readers; the facts come from the same documents by a shorter way.
    inputs = [catalog.matches() if need == "stg_matches" else catalog.table(need) for need in model.needs]
    watch = watch_quality(name)
    if model.kind == "table":
        return catalog.materialize(model.build(*inputs), name, "table", watch=watch)
    if model.kind == "incremental":
        if not full_refresh and catalog.has(name):
            # On the input, below any explode: the literal prunes the folders scanned.
            mark = catalog.newest_partition(name)
            inputs[0] = incremental_slice(inputs[0], mark, PARTITION, lookback_days)
        if on_duplicate == "latest" and "stg_matches" in model.needs:
            inputs[0] = latest_matches(inputs[0])
        built = model.build(inputs[0], as_of=as_of)
        return catalog.materialize(
            built, name, "incremental", KEYS[name], on_duplicate, full_refresh, watch=watch, search=SEARCH
        )
    return catalog.materialize(model.build(inputs[0], as_of=as_of), name, model.kind)


def log_event(catalog: Catalog, event: str, **facts: int | str) -> None:
    """Append one event to the run log."""
    row = catalog.spark.range(1).select(
        F.lit(event).alias("event"),
        F.to_json(F.struct(F.lit(event).alias("event"), *[F.lit(v).alias(k) for k, v in facts.items()])).alias("payload"),
        F.current_timestamp().alias("triggered_at"),
    )
    row.coalesce(1).write.mode("append").json(f"{catalog.root}/events")


def collector_event(summary: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The event that a collector run announces, from its one-row summary."""
    return summary.filter("new_ids > 0").select(
        F.lit("collector_finished").alias("event"),
        "new_ids",
        "batches",
        (F.current_timestamp() if as_of is None else as_of).alias("triggered_at"),
    )


def run_pipeline(
    catalog: Catalog,
    mode: str = "daily",
    full_refresh: bool = False,
    as_of: Column | None = None,
    lookback_days: int = 0,
    on_duplicate: str = "error",
) -> None:
    """Refresh layers; what is written is checked before it counts, and a failed check stops the run.

    ``staging`` and ``silver`` refresh that layer, ``gold`` also everything it builds
    upon, ``daily`` goes layer by layer and ``full`` through all of them at once.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}; use one of {MODES}")
    config.configure(catalog.spark)
    steps = {
        "staging": [(["staging"], False)],
        "silver": [(["silver"], False)],
        "gold": [(["gold"], True)],
        "daily": [(["staging"], False), (["silver"], False), (["gold"], True)],
        "full": [(["staging", "silver", "gold"], False)],
    }[mode]
    done: set[str] = set()
    for layers, ancestors in steps:
        for name in select_models(layers, ancestors):
            if name in done:
                continue
            run_model(catalog, name, full_refresh, as_of, lookback_days, on_duplicate)
            done.add(name)
    log_event(catalog, "transformation_finished", mode=mode, models=len(done))

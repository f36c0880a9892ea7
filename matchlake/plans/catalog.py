"""Names of layers and tables, and the ways a table is stored."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import config
from matchlake.operators.incremental import repeated_keys, unique_updates, upsert
from matchlake.operators.quality import Watch
from matchlake.schemas import describe
from matchlake.sources import files, partitions, scratch
from matchlake.sources.bronze import read_bronze, read_matches
from matchlake.sources.partitions import Dataset

PARTITION = "ingestion_date"
LAYERS = {
    "raw_matches": "bronze",
    "stg_matches": "staging",
    "fact_player_results": "silver",
    "fact_traits": "silver",
    "fact_units": "silver",
    "unit_winrate": "gold",
    "core_comp_winrate": "gold",
    "item_combo_winrate": "gold",
    "unit_winrate_days": "sums",
    "core_comp_winrate_days": "sums",
    "item_combo_winrate_days": "sums",
}
# What the views of gold tables are narrowed by (``gold.meta_view``), the fewest values first.
GOLD_ORDER = ("patch", "tier_winrate", "character_id")
# As many ids are looked for one by one; beyond that, between the smallest and the largest.
SEARCH_IDS = 10_000


class Catalog:
    """Tables below one root folder: ``<root>/<schema>/<table>``.

    Views live for the session; everything else is a parquet dataset, and the bronze
    table is the folder of JSON documents. ``layer_schemas`` renames the layer folders.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        layer_schemas: dict[str, str] | None = None,
        default_schema: str = "staging",
    ):
        self.spark = config.configure(spark)
        self.root = root.rstrip("/")
        self.layer_schemas = layer_schemas or {}
        self.default_schema = default_schema
        self._views: dict[str, DataFrame] = {}

    def schema_for(self, custom: str | None = None) -> str:
        """A custom schema name as it is, trimmed; the default schema where there is none."""
        return self.default_schema if custom is None else custom.strip()

    def path(self, name: str) -> str:
        layer = LAYERS.get(name)
        schema = self.schema_for(self.layer_schemas.get(layer, layer))
        return f"{self.root}/{schema}/{name}"

    def stored(self, name: str) -> Dataset:
        layer = LAYERS.get(name)
        column = PARTITION if layer in ("silver", "sums") else None
        return Dataset(self.spark, self.path(name), column, GOLD_ORDER if layer == "gold" else ())

    def has(self, name: str) -> bool:
        if name in self._views:
            return True
        if name == "raw_matches":
            return files.has_data(self.spark, self.path(name))
        return self.stored(name).live() is not None

    def table(self, name: str) -> DataFrame:
        if name in self._views:
            return self._views[name]
        if name == "raw_matches":
            return read_bronze(self.spark, self.path(name))
        if not self.has(name):
            raise LookupError(f"no table {name} in {self.root}")
        # Columns a file lacks read as NULL, columns the table has dropped are not read.
        return describe(self.stored(name).read(), name)

    def matches(self) -> DataFrame:
        """The matches of ``stg_matches`` as the player facts read them."""
        return read_matches(self.spark, self.path("raw_matches"))

    def newest_partition(self, name: str) -> date | None:
        """Largest partition date, read off the folder names: no file is opened."""
        prefix = f"{PARTITION}="
        days = [
            date.fromisoformat(folder.removeprefix(prefix))
            for folder in self.stored(name).partitions()
            if folder.startswith(prefix) and not folder.endswith(partitions.NULL_FOLDER)
        ]
        return max(days, default=None)

    def materialize(
        self,
        df: DataFrame,
        name: str,
        kind: str,
        keys: list[str] | None = None,
        on_duplicate: str = "error",
        full_refresh: bool = False,
        check: Callable[[DataFrame], None] | None = None,
        watch: Watch | None = None,
        search: list[str] | None = None,
        held: list[date | None] | None = None,
        staged: bool = False,
    ) -> DataFrame:
        """Store ``df`` as a ``view``, a rebuilt ``table`` or an ``incremental`` table.

        ``check`` sees what was written before readers do, ``watch`` counts it on the way; if
        one raises, or the build fails, the table stays as it was. Old rows of an update are
        searched by ``search``, columns that every key determines, or else by the keys; or
        the dates that hold them are known already (``held``). A frame that reads ``staged`` files,
        which stay meanwhile, is not staged again.
        """
        if kind == "view":
            self._views[name] = describe(df, name)
            df.createOrReplaceTempView(name)
        elif kind == "table":
            self.stored(name).replace(df, check=check, watch=watch)
        elif kind == "incremental":
            self._merge(df, name, keys or [], on_duplicate, full_refresh, check, watch, search, held, staged)
        else:
            raise ValueError(f"unknown kind: {kind}")
        return self.table(name)

    def dates_holding(self, names: list[str], updates: DataFrame, keys: list[str]) -> dict[str, list[date | None]]:
        """Dates on which stored tables hold keys of ``updates``, found by one search for all of them.

        A bounded number of ids is looked for one by one, so that scans skip row groups by their
        statistics, dictionaries and Bloom filters; of more ids, which hardly a row group would
        lack, the range is looked at. What is found is the same.
        """
        first = F.col(keys[0])
        wanted = updates.select(*keys).filter(first.isNotNull())
        ids = [row[0] for row in wanted.select(keys[0]).distinct().limit(SEARCH_IDS + 1).collect()]
        listed = len(ids) <= SEARCH_IDS
        if listed:
            near = first.isin(ids) if ids else F.lit(False)
        else:
            # Ids grow with time, so their range lets the scan skip most old files.
            low, high = wanted.agg(F.min(first), F.max(first)).first()
            near = first.between(F.lit(low), F.lit(high))
        tables = [self.stored(name).read().filter(near).select(*keys, PARTITION) for name in names]
        found = reduce(DataFrame.unionByName, [t.withColumn("_table", F.lit(n)) for n, t in zip(names, tables)])
        if not listed or len(keys) > 1:
            found = found.join(wanted, keys, "left_semi")
        dates: dict[str, list[date | None]] = {name: [] for name in names}
        for name, day in found.select("_table", PARTITION).distinct().collect():
            dates[name].append(day)
        return dates

    def _merge(
        self,
        df: DataFrame,
        name: str,
        keys: list[str],
        on_duplicate: str,
        full_refresh: bool,
        check: Callable[[DataFrame], None] | None,
        watch: Watch | None,
        search: list[str] | None,
        held: list[date | None] | None,
        staged: bool,
    ) -> None:
        # The staged updates go once they are merged.
        with scratch.scope(), scratch.tidy(self.spark), scratch.tidy(df.sparkSession):
            self._merge_staged(df, name, keys, on_duplicate, full_refresh, check, watch, search, held, staged)

    def _merge_staged(
        self,
        df: DataFrame,
        name: str,
        keys: list[str],
        on_duplicate: str,
        full_refresh: bool,
        check: Callable[[DataFrame], None] | None,
        watch: Watch | None,
        search: list[str] | None,
        held: list[date | None] | None,
        staged: bool,
    ) -> None:
        table = self.stored(name)
        # The updates are used several times: computed once, and whole rows dealt only where keys came twice.
        updates = df if staged else scratch.save(df, f"updates-{name}")
        if on_duplicate != "latest":
            updates = unique_updates(updates, keys, on_duplicate)
        elif not repeated_keys(updates, keys).isEmpty():
            updates = scratch.save(unique_updates(updates, keys, on_duplicate), f"updates-{name}")
        bloom = (search or keys)[0]
        note = table.live()
        if full_refresh or note is None:
            table.replace(updates, check=check, watch=watch, bloom=bloom)
            return
        target = table.read()
        old, new = target.schema, df.schema
        gone = [f.name for f in old.fields if f.name not in new.names]
        retyped = any(f.name in old.names and old[f.name].dataType != f.dataType for f in new.fields)
        returned = any(f.name not in old.names and f.name in note["stale"] for f in new.fields)
        if retyped or returned:
            # Old files hold other values or types under these names: all of them are rewritten.
            table.replace(upsert(target, updates, keys, "checked"), check=check, watch=watch, bloom=bloom)
            return
        # An update may move a row to another date; its old partition is touched too.
        if held is None:
            known = search is not None and {*search} <= {*old.names} & {*new.names}
            held = self.dates_holding([name], updates, search if known else keys)[name]
        dates = list({*held, *partitions.partition_values(updates, PARTITION)})
        merged = upsert(target.filter(partitions.touched(PARTITION, dates)), updates, keys, "checked")
        table.replace(merged, dates, check, stale=sorted({*note["stale"], *gone}), watch=watch, bloom=bloom)

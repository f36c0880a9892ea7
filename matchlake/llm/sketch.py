"""Counters of hashed keys, kept as the one thing asked of them: was it met more than once?

A key has one counter in each of ``ROWS`` rows of counters. Counters are counted exactly, in the
input tasks first, so a hot key costs no more than a rare one; those above one are packed into
pages of bits. A key of which some counter stands at one has occurred once, without doubt. The
others may have occurred more often: other keys can share their counters, which costs work but no
result. The pages are bounded in bytes, so every task can have them; with more keys than the
bound suits, more keys are taken for repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import Scratch

ROWS = 2
#: Counters of each row per key; about 1.4% of the unique keys are taken for repeated then.
PER_KEY = 8
#: All pages together; this is what a task gets to have.
PAGES_MB = 128
#: Bits of a page, as Spark's bitmap functions have it.
PAGE = 32_768
#: Rows of one key that a join may bring together in a task.
HOT_ROWS = 200_000


def row_length(keys: int, pages_mb: int = PAGES_MB) -> int:
    """Counters in a row, a power of two."""
    most = max(PAGE, pages_mb * 2**20 * 8 // ROWS)
    wanted = max(PAGE, PER_KEY * keys)
    return 1 << min((wanted - 1).bit_length(), most.bit_length() - 1)


def _cell(key: list[str], row: int, length: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), *key), F.lit(length)) + row * length


def repeated_pages(frame: DataFrame, key: list[str], length: int, scratch: Scratch, name: str) -> DataFrame:
    """(page, bits): the counters that stand above one."""
    cells = frame.select(F.explode(F.array(*[_cell(key, row, length) for row in range(ROWS)])).alias("cell"))
    above = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    placed = above.select(
        F.expr(f"cell div {PAGE}").alias("page"), F.pmod("cell", F.lit(PAGE)).alias("bit")
    )
    # dealt by page first: a page is then built once, not by every task that has a bit of it
    pages = placed.repartition("page").groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits"))
    return scratch.save(pages, name)


def flag_repeated(frame: DataFrame, key: list[str], pages: DataFrame, length: int, flag: str) -> DataFrame:
    """``frame`` with ``flag``: false where ``key`` has certainly occurred once at most."""
    names, test = frame.columns, F.lit(True)
    for row in range(ROWS):
        page, bits, cell = f"_page{row}", f"_bits{row}", _cell(key, row, length)
        own = pages.filter(F.expr(f"page div {length // PAGE}") == row)
        # at most PAGES_MB of bits, whatever the number of keys
        own = F.broadcast(own.select(F.col("page").alias(page), F.col("bits").alias(bits)))
        frame = frame.withColumn(f"_cell{row}", cell)
        frame = frame.join(own, F.expr(f"_cell{row} div {PAGE}") == F.col(page), "left")
        at = f"pmod(_cell{row}, {PAGE})"
        byte = f"cast(conv(hex(substring({bits}, cast({at} div 8 as int) + 1, 1)), 16, 10) as int)"
        test = test & F.expr(f"coalesce(getbit({byte}, cast({at} % 8 as int)) = 1, false)")
    return frame.select(*names, test.alias(flag))


def attach(
    rows: DataFrame, facts: DataFrame, key: list[str], weight: str, how: str = "left", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``rows`` joined with ``facts``, which has one row per key and in ``weight`` its number of rows.

    Keys of more than ``hot_rows`` rows are too many rows for a task; of those keys there are at
    most (all rows / ``hot_rows``), so their facts are broadcast. The others are joined by shuffle.
    """
    facts_of = lambda part: part.drop(weight)
    hot = facts.filter(F.col(weight) > hot_rows)
    if hot.isEmpty():
        return rows.join(facts_of(facts), key, how)
    few = F.broadcast(facts_of(hot))
    cold = rows.join(F.broadcast(hot.select(*key)), key, "left_anti")
    found = cold.join(facts_of(facts.filter(F.col(weight) <= hot_rows)), key, how)
    return found.unionByName(rows.join(few, key).select(*found.columns))

"""N-gram Jaccard self-join with adaptive multi-match prefixes, and the groups it links.

A document is the set of its distinct 5-word shingles, as 64-bit hashes. Two sets with Jaccard
similarity of at least t share at least ``need = ceil(t * n)`` elements of either, so under
any order of all shingles their prefixes of ``n - need + k`` elements share at least ``k``
of them: a longer prefix asks for more matches before a pair is verified. The steps:

1. Equal sets are one class (128-bit digest); from here on only classes count.
2. Elimination. Under the order of the hashes every class gives a prefix with k = 1 + n/10.
   A class that shares fewer of these shingles with any other class has no partner. Only
   shingle hashes and class ids are shuffled, dealt evenly by hash. Tasks put entries together
   first: of a shingle that several classes of a run have, only two are sent.
3. The classes that are left are read again, whole. Their shingles are ordered rarest first and
   every class chooses its own k: the estimated cost is the number of postings that its prefix
   reads plus the candidates that it may have to verify, at most postings / k.
4. Star rounds. For each shingle the classes that have it are compared with one pivot only;
   verified links join components. This collapses groups of near copies without their pairs.
5. Exact finish. What is still missing can only lie between components. For each shingle, the
   classes outside its largest component are paired with those of other components; a
   pair that shares min(k, k') shingles at prefix levels up to that number is verified. Two bounds
   spare pairs that can't be similar: the places where they meet, and parity bits of the sets,
   of which as many differ as there are shingles in only one of the two, at most. No cap: every
   pair that the bounds allow is looked at unless its link would join nothing new.

Verification is the exact intersection of the two sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm import sketch, textscan
from matchlake.llm.common import Scratch, bounded, pack, text_key

PERCENT = 80
SHINGLE = 5
ENTRIES_PER_BUCKET = 500_000
#: Entries that a task puts together before it deals them.
ENTRIES_PER_RUN = 500_000
MAX_LEVEL = 4
PARITY_WORDS = 16
#: Cost of verifying a pair, in posting reads.
VERIFY_COST = 20
#: Star rounds go on while the finish would look at more than so many pairs per posting.
PAIRS_PER_POSTING = 20
STAR_ROUNDS = 6
STAR_PIVOTS = 4


def _digest(shingles: np.ndarray) -> tuple[int | None, int | None]:
    if not len(shingles):
        return None, None
    raw = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _parity(shingles: np.ndarray) -> np.ndarray:
    """For each of ``64 * PARITY_WORDS`` cells whether an odd number of the shingles falls into it."""
    cells = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % (64 * PARITY_WORDS), minlength=64 * PARITY_WORDS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.uint64)


def _need(n, percent: int):
    return (n * percent + 99) // 100


def _sets(texts: pa.Array, size: int) -> Iterator[list[np.ndarray]]:
    for _, data, offsets in textscan.runs(texts):
        yield textscan.shingle_sets(data, offsets, size)


def shingle_classes(docs: DataFrame, size: int = SHINGLE, with_set: bool = False, with_key: bool = False) -> DataFrame:
    """doc_id, n (distinct shingles), hi and lo (digest; NULL for an empty set), the set and its parity bits.

    ``with_key`` adds ``key``, which tells texts of one id apart.
    """
    schema = "doc_id long, n long, hi long, lo long" + (", key binary" if with_key else "")
    schema += ", shingles array<long>, bits array<long>" if with_set else ""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column(0), 0
            for sets in _sets(batch.column(1), size):
                digests = [_digest(x) for x in sets]
                columns = [
                    ids.slice(at, len(sets)),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([x[0] for x in digests], pa.int64()),
                    pa.array([x[1] for x in digests], pa.int64()),
                ]
                if with_key:
                    columns.append(batch.column(2).slice(at, len(sets)))
                at += len(sets)
                if with_set:
                    columns += [textscan.list_column(sets), textscan.list_column([_parity(x) for x in sets])]
                yield pa.RecordBatch.from_arrays(columns, names=schema_names)

    schema_names = [x.split()[0] for x in schema.split(", ")]
    keys = [text_key(F.col("text")).alias("key")] if with_key else []
    return docs.select("doc_id", "text", *keys).mapInArrow(scan, schema)


def _entries(shingle: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct entries in order, and for each its shingle's number."""
    order = np.lexsort((owner, shingle))
    shingle, owner = shingle[order], owner[order]
    new_shingle = np.append(True, shingle[1:] != shingle[:-1])
    new = new_shingle | np.append(True, owner[1:] != owner[:-1])
    return shingle[new], owner[new], np.cumsum(new_shingle[new]) - 1


def _packed(shingle: np.ndarray, owner: np.ndarray, buckets: int) -> pa.RecordBatch:
    """What a run of prefixes has to say: at most two entries for each shingle, and counts.

    A shingle of several classes is shared whatever the other runs hold. Its smallest and largest
    class tell them so; for the others it is counted here, as rows without shingles.
    """
    shingle, owner, group = _entries(shingle, owner)
    first = np.append(True, group[1:] != group[:-1])
    sent = first | np.append(first[1:], True)
    known, count = np.unique(owner[~sent], return_counts=True)
    shingle, owner = shingle[sent], owner[sent]
    bucket = (shingle % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, start = np.unique(bucket[order], return_index=True)
    ends = np.append(start, len(order)).astype(np.int32)
    # counts go wherever there is room, dealt in slices
    cuts = np.linspace(0, len(known), min(len(known), len(names)) + 1).astype(np.int32)
    more = len(cuts) - 1
    rest = np.zeros(more, np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([names, names[:more]])),
            pa.ListArray.from_arrays(pa.array(np.concatenate([ends, ends[-1] + rest])), pa.array(shingle[order].view(np.int64))),
            pa.ListArray.from_arrays(pa.array(np.concatenate([ends, ends[-1] + cuts[1:]])), pa.array(np.concatenate([owner[order], known]))),
            pa.ListArray.from_arrays(pa.array(np.concatenate([np.zeros(len(names), np.int32), cuts])), pa.array(count.astype(np.int64))),
        ],
        names=["bucket", "shingles", "classes", "counts"],
    )


def _prefix_entries(docs: DataFrame, buckets: int, size: int, percent: int) -> DataFrame:
    """Prefixes under the order of the hashes, as (bucket, shingles, classes) with equal lengths.

    They are put together over runs of about ``ENTRIES_PER_RUN``, in which repeated texts and shingles of
    many classes take no more room than two entries for each shingle. ``counts`` belongs to rows without
    shingles: how many shared shingles of each class are counted already. A class whose texts
    lie in several runs may be counted more often than it should, never less.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, classes, held = [], [], 0
        for batch in batches:
            for sets in _sets(batch.column(0), size):
                sets = [x for x in sets if len(x)]
                if not sets:
                    continue
                heads = [x[: len(x) - _need(len(x), percent) + 1 + len(x) // 10] for x in sets]
                owners = np.array([_digest(x)[1] for x in sets], np.int64)
                shingles.append(np.concatenate(heads))
                classes.append(np.repeat(owners, [len(x) for x in heads]))
                held += len(shingles[-1])
                if held >= ENTRIES_PER_RUN:
                    yield _packed(np.concatenate(shingles), np.concatenate(classes), buckets)
                    shingles, classes, held = [], [], 0
        if held:
            yield _packed(np.concatenate(shingles), np.concatenate(classes), buckets)

    return docs.select("text").mapInArrow(scan, "bucket long, shingles array<long>, classes array<long>, counts array<long>")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, number of its shingles here that another class has), over one partition, and the counts there were."""
    shingles, classes = [], []
    for batch in batches:
        rows, counts = batch.filter(pc.greater(pc.list_value_length(batch.column(0)), 0)), batch.column(2).flatten()
        if len(counts):
            known = batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0)).column(1).flatten()
            yield pa.RecordBatch.from_arrays([known, counts], names=["lo", "shared"])
        shingles.append(rows.column(0).flatten().to_numpy(zero_copy_only=False))
        classes.append(rows.column(1).flatten().to_numpy(zero_copy_only=False))
    if not shingles:
        return
    shingle, owner = np.concatenate(shingles), np.concatenate(classes)
    del shingles, classes
    if not len(shingle):
        return
    _, owner, group = _entries(shingle, owner)
    held = np.bincount(group)[group] > 1
    found, count = np.unique(owner[held], return_counts=True)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(count.astype(np.int64))], names=["lo", "shared"])


def _survivors(docs: DataFrame, table: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Classes that share enough of their prefix to have a partner: rep, hi, lo, n."""
    spark = docs.sparkSession
    # repeated texts count, as in several runs they are several entries
    entries = table.agg(F.sum(F.col("n") * (100 - percent + 10) / 100 + 2)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(entries) // ENTRIES_PER_BUCKET + 1)
    dealt = _prefix_entries(docs, 4 * parts, size, percent).repartition(parts, "bucket")
    shared = dealt.select("shingles", "classes", "counts").mapInArrow(_shared, "lo long, shared long")
    totals = shared.groupBy(F.col("lo").alias("_lo")).agg(F.sum("shared").alias("shared"))
    # a partner has at least need(n) elements, so its own k is at least 1 + need(n) / 10
    least = F.expr(f"1 + ((n * {percent} + 99) div 100) div 10")
    return classes.join(totals, F.col("lo") == F.col("_lo")).where(F.col("shared") >= least).select("rep", "hi", "lo", "n")


def _postings(sets: DataFrame, percent: int, max_level: int) -> DataFrame:
    """Rarest-first prefixes, each as long as its class found best.

    token, node, n, held (shingles that other classes have), at (place of the token among
    them), level (prefix that the token enters with), k.
    """
    flat = sets.select("node", "n", F.explode("shingles").alias("token"))
    common = flat.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = (
        flat.join(common, "token")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("held"))
        .withColumn("need", F.expr(f"(n * {percent} + 99) div 100"))
        # with fewer shared elements than the overlap asks for there is no partner
        .where("size(held) >= need")
        # elements of no other class come first; of the rest, so many lie in the prefix for k = 1
        .withColumn("base", F.expr("int(size(held) - need + 1)"))
    )
    costs = []
    for k in range(1, max_level + 1):
        reads = f"aggregate(slice(held, 1, least(base + {k - 1}, size(held))), 0D, (s, x) -> s + x.df - 1)"
        costs.append(f"struct({reads} * (1 + {VERIFY_COST}D / {k}) AS cost, {k} AS k)")
    chosen = ranked.withColumn("k", F.expr(f"least(array_min(array({', '.join(costs)})).k, int(need))"))
    return chosen.select(
        "node", "n", "k", F.size("held").alias("held"), F.posexplode(F.expr("slice(held, 1, least(base + k - 1, size(held)))")).alias("at", "x"), "base"
    ).select(F.col("x.token").alias("token"), "node", "n", "held", "at", F.expr("greatest(1, at + 2 - base)").alias("level"), "k")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity asked for."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.join(left, "a").join(right, "b")
    same = F.size(F.array_intersect("_a", "_b"))
    total = F.size("_a") + F.size("_b") - same
    return both.where(100 * same.cast("long") >= percent * total.cast("long")).select("a", "b")


def _may_link(x: str, y: str, percent: int):
    """Whether two classes that meet at a shingle can be similar: by their sizes, and by place.

    Common shingles lie before the one they meet at on both sides, or behind it on both sides, and
    the overlap has to be at least ``percent / (100 + percent)`` of both sizes together.
    """
    sizes = f"100 * n{x} >= {percent} * n{y} AND 100 * n{y} >= {percent} * n{x}"
    most = f"least(at{x}, at{y}) + least(held{x} - at{x}, held{y} - at{y})"
    return F.expr(f"{sizes} AND {100 + percent} * ({most}) >= {percent} * (n{x} + n{y})")


def merge_components(labels: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``labels`` (node, comp) after joining the components that ``links`` (a, b) connect.

    Every component hooks onto the smallest one it is linked with, chains are shortened by
    pointer jumping, and both repeat on the contracted graph until no link is left between
    two components. Only components that take part in a link are worked on, at most two per link.
    """
    step, n = 0, links.count()
    a, b = labels.select(F.col("node").alias("a"), F.col("comp").alias("ca")), labels.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    edges = links.join(a, "a").join(b, "b").where("ca <> cb").select("ca", "cb").distinct()
    edges = scratch.save(edges, f"{name}-edges{step}", 2 * n)
    changed: DataFrame | None = None
    while not edges.isEmpty():
        step += 1
        both = edges.union(edges.select("cb", "ca"))
        parents = both.groupBy(F.col("ca").alias("comp")).agg(F.min("cb").alias("up"))
        parents = scratch.save(parents.withColumn("up", F.least("comp", "up")), f"{name}-up{step}-0", 2 * n)
        jump = 0
        while True:
            above = parents.select(F.col("comp").alias("_c"), F.col("up").alias("_up"))
            jump += 1
            moved = scratch.save(
                parents.join(above, F.col("up") == F.col("_c")).select("comp", F.col("_up").alias("up"), (F.col("up") != F.col("_up")).alias("moved")),
                f"{name}-up{step}-{jump}",
                2 * n,
            )
            parents = moved.select("comp", "up")
            if not moved.where("moved").limit(1).count():
                break
        if changed is None:
            changed = parents
        else:
            new = parents.select(F.col("comp").alias("_c"), F.col("up").alias("_up"))
            older = changed.join(new, F.col("up") == F.col("_c"), "left").select("comp", F.coalesce("_up", "up").alias("up"))
            changed = older
        changed = scratch.save(changed, f"{name}-changed{step}", 2 * n)
        x = parents.select(F.col("comp").alias("ca"), F.col("up").alias("ua"))
        y = parents.select(F.col("comp").alias("cb"), F.col("up").alias("ub"))
        edges = edges.join(x, "ca").join(y, "cb").where("ua <> ub").select(F.col("ua").alias("ca"), F.col("ub").alias("cb")).distinct()
        edges = scratch.save(edges, f"{name}-edges{step}", 2 * n)
    if changed is None:
        return labels
    merged = labels.join(changed.withColumnRenamed("comp", "_c"), F.col("comp") == F.col("_c"), "left")
    return scratch.save(merged.select("node", F.coalesce("up", "comp").alias("comp")), f"{name}-labels")


def _side(postings: DataFrame, x: str) -> DataFrame:
    names = {"node": f"node{x}", "n": f"n{x}", "held": f"held{x}", "at": f"at{x}", "level": f"level{x}", "k": f"k{x}", "comp": f"comp{x}"}
    return postings.withColumnsRenamed(names)


def _star_pairs(placed: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each class with up to ``STAR_PIVOTS`` pivots of its shingles, those that share most with it.

    The pivot of a shingle is any of the classes that have it, another one in each turn.
    """
    mark = F.xxhash64("node", "token", F.lit(turn)).alias("mark")
    one = F.min(F.struct(mark, *[F.col(x) for x in ("node", "n", "held", "at", "comp")]))
    pivots = placed.groupBy("token").agg(one.alias("p")).select("token", "p.*").drop("mark")
    met = (
        _side(placed, "_x")
        .join(_side(pivots, "_y"), "token")
        .where("comp_x <> comp_y")
        .where(_may_link("_x", "_y", percent))
        .groupBy(F.col("node_x").alias("a"), F.col("node_y").alias("b"))
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    best = Window.partitionBy("a").orderBy(F.desc("hits"), "b")
    return met.withColumn("_r", F.row_number().over(best)).where(f"_r <= {STAR_PIVOTS}").select("a", "b")


def _cross(placed: DataFrame, scratch: Scratch, name: str, n: int) -> tuple[DataFrame, int]:
    """Postings of shingles that several components share, marked ``stray`` outside the largest.

    Also the number of pairs that the strays meet.
    """
    groups = placed.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    tokens = groups.groupBy("token").agg(
        F.max(F.struct("c", "comp")).alias("main"), F.sum("c").alias("df"), F.count(F.lit(1)).alias("comps")
    ).where("comps > 1")
    tokens = scratch.save(tokens.select("token", F.col("main.comp").alias("main"), "df", F.expr("df - main.c").alias("strays")), f"{name}-tokens", n)
    pairs = tokens.agg(F.sum(F.expr("strays * df"))).first()[0] or 0
    return placed.join(tokens.select("token", "main"), "token").withColumn("stray", F.expr("comp <> main")).drop("main"), int(pairs)


def _finish_pairs(cross: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs between components that share as many prefix shingles as their levels ask for."""
    words = range(PARITY_WORDS)
    bits = sets.select("node", *[F.col("bits")[i].alias(f"bits{i}") for i in words])
    known = cross.join(bits, "node")

    def side(frame: DataFrame, x: str) -> DataFrame:
        return _side(frame, x).withColumnsRenamed({f"bits{i}": f"bits{i}{x}" for i in words})

    left, right = side(known.where("stray").drop("stray"), "_x"), side(known, "_y")
    # at most so many elements lie in one of two similar sets only
    apart = " + ".join(f"bit_count(bits{i}_x ^ bits{i}_y)" for i in words)
    few = F.expr(f"{100 + percent} * ({apart}) <= {100 - percent} * (n_x + n_y)")
    met = (
        left.join(right, "token")
        .where("comp_x <> comp_y AND (NOT stray OR node_x < node_y)")
        .where("greatest(level_x, level_y) <= least(k_x, k_y)")
        .where(_may_link("_x", "_y", percent) & few)
    )
    pair = [F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")]
    return met.groupBy(*pair, F.least("k_x", "k_y").alias("k")).count().where("count >= k").select("a", "b")


def link_classes(sets: DataFrame, scratch: Scratch, percent: int = PERCENT, max_level: int = MAX_LEVEL) -> DataFrame:
    """(node, comp) of the classes in ``sets`` (node, n, shingles, bits) that have partners."""
    postings = scratch.save(_postings(sets, percent, max_level), "postings")
    n, nodes = postings.count(), sets.count()
    labels = scratch.save(postings.select("node").distinct().withColumn("comp", F.col("node")), "labels", nodes)
    done = False
    for turn in range(STAR_ROUNDS + 1):
        placed = scratch.save(postings.join(labels, "node"), f"placed{turn}", n)
        cross, left = _cross(placed, scratch, f"cross{turn}", n)
        if done or turn == STAR_ROUNDS or left <= PAIRS_PER_POSTING * n:
            break
        pairs = scratch.save(_star_pairs(placed, turn, percent), f"star{turn}", STAR_PIVOTS * nodes)
        links = scratch.save(_verified(pairs, sets, percent), f"star{turn}-links", STAR_PIVOTS * nodes)
        labels = merge_components(labels, links, scratch, f"star{turn}")
        # where few of the comparisons join anything, further ones hardly would
        done = links.count() * 5 < pairs.count()
    pairs = scratch.save(_finish_pairs(cross, sets, percent), "finish")
    links = scratch.save(_verified(pairs, sets, percent), "finish-links")
    return merge_components(labels, links, scratch, "finish")


def near_duplicate_groups(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, max_level: int = MAX_LEVEL) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Empty and NULL texts have no shingles and are linked with nothing; their component is their own
    id. A text of fewer than ``size`` words is one shingle, its whole sequence. Repeated ids
    and texts each give a row. A NULL id counts as no id: the component is the smallest other
    one, or NULL. Extra columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    table, reps = _grouped(docs, scratch, percent, size, max_level)
    found = reps.select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), "component")
    joined = table.join(found, (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo")), "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _grouped(
    docs: DataFrame, scratch: Scratch, percent: int, size: int, max_level: int, with_key: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Every row's class, and for each class (hi, lo) its component: a number, and its smallest id."""
    table = scratch.save(shingle_classes(docs, size, with_key=with_key), "table")
    classes = scratch.save(
        table.where("n > 0").groupBy("hi", "lo", "n").agg(F.min("doc_id").alias("rep")), "classes"
    )
    kept = scratch.save(_survivors(docs, table, classes, size, percent), "survivors")
    # the whole sets of what is left; the text travels only where its id does not fit a broadcast
    ids = bounded(kept.select(F.col("rep").alias("_rep")).distinct())
    again = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi")
    whole = shingle_classes(again, size, with_set=True).select("hi", "lo", "n", "shingles", "bits")
    sets = whole.join(kept.select("hi", "lo"), ["hi", "lo"], "left_semi").dropDuplicates(["hi", "lo"])
    sets = scratch.save(sets.select(F.col("lo").alias("node"), "n", "shingles", "bits"), "sets")
    labels = link_classes(sets, scratch, percent, max_level)

    grouped = classes.join(labels, F.col("lo") == F.col("node"), "left").withColumn("comp", F.coalesce("comp", "lo"))
    # classes without a partner keep their own representative; only the others meet
    linked = grouped.where("node IS NOT NULL")
    smallest = linked.groupBy("comp").agg(F.min("rep").alias("least"))
    reps = scratch.save(
        linked.join(smallest, "comp").select("hi", "lo", "comp", F.col("least").alias("component"))
        .unionByName(grouped.where("node IS NULL").select("hi", "lo", "comp", F.col("rep").alias("component"))),
        "reps",
    )
    return table, reps


def keep_one(
    docs: DataFrame,
    percent: int = PERCENT,
    size: int = SHINGLE,
    max_level: int = MAX_LEVEL,
    hot_rows: int = sketch.HOT_ROWS,
) -> DataFrame:
    """One row of ``docs`` of each group of near duplicates, and all rows without words.

    The row with the smallest id stays, rows without id coming last; of several texts of that id the
    one with the smallest digest, of rows that repeat id and text any one. So of every group exactly one
    row is left, whatever its ids. Rows with an empty or NULL text are linked with nothing and
    stay. Columns may have any names.
    """
    scratch = Scratch(docs.sparkSession, "keep")
    table, reps = _grouped(docs, scratch, percent, size, max_level, with_key=True)
    texts = scratch.save(
        table.where("n > 0").groupBy("doc_id", "key", "hi", "lo").agg(F.count(F.lit(1)).alias("rows")), "texts"
    )
    # the first text of each class, then of each component, NULL ids last
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("first")
    classes = texts.groupBy("hi", "lo").agg(first, F.count(F.lit(1)).alias("_n"))
    classes = scratch.save(classes.join(reps.select("hi", "lo", "comp"), ["hi", "lo"]), "class-firsts")
    wins = classes.groupBy("comp").agg(F.min("first").alias("win"), F.count(F.lit(1)).alias("_classes"))
    winners = scratch.save(wins.select("comp", "win", "_classes"), "winners")
    judged = sketch.attach(classes, winners, ["comp"], "_classes", "inner", hot_rows)
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    judged = sketch.attach(texts, judged.select("hi", "lo", "win", "_n"), ["hi", "lo"], "_n", "inner", hot_rows)
    marked = scratch.save(judged.select("doc_id", "key", "rows", (own == F.col("win")).alias("wins")), "marked")

    keyed = docs.select(pack(docs), F.col("doc_id").alias("_id"), text_key(F.col("text")).alias("_key"))
    key_of = lambda frame: frame.select(F.col("doc_id").alias("_i"), F.col("key").alias("_k"))
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k"))
    left = keyed.join(bounded(key_of(marked.where("NOT wins"))), same, "left_anti")
    again = scratch.save(key_of(marked.where("wins AND rows > 1")), "again")
    if again.isEmpty():
        return left.select("_row.*")
    again = bounded(again)
    once = left.join(again, same, "left_semi").groupBy("_id", "_key").agg(F.first("_row").alias("_row"))
    return left.join(again, same, "left_anti").select("_row.*").unionByName(once.select("_row.*"))

"""The processing ledger: what has become of every match id.

Events of a match are applied in the order of ``(event_time, seq)``:

* ``discovered`` starts the document afresh, unless it is settled;
* ``fetch_ok`` settles it as success, unless it is settled;
* ``fetch_error`` and ``not_found`` count a retry and give up at the limit, unless settled;
* ``dead_letter`` revives anything but a success until its own limit, then gives up.

Settled means success or abandoned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake import config
from matchlake.functions import batch_label, truncate_error
from matchlake.sources import scratch

EVENT = "struct<event_time:timestamp,seq:bigint,kind:string,message:string>"
DOCUMENT = ["status", "created_at", "retries", "last_error", "updated_at", "processed_at", "dlq_attempts", "requeue"]
#: What a stretch of events does to a document. NULL fields stay as they were, or are empty
#: after ``replaced``. ``tries`` and ``dead`` are added to the counters of before, unless
#: ``tries_reset`` or ``replaced``. ``retried`` and ``revived`` say that the document shows these
#: counters, ``gave_up`` that its error text is made of the number of dead letters.
STATE = (
    "struct<status:string,created_at:timestamp,last_error:string,updated_at:timestamp,"
    "processed_at:timestamp,requeue:boolean,replaced:boolean,tries:bigint,dead:bigint,"
    "tries_reset:boolean,retried:boolean,revived:boolean,gave_up:boolean>"
)
TYPES = dict(part.split(":") for part in STATE.removeprefix("struct<").removesuffix(">").split(","))
FIELDS = list(TYPES)
LAID_OVER = ["status", "created_at", "last_error", "updated_at", "processed_at", "requeue", "retried", "revived", "gave_up"]

#: Events of one id that are folded at once, at most; the rest goes to further slices.
SLICE_EVENTS = 20_000
#: Cells in which the events of ids are counted first.
CELLS = 1 << 16
#: Slices of one id that are chained at once; more of them are chained in blocks.
BLOCK = 256


def recoverable(kind: Column, message: Column) -> Column:
    """Errors worth another try: neither refused credentials nor an unknown match."""
    refused = F.lit(False)
    for code in config.FATAL_HTTP_CODES:
        refused = refused | F.coalesce(F.contains(message, F.lit(code)), F.lit(False))
    return (kind == "fetch_error") & ~refused


def _state(**values: Column) -> Column:
    return F.struct(
        *[values.get(name, F.lit(None)).cast(TYPES[name]).alias(name) for name in FIELDS]
    )


def _seed(status: str | None, tries: int, dead: int) -> Column:
    """A control state: all that a stretch of events has to know of its start."""
    return _state(status=F.lit(status), tries=F.lit(tries), dead=F.lit(dead), replaced=F.lit(False), tries_reset=F.lit(False))


def _apply(max_retries: int, max_dlq: int):
    """The transition: state and event to the next state."""

    def changed(s: Column, **values: Column) -> Column:
        return _state(**{name: values.get(name, s[name]) for name in FIELDS})

    def step(s: Column, e: Column) -> Column:
        kind, now = e["kind"], e["event_time"]
        won = s["status"].eqNullSafe(config.STATUS_SUCCESS)
        settled = won | s["status"].eqNullSafe(config.STATUS_ABANDONED)
        fresh = _state(
            status=F.lit(config.STATUS_PENDING),
            created_at=now,
            requeue=F.lit(False),
            replaced=F.lit(True),
            tries=F.lit(0),
            dead=F.lit(0),
            tries_reset=F.lit(True),
            retried=F.lit(True),
        )
        fetched = changed(
            s, status=F.lit(config.STATUS_SUCCESS), processed_at=now, requeue=F.lit(False)
        )
        tries = s["tries"] + 1
        spent = tries >= max_retries
        text = F.when(kind == "not_found", F.lit(config.NOT_FOUND_MESSAGE)).otherwise(e["message"])
        failed = changed(
            s,
            status=F.when(spent, config.STATUS_ABANDONED).otherwise(config.STATUS_ERROR),
            tries=tries,
            retried=F.lit(True),
            last_error=truncate_error(text),
            gave_up=F.lit(False),
            updated_at=now,
            requeue=~spent & recoverable(kind, e["message"]),
        )
        given_up = changed(
            s,
            status=F.lit(config.STATUS_ABANDONED),
            last_error=F.lit(""),
            gave_up=F.lit(True),
            updated_at=now,
            requeue=F.lit(False),
        )
        revived = changed(
            s,
            status=F.lit(config.STATUS_ERROR),
            tries=F.lit(0),
            tries_reset=F.lit(True),
            retried=F.lit(True),
            dead=s["dead"] + 1,
            revived=F.lit(True),
            last_error=F.lit(config.DEAD_LETTER_RETRY_MESSAGE),
            gave_up=F.lit(False),
            updated_at=now,
            requeue=F.lit(True),
        )
        return (
            F.when((kind == "dead_letter") & ~won, F.when(s["dead"] >= max_dlq, given_up).otherwise(revived))
            .when((kind == "discovered") & ~settled, fresh)
            .when((kind == "fetch_ok") & ~settled, fetched)
            .when(kind.isin("fetch_error", "not_found") & ~settled, failed)
            .otherwise(s)
        )

    return step


def _merge(s: Column, d: Column) -> Column:
    """What two stretches in a row do. A document is a stretch too, so it also merges."""
    laid = {name: F.when(d["replaced"], d[name]).otherwise(F.coalesce(d[name], s[name])) for name in LAID_OVER}
    return _state(
        **laid,
        replaced=s["replaced"] | d["replaced"],
        tries=F.when(d["tries_reset"], d["tries"]).otherwise(s["tries"] + d["tries"]),
        tries_reset=s["tries_reset"] | d["tries_reset"],
        dead=F.when(d["replaced"], d["dead"]).otherwise(s["dead"] + d["dead"]),
    )


def _events(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys,
        F.struct("event_time", "seq", "kind", truncate_error(F.col("message")).alias("message"))
        .cast(EVENT)
        .alias("event"),
    )


def _with_prior(df: DataFrame, prior: DataFrame | None) -> DataFrame:
    """Add the column ``before``: the document of the id as a state."""
    nothing = _state(tries=F.lit(0), dead=F.lit(0), replaced=F.lit(False), tries_reset=F.lit(False))
    if prior is None:
        return df.withColumn("before", nothing)
    same = ["status", "created_at", "last_error", "updated_at", "processed_at", "requeue"]
    counters = {name: F.col(name) if name in prior.columns else F.lit(None) for name in ("retries", "dlq_attempts")}
    known = prior.select(
        "match_id",
        _state(
            **{name: F.col(name) for name in same if name in prior.columns},
            replaced=F.lit(False),
            tries_reset=F.lit(False),
            tries=F.coalesce(counters["retries"], F.lit(0)),
            retried=F.when(counters["retries"].isNotNull(), F.lit(True)),
            dead=F.coalesce(counters["dlq_attempts"], F.lit(0)),
            revived=F.when(counters["dlq_attempts"].isNotNull(), F.lit(True)),
        ).alias("before"),
    )
    return df.join(known, "match_id", "left").withColumn("before", F.coalesce("before", nothing))


def _documents(df: DataFrame, state: str) -> DataFrame:
    before, after = config.DEAD_LETTER_GIVE_UP_MESSAGE.split("{}")
    s = F.col(state)
    text = F.concat(F.lit(before), s["dead"].cast("string"), F.lit(after))
    fields = {
        "retries": F.when(s["retried"], s["tries"]),
        "dlq_attempts": F.when(s["revived"], s["dead"]),
        "last_error": F.when(s["gave_up"], text).otherwise(s["last_error"]),
        "requeue": F.coalesce(s["requeue"], F.lit(False)),
    }
    return df.select("match_id", *[fields.get(name, s[name] if name in TYPES else None).alias(name) for name in DOCUMENT])


def fold_ledger(
    events: DataFrame,
    prior: DataFrame | None = None,
    max_retries: int = config.MAX_RETRIES,
    max_dlq: int = config.MAX_DLQ_ATTEMPTS,
    slice_events: int = SLICE_EVENTS,
) -> DataFrame:
    """The ledger after ``events``, starting from ``prior``. Events without an id count for nothing.

    Ids of at most ``slice_events`` events, nearly all, are dealt by id and folded whole, in one
    shuffle. The events of the others are dealt into ranges of (id, time, sequence) of about that size
    and folded range by range (``_fold_sliced``). Which ids these are is counted: first in hashed cells,
    as small a result whatever the events, then by id in the cells that are above the limit.
    """
    step = _apply(max_retries, max_dlq)
    named = events.filter(F.col("match_id").isNotNull())
    heavy = _heavy_ids(named, slice_events)
    light = named if heavy is None else named.join(heavy, "match_id", "left_anti")
    logs = _events(light, "match_id").groupBy("match_id").agg(F.sort_array(F.collect_list("event")).alias("log"))
    whole = _with_prior(logs, prior)
    folded = _documents(whole.withColumn("doc", F.aggregate("log", F.col("before"), step)), "doc")
    if heavy is not None:
        rest = named.join(heavy, "match_id", "left_semi")
        folded = folded.unionByName(_fold_sliced(rest, prior, step, max_retries, max_dlq, slice_events))
    if prior is None:
        return folded
    # Documents without new events stay as they are.
    idle = prior.join(named.select("match_id").distinct(), "match_id", "left_anti")
    types = {"retries": "bigint", "dlq_attempts": "bigint", **TYPES}
    kept = [F.col(c) if c in prior.columns else F.lit(None).cast(types[c]).alias(c) for c in DOCUMENT[:-1]]
    asked = F.coalesce("requeue", F.lit(False)) if "requeue" in prior.columns else F.lit(False)
    return folded.unionByName(idle.select("match_id", *kept, asked.alias("requeue")))


def _heavy_ids(named: DataFrame, slice_events: int) -> DataFrame | None:
    """Ids of more than ``slice_events`` events; None where there is none."""
    cell = F.pmod(F.xxhash64("match_id"), F.lit(CELLS))
    full = named.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_events)
    cells = [row.cell for row in full.select("cell").collect()]  # CELLS numbers at most
    if not cells:
        return None
    # where most cells are full, looking them up would spare nothing
    near = named if len(cells) > CELLS // 8 else named.withColumn("cell", cell).join(
        F.broadcast(named.sparkSession.createDataFrame([(c,) for c in cells], "cell bigint")), "cell", "left_semi"
    )
    counted = near.groupBy("match_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_events)
    heavy = scratch.save(counted.select("match_id"), "ledger-heavy")
    return None if heavy.isEmpty() else heavy


def _fold_sliced(
    named: DataFrame, prior: DataFrame | None, step, max_retries: int, max_dlq: int, slice_events: int
) -> DataFrame:
    """Fold ids of many events in ranges of (id, time, sequence).

    What a slice does depends on its start only through a few control states (settled as success,
    abandoned after d dead letters, or open with r retries and d dead letters, counters mattering up
    to their limits only), so each slice is folded from all of them, and the outcomes are chained.
    Counters are kept relative to the start of a slice, so documents beyond the limits fold alike.
    """
    parts = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # As many ranges as shuffle partitions, each cut in order into slices of ``slice_events`` events:
    # the number of tasks, range bounds and map outputs does not grow with the events.
    ranged = _events(named.repartitionByRange(parts, "match_id", "event_time", "seq"), "match_id")
    row = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    cut = ranged.sortWithinPartitions("match_id", "event").select(
        "match_id", F.spark_partition_id().alias("part"), F.floor(row / slice_events).alias("cut"), "event"
    )
    # Saved, so that the sampled bounds of the ranges are the same wherever they are used.
    cuts = scratch.save(
        cut.groupBy("match_id", "part", "cut").agg(F.sort_array(F.collect_list("event")).alias("log")),
        "ledger-logs",
    )
    # Slices of an id follow each other in (range, cut); numbered so, gaps between ranges do no harm.
    per_range = (cuts.agg(F.max("cut")).first()[0] or 0) + 1
    logs = cuts.select("match_id", (F.col("part") * per_range + F.col("cut")).alias("slice"), "log")
    spread = scratch.save(
        logs.groupBy("match_id").agg(F.count(F.lit(1)).alias("n"), F.min("slice").alias("first")).filter("n > 1").drop("n"),
        "ledger-spread",
    )
    whole = _with_prior(logs.join(spread, "match_id", "left_anti").select("match_id", "log"), prior)
    folded = _documents(whole.withColumn("doc", F.aggregate("log", F.col("before"), step)), "doc")
    if spread.isEmpty():
        return folded
    return folded.unionByName(_fold_spread(logs.join(spread, "match_id"), prior, step, max_retries, max_dlq))


def _fold_spread(logs: DataFrame, prior: DataFrame | None, step, max_retries: int, max_dlq: int) -> DataFrame:
    """Fold ids that lie in several slices."""
    rows, width = max(max_retries, 1), max_dlq + 1
    seeds = [_seed(None, r, d) for r in range(rows) for d in range(width)]
    seeds += [_seed(config.STATUS_ABANDONED, 0, d) for d in range(width)]
    seeds += [_seed(config.STATUS_SUCCESS, 0, 0)]

    def control(s: Column) -> Column:
        """Number of the seed that acts like the state."""
        dead = F.least(s["dead"], F.lit(max_dlq))
        return (
            F.when(s["status"].eqNullSafe(config.STATUS_SUCCESS), (rows + 1) * width)
            .when(s["status"].eqNullSafe(config.STATUS_ABANDONED), rows * width + dead)
            .otherwise(F.least(s["tries"], F.lit(rows - 1)) * width + dead)
            .cast("int")
        )

    # The slices of an id follow each other.
    numbered = logs.select("match_id", (F.col("slice") - F.col("first")).cast("bigint").alias("pos"), "log")
    from_all = F.transform(F.array(*seeds), lambda s: F.aggregate(F.col("log"), s, step))
    moves = scratch.save(numbered.select("match_id", "pos", F.transform(from_all, control).alias("ends")), "ledger-moves")
    heads = _with_prior(moves.select("match_id").distinct(), prior).select("match_id", control(F.col("before")).alias("at"))
    starts = _chain(moves, heads, len(seeds))
    begun = F.element_at(F.array(*seeds), F.col("at") + 1)
    ended = numbered.join(starts, ["match_id", "pos"]).select(
        "match_id", "pos", begun.alias("begun"), F.aggregate("log", begun, step).alias("x")
    )
    # From the counters of the seed to what was added to them. Its status is no change, but
    # every transition decides on requeue.
    x = F.col("x")
    own = {name: x[name] for name in FIELDS if name not in ("status", "tries", "dead")}
    outcome = _state(
        **own,
        status=F.when(x["requeue"].isNotNull(), x["status"]),
        tries=x["tries"] - F.when(x["tries_reset"], 0).otherwise(F.col("begun.tries")),
        dead=x["dead"] - F.when(x["replaced"], 0).otherwise(F.col("begun.dead")),
    )
    parts = ended.select("match_id", "pos", outcome.alias("outcome"))
    nothing = _state(tries=F.lit(0), dead=F.lit(0), replaced=F.lit(False), tries_reset=F.lit(False))
    most = moves.agg(F.max("pos")).first()[0] + 1
    while most > 1:  # merging is associative: neighbours first, then what they came to
        gathered = parts.groupBy("match_id", F.expr(f"pos div {BLOCK}").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "outcome"))).alias("list")
        )
        merged = F.aggregate("list", nothing, lambda s, p: _merge(s, p["outcome"]))
        parts = gathered.select("match_id", F.col("block").alias("pos"), merged.alias("outcome"))
        most = math.ceil(most / BLOCK)
    done = _with_prior(parts, prior).withColumn("doc", _merge(F.col("before"), F.col("outcome")))
    return _documents(done, "doc")


def _chain(moves: DataFrame, heads: DataFrame, states: int) -> DataFrame:
    """(match_id, pos, at): the control state every slice starts from.

    ``moves`` tells where each slice leads from any state, ``heads`` where its id begins. Blocks
    of slices are first taken as one move each and chained the same way.
    """
    block = F.expr(f"pos div {BLOCK}").alias("block")
    blocks = moves.groupBy("match_id", block).agg(F.sort_array(F.collect_list(F.struct("pos", "ends"))).alias("list"))
    if (moves.agg(F.max("pos")).first()[0] or 0) < BLOCK:
        entered = blocks.join(heads, "match_id")
    else:
        ids = F.sequence(F.lit(0), F.lit(states - 1))
        through = F.aggregate("list", ids, lambda acc, m: F.transform(acc, lambda s: F.element_at(m["ends"], s + 1)))
        joint = scratch.save(blocks.select("match_id", F.col("block").alias("pos"), through.alias("ends")), "ledger-moves")
        entered = blocks.join(_chain(joint, heads, states).withColumnRenamed("pos", "block"), ["match_id", "block"])
    empty = F.array().cast("array<struct<pos:bigint,at:int>>")
    walked = F.aggregate(
        "list",
        F.struct(F.col("at").alias("at"), empty.alias("starts")),
        lambda acc, m: F.struct(
            F.element_at(m["ends"], acc["at"] + 1).alias("at"),
            F.concat(acc["starts"], F.array(F.struct(m["pos"].cast("bigint").alias("pos"), acc["at"].alias("at")))).alias("starts"),
        ),
    )
    return entered.select("match_id", F.explode(walked["starts"]).alias("s")).select("match_id", "s.pos", "s.at")


def requeue(folded: DataFrame, as_of: Column | None = None, touched: DataFrame | None = None) -> DataFrame:
    """Ids to be fetched again, as batch number 0.

    ``touched`` are the events of the load: documents without one keep their flag, but an
    earlier load has asked for them already, so only ids with new events are returned.
    """
    label = batch_label(F.current_timestamp() if as_of is None else as_of, F.lit(0))
    asked = folded.filter("requeue")
    if touched is not None:
        asked = asked.join(touched.select("match_id"), "match_id", "left_semi")
    return asked.select(
        "match_id", F.lit(0).cast("long").alias("batch_num"), label.alias("batch_id")
    )


def ledger_status_counts(ledger: DataFrame) -> DataFrame:
    """Number of ids per status, by status."""
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("total")).orderBy("status")


def fetch_outcomes(
    attempts: DataFrame, ledger: DataFrame, max_retries: int = config.MAX_RETRIES
) -> DataFrame:
    """What each fetch attempt of a batch came to, given the ledger before the batch.

    ``attempts`` has ``batch_id, match_id, kind, message``, an id once per batch. Refused
    credentials count as abandoned although the ledger keeps them as errors.
    """
    before = ledger.select("match_id", "status", "retries")
    settled = F.coalesce(
        F.col("status").isin(config.STATUS_SUCCESS, config.STATUS_ABANDONED), F.lit(False)
    )
    spent = F.coalesce("retries", F.lit(0)) + 1 >= max_retries
    again = recoverable(F.col("kind"), F.col("message"))
    outcome = (
        F.when(settled, "skipped")
        .when(F.col("kind") == "fetch_ok", "success")
        .when(spent | ((F.col("kind") == "fetch_error") & ~again), "abandoned")
        .otherwise("error")
    )
    return attempts.join(before, "match_id", "left").select(
        "batch_id",
        "match_id",
        outcome.alias("outcome"),
        ((outcome == "error") & again).alias("requeue"),
    )


def batch_outcomes(
    attempts: DataFrame, ledger: DataFrame, max_retries: int = config.MAX_RETRIES
) -> DataFrame:
    """Counters per batch: success, error, abandoned, skipped and requeued ids."""
    counts = [
        F.count_if(F.col("outcome") == name).alias(name)
        for name in ("success", "error", "abandoned", "skipped")
    ]
    return (
        fetch_outcomes(attempts, ledger, max_retries)
        .groupBy("batch_id")
        .agg(*counts, F.count_if("requeue").alias("requeued"))
    )

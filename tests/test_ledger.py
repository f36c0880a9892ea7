"""The ledger fold: named sequences, random sequences, hot ids, and the stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake import config, schemas
from matchlake.operators import ledger
from matchlake.streaming.ledger import LedgerTable, stream_ledger

START = datetime(2024, 1, 1)
KINDS = {"d": ("discovered", None), "k": ("fetch_ok", None), "e": ("fetch_error", "timeout"), "r": ("fetch_error", "refused (401)"), "n": ("not_found", None), "x": ("dead_letter", None)}


def events(spark, sequences):
    rows = [
        (match, i, START + timedelta(seconds=i), *KINDS[letter])
        for match, letters in sequences.items()
        for i, letter in enumerate(letters)
    ]
    return spark.createDataFrame(rows, schemas.LEDGER_EVENT)


def brute_force(letters, doc=None):
    """The rules, one event at a time."""
    doc = dict(doc or {})
    for i, letter in enumerate(letters):
        now, settled = START + timedelta(seconds=i), doc.get("status") in ("success", "abandoned")
        if letter == "x":
            if doc.get("status") == "success":
                continue
            dead = doc.get("dlq_attempts") or 0
            if dead >= 2:
                doc.update(status="abandoned", updated_at=now, requeue=False, last_error=f"Abandonado após {dead} tentativas de DLQ")
            else:
                doc.update(status="error", retries=0, dlq_attempts=dead + 1, updated_at=now, requeue=True, last_error="Reprocessado via DLQ")
        elif settled:
            continue
        elif letter == "d":
            doc = {"status": "pending", "created_at": now, "retries": 0, "requeue": False}
        elif letter == "k":
            doc.update(status="success", processed_at=now, requeue=False)
        else:
            tries = (doc.get("retries") or 0) + 1
            text = {"e": "timeout", "r": "refused (401)", "n": config.NOT_FOUND_MESSAGE}[letter]
            doc.update(status="abandoned" if tries >= 3 else "error", retries=tries, last_error=text, updated_at=now, requeue=letter == "e" and tries < 3)
    return tuple(doc.get(name, False if name == "requeue" else None) for name in ledger.DOCUMENT)


def documents(df):
    return {r.match_id: tuple(r[name] for name in ledger.DOCUMENT) for r in df.collect()}


NAMED = {
    "three errors": "deee",
    "refused": "dr",
    "not found": "dn",
    "rediscovered loses its counters": "deexd",
    "settled is not rediscovered": "dkd",
    "abandoned is not rediscovered": "deeed",
    "dead letter revives": "deeex",
    "two dead letters then the end": "deeexeeexeeex",
    "again after the end": "deeexeeexeeexx",
    "success is final": "dkxe",
    "unknown and fetched": "k",
    "unknown and failed": "e",
    "unknown dead letter": "x",
    "late success": "deexk",
}


def test_named_sequences(spark):
    found = documents(ledger.fold_ledger(events(spark, NAMED)))
    assert found == {name: brute_force(letters) for name, letters in NAMED.items()}
    status = {name: doc[0] for name, doc in found.items()}
    assert status["three errors"] == "abandoned" and status["refused"] == "error"
    assert status["dead letter revives"] == "error" and status["two dead letters then the end"] == "abandoned"


def random_sequences(count, longest, seed):
    rng = random.Random(seed)
    return {f"m{i}": "".join(rng.choices("dkernx", [3, 1, 5, 2, 2, 4], k=rng.randint(1, longest))) for i in range(count)}


@pytest.mark.parametrize("slice_events", [3, 10, 1000])
def test_random_sequences_by_every_way(spark, slice_events):
    sequences = random_sequences(150, 30, 7)
    got = documents(ledger.fold_ledger(events(spark, sequences), slice_events=slice_events))
    assert got == {m: brute_force(s) for m, s in sequences.items()}


def test_one_hot_id_with_a_prior_document(spark):
    hot = "".join(random.Random(3).choices("derx", k=6000)) + "k"
    sequences = {"hot": hot, **random_sequences(30, 6, 5)}
    prior_sequences = {"hot": "dexe", "idle": "dk", "m1": "de"}
    prior = ledger.fold_ledger(events(spark, prior_sequences))
    got = documents(ledger.fold_ledger(events(spark, sequences), prior, slice_events=500))
    before = {m: dict(zip(ledger.DOCUMENT, brute_force(s))) for m, s in prior_sequences.items()}
    want = {m: brute_force(s, before.get(m)) for m, s in sequences.items()}
    assert got == {**want, "idle": brute_force("dk")}


def test_limits_are_parameters(spark):
    log = events(spark, {"a": "dee", "b": "xx"})
    got = documents(ledger.fold_ledger(log, max_retries=2, max_dlq=1))
    assert got["a"][0] == "abandoned" and got["b"][0] == "abandoned"


def test_error_text_is_cut(spark):
    log = events(spark, {"a": "e"}).withColumn("message", F.repeat(F.lit("x"), 600))
    assert len(ledger.fold_ledger(log).first().last_error) == 500


def test_requeue(spark):
    folded = ledger.fold_ledger(events(spark, {"again": "de", "refused": "dr", "missing": "dn", "over": "deee", "dead": "deeex", "done": "dek"}))
    got = ledger.requeue(folded, F.lit("2024-01-01 06:30:00").cast("timestamp")).collect()
    assert {(r.match_id, r.batch_num, r.batch_id) for r in got} == {(m, 0, "20240101-0630-0") for m in ("again", "dead")}


def test_batch_outcomes(spark):
    before = spark.createDataFrame([("done", "success", 0), ("given up", "abandoned", 3), ("tired", "error", 2)], "match_id string, status string, retries long")
    rows = [("done", "fetch_ok", None), ("given up", "fetch_error", "t"), ("tired", "fetch_error", "t"), ("new", "fetch_ok", None), ("slow", "fetch_error", "t"), ("refused", "fetch_error", "403"), ("gone", "not_found", None)]
    attempts = spark.createDataFrame([("b", *r) for r in rows], "batch_id string, match_id string, kind string, message string")
    assert tuple(ledger.batch_outcomes(attempts, before).first()) == ("b", 1, 2, 2, 2, 1)


def test_status_counts(spark):
    counts = ledger.ledger_status_counts(ledger.fold_ledger(events(spark, NAMED))).collect()
    assert [r.status for r in counts] == sorted(r.status for r in counts) and sum(r.total for r in counts) == len(NAMED)


def test_stream_over_several_batches_equals_the_fold(spark, tmp_path):
    sequences = random_sequences(60, 24, 11)
    source, root = str(tmp_path / "events"), str(tmp_path / "ledger")
    table = LedgerTable(spark, root)
    log = events(spark, sequences)
    for low in range(0, 24, 6):  # arrival in the order of time, over four runs
        part = log.filter((F.col("seq") >= low) & (F.col("seq") < low + 6))
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.LEDGER_EVENT).parquet(source)
        stream_ledger(stream, table, str(tmp_path / "cp"), compact_every=2).awaitTermination()
    assert documents(table.current()) == {m: brute_force(s) for m, s in sequences.items()}
    assert (tmp_path / "ledger" / "full=1").exists()


def test_stream_goes_on_from_an_earlier_ledger(spark, tmp_path):
    sequences = {m: s + "dkxe" for m, s in random_sequences(20, 8, 3).items()}
    log, cut = events(spark, sequences), 4
    earlier = ledger.fold_ledger(log.filter(F.col("seq") < cut))
    earlier = earlier.unionByName(ledger.fold_ledger(events(spark, {"idle": "de"})))
    source, table = str(tmp_path / "events"), LedgerTable(spark, str(tmp_path / "ledger"))
    log.filter(F.col("seq") >= cut).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(schemas.LEDGER_EVENT).parquet(source)
    stream_ledger(stream, table, str(tmp_path / "cp"), initial=earlier).awaitTermination()
    assert documents(table.current()) == {m: brute_force(s) for m, s in (sequences | {"idle": "de"}).items()}


def test_stream_applies_odd_events_like_the_fold(spark, tmp_path):
    """Unknown kinds, NULLs, long texts, equal times; each id's events come in two micro-batches."""
    at = [None, START, START, START + timedelta(seconds=1)]
    kinds = ["fetch_error", "strange", None, "not_found", "dead_letter"]
    rows = [
        (f"m{i % 7}" if i % 11 else None, None if i % 5 == 0 else i, at[i % 4], kinds[i % 5], "x" * 498 + "401" if i % 3 else None)
        for i in range(80)
    ]
    log = spark.createDataFrame(rows, schemas.LEDGER_EVENT)
    source, table = str(tmp_path / "events"), LedgerTable(spark, str(tmp_path / "ledger"))
    want = None
    for low in (0, 40):
        part = log.filter((F.col("message").isNull()) == (low > 0))
        want = ledger.fold_ledger(part, want)
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.LEDGER_EVENT).parquet(source)
        stream_ledger(stream, table, str(tmp_path / "cp")).awaitTermination()
    assert documents(table.current()) == documents(want)


def test_a_micro_batch_reads_no_ledger(spark, tmp_path, monkeypatch):
    """What a batch reads are its own events; the documents come from the state store."""
    source, table = str(tmp_path / "events"), LedgerTable(spark, str(tmp_path / "ledger"))
    monkeypatch.setattr(LedgerTable, "current", lambda *a, **k: pytest.fail("the ledger is read"))
    for number, letters in enumerate(("de", "e", "k")):
        log = events(spark, {"a": letters}).withColumn("event_time", F.col("event_time") + F.expr(f"interval {number} days"))
        log.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.LEDGER_EVENT).parquet(source)
        query = stream_ledger(stream, table, str(tmp_path / "cp"))
        query.awaitTermination()
        assert query.exception() is None
        progress = query.lastProgress
        assert progress["numInputRows"] == len(letters) and progress["stateOperators"][0]["numRowsTotal"] == 1
    monkeypatch.undo()
    assert [r.status for r in table.current().collect()] == ["success"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_a_repeated_batch_counts_once(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path))
    for _ in range(2):
        before = table.current(before=0)
        table.write(ledger.fold_ledger(events(spark, {"a": "de"}), before), 0)
    assert documents(table.current()) == {"a": brute_force("de")}


def test_documents_beyond_the_limits_fold_alike_in_any_number_of_slices(spark):
    names = {"dead": "xxx", "errors": "eee", "both": "xexn", "settled": "ke", "again": "dxexx"}
    shape = "match_id string, status string, retries long, dlq_attempts long, last_error string"
    prior = spark.createDataFrame([(m, "error", 4, 5, "old") for m in names], shape)
    want = {m: brute_force(s, {"status": "error", "retries": 4, "dlq_attempts": 5, "last_error": "old"}) for m, s in names.items()}
    for slice_events in (1, 2, 1000):
        assert documents(ledger.fold_ledger(events(spark, names), prior, slice_events=slice_events)) == want


def test_chains_of_blocks_of_slices(spark, monkeypatch):
    monkeypatch.setattr(ledger, "BLOCK", 3)
    sequences = random_sequences(6, 60, 5)
    got = documents(ledger.fold_ledger(events(spark, sequences), slice_events=2))
    assert got == {m: brute_force(s) for m, s in sequences.items()}


def test_slices_of_few_events_take_no_more_ranges_than_shuffle_partitions(spark, monkeypatch):
    asked = []
    ranges = type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda df, n, *cols: asked.append(n) or ranges(df, n, *cols))
    sequences = random_sequences(40, 30, 9)
    got = documents(ledger.fold_ledger(events(spark, sequences), slice_events=2))
    assert got == {m: brute_force(s) for m, s in sequences.items()}
    assert asked and max(asked) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_events_without_an_id_count_for_nothing(spark):
    log = events(spark, {"a": "de"}).union(events(spark, {"x": "de"}).withColumn("match_id", F.lit(None).cast("string")))
    assert set(documents(ledger.fold_ledger(log, slice_events=1))) == {"a"}


def test_a_load_asks_only_for_its_own_ids(spark, tmp_path):
    first, second = events(spark, {"a": "de", "b": "de"}), events(spark, {"b": "e"})
    folded = ledger.fold_ledger(second, ledger.fold_ledger(first))
    assert {r.match_id for r in ledger.requeue(folded, touched=second).collect()} == {"b"}
    table = LedgerTable(spark, str(tmp_path))
    table.write(ledger.fold_ledger(first), 0)
    table.write(ledger.fold_ledger(second, table.current(before=1, ids=second.select("match_id").distinct())), 1)
    assert {r.match_id for r in table.requests(1).collect()} == {"b"}


def test_old_ledger_folders_go(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path))
    for n in range(6):
        table.write(ledger.fold_ledger(events(spark, {f"m{n}": "de"}), table.current(before=n)), n)
        if n % 2:
            table.write(table.current(before=n + 1), n, "full")
            table.tidy()
    assert set(documents(table.current())) == {f"m{n}" for n in range(6)}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["batch=3", "batch=4", "batch=5", "full=3", "full=5"]

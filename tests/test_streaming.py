"""Streamed landing, consume-once loads and streamed merges."""

import glob
import itertools
import os
import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from finlake.plans import models, spec
from finlake.sources import files, landing, raw, versions
from finlake.streaming import ledger, trades as stream

RUN_AT = datetime(2024, 5, 11)


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")


def message(i, symbol="BTCBRL"):
    return f'{{"stream":"x","data":{{"s":"{symbol}","t":{i}}}}}'


def land(spark, folder):
    messages = stream.read_messages(spark, f"{folder}/in", files_per_batch=1)
    stream.start_landing(messages, f"{folder}/landing", f"{folder}/cp", drain=True).awaitTermination()
    files = glob.glob(f"{folder}/landing/entity=*/year=*/month=*/day=*/hour=*/*.jsonl")
    return {f: sum(1 for _ in open(f)) for f in files}


def test_files_hold_at_most_500_messages(spark, folder):
    put(f"{folder}/in/a.txt", *(message(i) for i in range(750)), "not json", '{"t":1}')
    sizes = land(spark, folder)
    assert sorted(n for f, n in sizes.items() if "btcbrl_trades" in f) == [250, 500]
    assert [n for f, n in sizes.items() if "unknown_trades" in f] == [1]
    assert len(sizes) == 3


def test_rejected_messages_are_kept_and_counted(spark, folder):
    bad = ["not json", '{"s":5,"t":1}', "[1]"]
    put(f"{folder}/in/a.txt", message(1), *bad)
    land(spark, folder)
    found = stream.rejected(spark, f"{folder}/landing").orderBy("message").collect()
    assert [(r.message, r.reason, r.batch_id) for r in found] == [
        ("[1]", "no JSON object", 0), ("not json", "no JSON object", 0), ('{"s":5,"t":1}', "symbol is no text", 0),
    ]
    assert all(r.arrived is not None for r in found)
    put(f"{folder}/in/b.txt", message(2), "{")
    land(spark, folder)
    counts = stream.landed_counts(spark, f"{folder}/landing", f"{folder}/cp")
    assert counts == {0: {"landed": 1, "rejected": 3}, 1: {"landed": 1, "rejected": 1}}
    # A loader of the whole area takes what has landed only.
    stream.load_once(spark, f"{folder}/landing", f"{folder}/raw", f"{folder}/cp2", RUN_AT).awaitTermination()
    assert raw.read(spark, f"{folder}/raw").count() == 2


class Lost(RuntimeError):
    """The driver is gone."""


@pytest.mark.parametrize("step", ["stage", "staged", "move", "done"])
def test_a_repeated_batch_adds_nothing(spark, folder, monkeypatch, step):
    """Stopped while staging, before or after a note, or between two moves; then started again."""
    put(f"{folder}/in/a.txt", *(message(i, s) for i in range(20) for s in ("A", "B")), "not json")

    def stopped(real, after=0):
        calls = []

        def run(*args, **kw):
            calls.append(1)
            if len(calls) > after:
                raise Lost
            return real(*args, **kw)

        return run

    def run():
        land(spark, folder)
        stream.load_once(
            spark, f"{folder}/landing", f"{folder}/raw", f"{folder}/cp2", RUN_AT, remove_source=False
        ).awaitTermination()

    for part in ("land", "load"):
        with monkeypatch.context() as patched:
            if step == "stage":
                patched.setattr(ledger.Ledger, "note", stopped(ledger.Ledger.note))
            elif step == "staged":
                patched.setattr(ledger.Ledger, "note", stopped(ledger.Ledger.note, 0 if part == "land" else 2))
            elif step == "move":
                patched.setattr(files, "move", stopped(files.move, 1 if part == "land" else 3))
            else:
                patched.setattr(ledger.Ledger, "note", stopped(ledger.Ledger.note, 1))
            with pytest.raises(Exception, match="Lost"):
                run()
    run()
    now = datetime.now().date()
    scanned = landing.scan(spark, f"{folder}/landing", now.replace(day=1), now, hourly=True)
    assert scanned.count() == 40 and stream.rejected(spark, f"{folder}/landing").count() == 1
    assert raw.read(spark, f"{folder}/raw").count() == 40
    assert not glob.glob(f"{folder}/*/_ledger/staging/*")


def test_restart_lands_only_new_messages(spark, folder):
    put(f"{folder}/in/a.txt", message(1))
    land(spark, folder)
    put(f"{folder}/in/b.txt", message(2), message(3, "ETHBRL"))
    land(spark, folder)
    assert sum(land(spark, folder).values()) == 3
    now = datetime.now().date()
    scanned = landing.scan(spark, f"{folder}/landing", now.replace(day=1), now, hourly=True)
    assert scanned.count() == 3


def test_landed_files_are_loaded_once_and_removed_later(spark, folder):
    def load():
        query = stream.load_once(spark, f"{folder}/land", f"{folder}/raw", f"{folder}/cp", RUN_AT)
        query.awaitTermination()
        return sorted(r.payload for r in raw.read(spark, f"{folder}/raw").collect())

    first = f"{folder}/land/a/year=2024/month=05/day=10/a.jsonl"
    put(first, '{"a":1}', "", '  {"a":2} ')
    put(f"{folder}/land/a/year=2024/month=05/day=10/note.txt", "skip")
    assert load() == ['{"a":1}', '{"a":2}']
    assert load() == ['{"a":1}', '{"a":2}']
    for day in (11, 12):
        put(f"{folder}/land/a/year=2024/month=05/day={day}/a.jsonl", f'{{"a":{day}}}')
        load()
    assert load() == ['{"a":11}', '{"a":12}', '{"a":1}', '{"a":2}']
    assert not os.path.exists(first)


def test_streamed_merge_keeps_the_latest(spark, folder):
    def batch(name, *trades):
        lines = [
            (f'{{"e":"trade","E":{e},"s":"X","t":{t},"p":"{p}","q":"1","T":{at},"m":true}}',)
            for t, e, p, at in trades
        ]
        frame = spark.createDataFrame(lines, "payload string").select(
            "payload", F.lit("f").alias("_source_file"), F.lit(RUN_AT).alias("_ingested_at"),
            F.lit(RUN_AT.date()).alias("_load_date"),
        )
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def merged():
        arriving = spark.readStream.schema(raw.PAYLOAD_SCHEMA).parquet(f"{folder}/in")
        stream.start_merge(
            arriving, models.TRADES, f"{folder}/trades", f"{folder}/cp", RUN_AT
        ).awaitTermination()
        rows = versions.read(spark, f"{folder}/trades").collect()
        return sorted((r.trade_id, float(r.price)) for r in rows)

    day = 86_400_000
    batch("a", (1, 1704067211000, 10, 1704067211000), (2, 1704067212000, 20, 1704067212000))
    assert merged() == [(1, 10.0), (2, 20.0)]
    batch("b", (1, 1704067210000, 5, 1704067211000))  # older than what is stored
    assert merged() == [(1, 10.0), (2, 20.0)]
    batch("c", (2, 1704067219000, 21, 1704067212000 + day))  # newer, and on another day
    assert merged() == [(1, 10.0), (2, 21.0)]


def test_hourly_counts_follow_late_trades(spark, folder):
    def counts(*moments):
        rows = [(datetime(2024, 1, 1, h, m), "x") for h, m in moments]
        spark.createDataFrame(rows, "ts timestamp, s string").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema("ts timestamp, s string").parquet(f"{folder}/in")
        stream.start_hourly_counts(
            arriving, "ts", "s", f"{folder}/hours", f"{folder}/cp"
        ).awaitTermination()
        return sorted((r.hour_start.hour, r.n_trades) for r in versions.read(spark, f"{folder}/hours").collect())

    assert counts((1, 5), (1, 50), (2, 0)) == [(1, 2), (2, 1)]
    assert counts((1, 59), (3, 0)) == [(1, 3), (2, 1), (3, 1)]


def test_running_landing_closes_batches_by_age(spark, folder):
    put(f"{folder}/in/a.txt", message(1))
    messages = stream.read_messages(spark, f"{folder}/in")
    query = stream.start_landing(messages, f"{folder}/landing", f"{folder}/cp")
    landed = f"{folder}/landing/entity=btcbrl_trades/*/*/*/*/*.jsonl"
    try:
        give_up = time.time() + 40  # the first batch starts at once, the next a minute later
        while not glob.glob(landed) and time.time() < give_up:
            time.sleep(0.2)
        assert query.isActive
        trigger = query._jsq.streamingQuery().trigger()
        assert "60000" in trigger.toString()
    finally:
        query.stop()
    assert len(glob.glob(landed)) == 1


def test_files_of_a_batch_move_several_at_a_time(spark, folder, monkeypatch):
    put(f"{folder}/in/a.txt", *(message(i, s) for i in range(3) for s in ("A, B", "ETH%2F", "C D")))
    pair, begun, real = threading.Barrier(2, timeout=30), itertools.count(), files.move

    def move(*args, **kw):
        if next(begun) < 2:
            pair.wait()
        return real(*args, **kw)

    with monkeypatch.context() as patched:
        patched.setattr(files, "move", move)
        land(spark, folder)
    now = datetime.now().date()
    scanned = landing.scan(spark, f"{folder}/landing", now.replace(day=1), now, hourly=True)
    assert scanned.count() == 9


def test_a_batch_of_one_file_is_dealt_out_before_it_is_parsed(spark, folder, monkeypatch):
    rows = spark.range(2_000).select(
        F.concat(F.lit('{"T":1,"E":1,"t":'), "id", F.lit("}")).alias("payload"), F.lit("f").alias("_source_file"),
        F.lit(RUN_AT).alias("_ingested_at"), F.lit(RUN_AT.date()).alias("_load_date"),
    )
    rows.coalesce(1).write.parquet(f"{folder}/in")
    plans = []

    def build(batch, *args):
        plans.append(batch._jdf.queryExecution().optimizedPlan().toString())
        return spec.build(batch, *args)

    monkeypatch.setattr(stream, "build", build)
    arriving = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    stream.start_merge(arriving, models.TRADES, f"{folder}/t", f"{folder}/cp", RUN_AT).awaitTermination()
    assert plans and all("RepartitionByExpression" in plan for plan in plans)
    assert versions.read(spark, f"{folder}/t").count() == 2_000

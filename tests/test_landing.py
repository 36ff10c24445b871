"""Landing areas, raw tables and envelopes."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from finlake.functions import payload as P
from finlake.operators import audit
from finlake.sources import envelopes, files, landing, raw

RUN_AT = datetime(2024, 5, 11, 3, 0)


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(data if isinstance(data, bytes) else data.encode())


def texts(frame):
    return sorted(r.payload for r in frame.collect())


def test_plain_folders_with_blank_padded_and_broken_lines(spark, folder):
    day = "year=2024/month=05/day=10"
    put(f"{folder}/dealers/{day}/dealers.jsonl", '{"a":1}\n\n  {"a":2}  \n\t{"a":3}\t\r\n \t\n')
    put(f"{folder}/dealers/{day}/notes.txt", '{"a":99}\n')
    put(f"{folder}/resultados/{day}/resultados_2023.jsonl", '{"b":1}\n')
    put(f"{folder}/resultados/{day}/resultados_2024.jsonl", b'{"b":"x\xff"}\n')
    put(f"{folder}/editais/{day}/editais.jsonl", "")
    put(f"{folder}/dealers/year=2024/month=05/day=11/dealers.jsonl", '{"a":4}\n')
    names = ["dealers", "resultados", "editais", "portarias"]
    found = landing.scan_folders(spark, folder, names, date(2024, 5, 10), repair_utf8=True)
    assert texts(found) == ['{"a":1}', '{"a":2}', '{"a":3}', '{"b":"x�"}', '{"b":1}']
    assert {r.entity for r in found.collect()} == {"dealers", "resultados"}
    assert {(r.month, r.day) for r in found.collect()} == {("05", "10")}
    assert all(r._source_file.endswith(".jsonl") for r in found.collect())
    both = landing.scan_folders(spark, folder, ["dealers"], date(2024, 5, 10), date(2024, 5, 11))
    assert texts(both) == ['{"a":1}', '{"a":2}', '{"a":3}', '{"a":4}']


def test_hourly_folders(spark, folder):
    for hour in ("00", "13"):
        put(f"{folder}/btcbrl_trades/year=2024/month=05/day=10/hour={hour}/trades_1.jsonl", f'{{"h":"{hour}"}}')
    found = landing.scan_folders(spark, folder, ["btcbrl_trades"], date(2024, 5, 10), hourly=True)
    assert sorted(r.hour for r in found.collect()) == ["00", "13"]


def test_absent_area(spark, folder):
    assert landing.scan(spark, f"{folder}/none", date(2024, 5, 10)).count() == 0
    assert landing.scan(spark, f"{folder}/none", date(2024, 1, 1), date(2024, 12, 31)).count() == 0


def records(spark, rows):
    frame = spark.createDataFrame(rows, "entity string, day_ date, payload string")
    return landing.with_path_parts(frame, "day_")


def test_write_replaces_the_days_it_has_and_keeps_text(spark, folder):
    line = '{"t":"aspas \\" e \\\\ barra, ção","n":[1,2]}'
    first = [("a", date(2024, 5, 1), line), ("a", date(2024, 5, 2), "two"), ("b", date(2024, 5, 1), " # b")]
    landing.write(records(spark, first), folder)
    landing.write(records(spark, [("a", date(2024, 5, 2), "three")]), folder)
    landing.write(records(spark, []), folder)
    names = [f for _, _, fs in os.walk(folder) for f in fs if f.startswith("part-")]
    assert len(names) == 3 and all(n.endswith(".jsonl") for n in names)
    assert texts(landing.scan(spark, folder, date(2024, 5, 1), date(2024, 5, 31))) == [
        "# b", "three", line,
    ]
    assert os.path.isdir(f"{folder}/entity=a/year=2024/month=05/day=01")


def test_plain_folder_round_trip(spark, folder):
    frame = records(spark, [("x", date(2024, 5, 1), "a"), ("x", date(2024, 5, 2), "b")])
    for _ in range(2):
        landing.write_folder(frame, folder, "dealers")
    assert os.path.isdir(f"{folder}/dealers/year=2024/month=05/day=02")
    found = landing.scan_folders(spark, folder, ["dealers", "none"], date(2024, 5, 1), date(2024, 5, 2))
    assert texts(found) == ["a", "b"]


def test_year_suffix_becomes_a_folder(spark, folder):
    frame = records(spark, [("resultados", date(2024, 5, 1), "x"), ("resultados", date(2024, 5, 1), "y")])
    frame = frame.withColumn("ref_year", F.when(F.col("payload") == "x", "2023").otherwise("2024"))
    landing.write(frame, folder, extra_parts=["ref_year"])
    found = landing.scan(spark, folder, date(2024, 5, 1), extra_parts=["ref_year"])
    assert sorted((r.ref_year, r.payload) for r in found.collect()) == [("2023", "x"), ("2024", "y")]


def test_long_and_short_ranges_agree(spark, folder):
    rows = [("a", date(2024, m, 1), f"m{m}") for m in range(1, 13)]
    landing.write(records(spark, rows), folder)
    long = landing.scan(spark, folder, date(2024, 2, 1), date(2024, 11, 30))
    assert texts(long) == sorted(f"m{m}" for m in range(2, 12))
    assert "PartitionFilters: [" in long._jdf.queryExecution().executedPlan().toString()
    short = landing.scan(spark, folder, date(2024, 2, 1), date(2024, 3, 31))
    assert texts(short) == ["m2", "m3"]


def landed(spark, values, endpoint="e"):
    return spark.createDataFrame(
        [(v, endpoint, "f.jsonl") for v in values], "payload string, entity string, _source_file string"
    )


def test_append_counts_in_the_same_pass(spark, folder):
    rows = raw.wrap(landed(spark, "abc"), RUN_AT, "entity").unionByName(
        raw.wrap(landed(spark, "d", "g"), RUN_AT, "entity")
    )
    assert raw.append(rows, folder, count_by=["e", "g", "h"]) == {"total": 4, "e": 3, "g": 1, "h": 0}
    raw.append(rows, folder)
    stored = raw.read(spark, folder, multiplexed=True)
    assert stored.schema == raw.MULTIPLEXED_SCHEMA
    assert stored.count() == 8
    assert stored.select("_ingested_at", "_load_date").distinct().collect() == [(RUN_AT, RUN_AT.date())]


def test_append_of_nothing(spark, folder):
    assert raw.append(raw.wrap(landed(spark, []), RUN_AT), folder) == {"total": 0}
    nothing = raw.wrap(landed(spark, "a"), RUN_AT).where(F.lit(False))
    assert raw.append(nothing, folder) == {"total": 0}
    assert not files.has_data(spark, folder)
    assert raw.read(spark, folder).count() == 0


def test_lookback_start(monkeypatch):
    monkeypatch.delenv("REFERENCE_DATE", raising=False)
    assert raw.lookback_start(date(2024, 5, 10), "2024-02-03") == date(2024, 2, 3)
    assert raw.lookback_start(date(2024, 5, 10)) == date(2024, 5, 8)
    assert raw.lookback_start(date(2024, 5, 10), days=0) == date(2024, 5, 10)
    monkeypatch.setenv("REFERENCE_DATE", "2024-03-01")
    assert raw.lookback_start(date(2024, 5, 10)) == date(2024, 3, 1)
    assert raw.lookback_start(date(2024, 5, 10), date(2024, 1, 1)) == date(2024, 1, 1)


def test_retention_edges(spark, folder):
    as_of = date(2024, 5, 10)
    for age in (89, 90, 91, 200):
        at = datetime.fromordinal(as_of.toordinal() - age)
        raw.append(raw.wrap(landed(spark, [str(age)]), at), folder)
    stored = raw.read(spark, folder)
    assert texts(raw.unexpired(stored, as_of)) == ["89", "90"]
    assert raw.expire(spark, folder, as_of) == ["2023-10-23", "2024-02-09"]
    assert texts(raw.read(spark, folder)) == ["89", "90"]


def pages(spark, *texts_):
    return spark.createDataFrame([(t,) for t in texts_], "page string")


def test_value_pages(spark):
    found = envelopes.value_records(
        pages(spark, '{"value":[{"a":1.50,"é":"ç"},{"a":12345678901234567.123456789}]}', '{"value":[]}', "{}")
    )
    assert texts(found) == ['{"a":1.5,"é":"ç"}', '{"a":12345678901234567.123456789}']


def test_status_pages(spark):
    good = pages(spark, '{"status":"ok","registros":[{"a":1}]}', '{"status":"ok","registros":[]}', '{"status":"ok"}')
    bad = pages(spark, '{"status":"erro","registros":[{"a":2}]}', '{"registros":[{"a":3}]}')
    assert texts(envelopes.status_records(good)) == ['{"a":1}']
    with pytest.raises(Exception, match="unexpected response status"):
        envelopes.status_records(good.unionByName(bad)).collect()
    both = good.unionByName(bad)
    assert texts(envelopes.status_records(both, fail_fast=False)) == ['{"a":1}']
    assert {r.status for r in envelopes.rejected_pages(both).collect()} == {"erro", None}


@pytest.mark.parametrize(
    "message, expected",
    [
        ('{"stream":"x","data":{"s":"BTCBRL","t":1}}', ("btcbrl", '{"s":"BTCBRL","t":1}')),
        ('{"s":"ETHBRL","t":2}', ("ethbrl", '{"s":"ETHBRL","t":2}')),
        ('{"t":3}', ("unknown", '{"t":3}')),
        ('{"data":{"t":4}}', ("unknown", '{"t":4}')),
        ('{"t":', None),
        ("[1]", None),
        ("5", None),
        ('{"data":null}', None),
        ('{"s":null}', None),
        ('{"s":7}', None),
    ],
)
def test_stream_messages(spark, message, expected):
    frame = spark.createDataFrame([(message,)], "message string")
    got = [tuple(r) for r in envelopes.unwrap_messages(frame).collect()]
    lost = envelopes.unreadable_messages(frame).count()
    assert (got, lost) == (([expected], 0) if expected else ([], 1))


def test_parsed_numbers_survive_the_envelope(spark):
    found = envelopes.value_records(pages(spark, '{"value":[{"v":0.00001200}]}'))
    assert found.select(P.scalar(P.parse("payload"), "$.v").cast("decimal(38,9)")).first()[0] is not None


def test_entities_fail_alone_or_stop_the_run(spark, folder):
    def load(name):
        if name == "bad":
            raise ValueError("no such endpoint")
        return 3

    outcomes = audit.run_entities(spark, ["a", "bad", "c"], load)
    run = audit.Run("p", "market", "landing", date(2024, 5, 10))
    log = audit.log_rows(outcomes, run, RUN_AT)
    assert log.schema.fieldNames() == audit.LOG_SCHEMA.fieldNames()
    assert audit.write_log(log, folder)
    stored = spark.read.schema(audit.LOG_SCHEMA).parquet(folder)
    assert [(r.entity, r.error_message) for r in audit.failures(stored).collect()] == [
        ("bad", "no such endpoint")
    ]
    status = audit.run_summary(stored, ["reference_date"]).first()
    assert (status.total_records, status.failed_entities, status.outcome) == (6, ["bad"], "partial failure")
    assert stored.select("log_id").distinct().count() == 3
    with pytest.raises(ValueError):
        audit.run_entities(spark, ["a", "bad"], load, fail_fast=True)


def test_log_failure_does_not_raise(spark, folder):
    put(f"{folder}/blocked", "x")
    outcomes = audit.run_entities(spark, ["a"], lambda _: 1)
    rows = audit.log_rows(outcomes, audit.Run("p", "m", "raw", date(2024, 5, 10)), RUN_AT)
    assert audit.write_log(rows, f"{folder}/blocked") is False

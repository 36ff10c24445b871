"""Operators on prepared inputs, at the test tables' rows and at ten times as many.

    python tools/growth.py [--sf /root/testdata/sf0.1] [--times 10] [name ...]

Inputs are written before the clock starts; each operator runs once at each size after a warm-up, and its rows are produced in
full and dropped. Prints one JSON line: seconds per operator and size, and rows.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finlake.operators import periods, rolling  # noqa: E402
from finlake.operators.merge import merge_into, range_of_key  # noqa: E402
from finlake.plans import models, refined  # noqa: E402
from finlake.plans.spec import build  # noqa: E402
from finlake.session import build_session, job_dir  # noqa: E402
from finlake.sources import raw, versions  # noqa: E402
from workloads import standins as S  # noqa: E402
from workloads.loading import RUN_AT  # noqa: E402

BOND = ["titulo", "data_vencimento"]


def held(frame: DataFrame, name: str) -> DataFrame:
    path = job_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


class Inputs:
    """Auctions and trades, ``times`` over, with numbers of their own; periods and calendar as they are."""

    def __init__(self, spark: SparkSession, sf_dir: str, times: int):
        copy = F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("copy")
        number = (F.col("num_edital") * times + F.col("copy")).alias("num_edital")
        auctions = S.auctions(spark, sf_dir).select("*", copy)
        self.spark = spark
        self.auctions = held(auctions.select(number, *[c for c in auctions.columns if c not in ("num_edital", "copy")]), "auctions")
        self.periods = held(S.periods(spark, sf_dir), "periods")
        self.calendar = held(S.calendar(spark, sf_dir), "calendar")
        payload = F.regexp_replace("payload", '"t":([0-9]+)', F.concat(F.lit('"t":$1'), F.lpad("copy", 2, "0")))
        trades = S.raw_trades(spark, sf_dir).select("*", copy).withColumn("payload", payload).drop("copy")
        self.trades = job_dir(spark, "raw")
        raw.append(trades, self.trades)


def interval_join(x: Inputs) -> DataFrame:
    return periods.interval_join(x.auctions, x.periods, BOND, "data_leilao", "data_inicio", "data_termino")


def latest_period(x: Inputs) -> DataFrame:
    return refined.benchmark_periods(x.auctions, x.periods)


def rolling_rate(x: Inputs) -> DataFrame:
    cut = rolling.with_buckets(x.auctions, ["titulo"], "data_leilao", "num_edital")
    return rolling.rolling_means(cut, ["titulo"], "data_leilao", "num_edital", {"m": "pct_taxa_media"})


def enrich(x: Inputs) -> DataFrame:
    return refined.enrich(x.auctions, x.calendar, x.periods)


def typed_trades(x: Inputs) -> DataFrame:
    return build(raw.read(x.spark, x.trades), models.TRADES, RUN_AT)


def merge_recent(x: Inputs) -> DataFrame:
    """A hundredth of the auctions, the ones of highest number, merged into all."""
    path = job_dir(x.spark, "merged")
    rows = x.auctions.withColumn("_range", range_of_key("num_edital", 10_000))
    merge_into(x.spark, path, rows, "num_edital", "_range", key_fixes_partition=True)
    top = rows.agg(F.max("num_edital")).first()[0]
    merge_into(x.spark, path, rows.where(F.col("num_edital") > top * 99 // 100), "num_edital", "_range", key_fixes_partition=True)
    return versions.read(x.spark, path).select("num_edital")


OPERATORS = [interval_join, latest_period, rolling_rate, enrich, typed_trades, merge_recent]


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.1")
    parser.add_argument("--times", type=int, default=10)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "growth", f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, dict[str, float]] = {}
    rows = {}
    for label, times in (("warm-up", 1), ("1", 1), (str(args.times), args.times)):
        inputs = Inputs(spark, args.sf, times)
        rows[label] = inputs.auctions.count()
        for operator in OPERATORS:
            if args.names and operator.__name__ not in args.names:
                continue
            started = time.perf_counter()
            operator(inputs).write.format("noop").mode("overwrite").save()
            seconds.setdefault(operator.__name__, {})[label] = round(time.perf_counter() - started, 2)
    for spent in seconds.values():
        del spent["warm-up"]
    print(json.dumps({"seconds": seconds, "auctions": rows, "sf": args.sf}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the twelve pipeline stages and the ten reports; print one JSON line.

Uploads (CSV) and landed weather documents are prepared from the driver tables
first and are not timed. Each stage then reads and writes a lake in the shared
scratch folder, and the reports read its gold tables. The first round warms the
JVM up; the second one, in a new lake, is reported.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from catalog import fixtures
from weathermart.plans import pipeline, reports
from weathermart.sources.paths import scratch_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = 2


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("weathermart-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> tuple[str, str]:
    uploads, landing = scratch_dir(spark), scratch_dir(spark)
    fixtures.write_csv(fixtures.upload_text(fixtures.raw_sales(spark, SF_DIR)), uploads)
    weather = fixtures.raw_weather(spark, SF_DIR)
    fixtures.write_payloads(fixtures.weather_payloads(weather), landing)
    return uploads, landing


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def one_round(spark: SparkSession, uploads: str, landing: str) -> dict[str, float]:
    lake = pipeline.Lake(
        root=scratch_dir(spark),
        uploads=uploads,
        landing=landing,
        options=fixtures.FIXTURE_OPTIONS,
    )
    seconds = {
        f"stage_{name}": timed(lambda name=name: pipeline.run(spark, lake, [name]))
        for name in pipeline.STAGES
    }
    for name, report in reports.GOLD_REPORTS.items():
        seconds[f"report_{name}"] = timed(
            lambda report=report: report(lake.read(spark, "gold_sales_weather")).collect()
        )
    seconds["report_rainy_products"] = timed(
        lambda: reports.rainy_products(lake.read(spark, "fact_sales_weather_product")).collect()
    )
    return seconds


def main() -> None:
    spark = session()
    uploads, landing = prepare(spark)
    for _ in range(ROUNDS):
        seconds = one_round(spark, uploads, landing)
    print(
        json.dumps(
            {
                "metric": "pipeline stages and reports, warm, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

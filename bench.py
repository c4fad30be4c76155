"""Times the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from newszones.plans import inputs, zones
from newszones.plans.catalog import QUERIES
from newszones.sources import tables as tb
from newszones.sources.storage import shared_dir

HEADLINE = [
    "articles_per_url_source", "extract_rules", "html_first_and_all", "clean_description", "parse_fecha",
    "source_from_url", "dedupe_first_wins", "dedupe_against_history", "known_articles", "upsert_do_nothing",
    "load_report", "articles_per_day", "articles_per_source", "top10_sections", "latest_20",
]


def timed(run) -> float:
    run()
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("newszones-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        seconds[name] = timed(
            lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    root = tempfile.mkdtemp(prefix="bench-", dir=shared_dir(spark) if os.path.isdir(shared_dir(spark)) else None)
    rows = inputs.raw_articles(spark, sf_dir)
    raw = f"{root}/raw"
    rows.write.parquet(raw)
    landing, tables, keys = spark.read.parquet(raw), tb.ZoneTables(f"{root}/zones"), iter("ab")
    seconds["zone_batch"] = timed(lambda: zones.run_batch(
        spark, landing, tables, next(keys), as_of=inputs.as_of(), processed_at=F.current_timestamp()))
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line of seconds."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from weblathe.plans import catalog

HEADLINE = (
    "referrer_parse", "count_domain_day", "count_fulldomain_month", "count_code_day", "count_doi_month_cutoff", "grouped_fulldomains",
    "code_table_day", "domain_filtered_day", "topn_fulldomain_month_long", "chunk_bucket_doi", "chunk_roundtrip", "order_months_topn",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    def run(name: str) -> float:
        began = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
        return round(time.time() - began, 3)

    seconds = {name: run(name) for name in HEADLINE}
    # the first query also pays for the session's first classes and code; this is the same plan once more
    warm = run("referrer_parse")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    out = {"metric": "total of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf")}
    out |= {"events": rows, "parsed_rows_per_sec": round(rows / seconds["referrer_parse"]), "parsed_rows_per_sec_warm": round(rows / warm)}
    print(json.dumps(out))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()

"""The four stages end to end on generated logs, and their properties."""

import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from weblathe.operators import analysis, metrics
from weblathe.operators.filters import ListedDomains
from weblathe.operators.suffix import FALLBACK_RULES, SuffixRules
from weblathe.plans import stages
from weblathe.sources import chunks, logs
from weblathe.streaming import stream_counts


def _line(date, doi, referrer):
    return f'1.2.3.4 HTTP:HDL "{date}" 1 1 23ms {doi} "200:0.na/10.1" "{referrer}"'


@pytest.fixture(scope="module")
def base(tmp_path_factory, spark):
    path = tmp_path_factory.mktemp("base")
    (path / "logs").mkdir()
    rows = []
    for k in range(60):
        rows.append(_line(f"2015-{1 + k % 2:02d}-{1 + k % 28:02d} 03:10:43.247Z", f"10.1/{'A' if k % 3 else 'b'}", ("http://www.example.com/a", "https://x.y.co.uk/p?q", "", "http://doi.org/1", "http://wiki/x")[k % 5]))
    rows += ["9.9.9.9 HTTP:OpenURL x", "junk"]
    with gzip.open(path / "logs/access_log-201501-a.gz", "wt") as f:
        f.write("\n".join(rows))
    with gzip.open(path / "logs/other.gz", "wt") as f:
        f.write(rows[0])
    counts = stages.process(spark, str(path))
    assert (counts["total_lines"], counts["failed_lines"], counts["open_url_ignores"]) == (62, 2, 1)
    assert [(r["value"], r["reason"]) for r in spark.read.parquet(f"{path}/quarantine").collect()] == [("junk", "malformed")]
    stages.aggregate(spark, str(path))
    stages.analyze(spark, str(path), domains=("doi.org", "unknown.special"))
    stages.distribute(spark, str(path))
    return str(path)


def test_records(spark, base):
    records = logs.read_records(spark, f"{base}/processed")
    assert records.count() == 60
    assert {r["year_month"] for r in records.collect()} == {"2015-01", "2015-02"}
    row = records.filter("full_domain = 'x.y.co.uk'").first()
    assert (row["domain"], row["subdomains"], row["code"], row["path"]) == ("y.co.uk", "x", "S", "/p")


def test_months_are_not_written_twice(spark, base):
    before = logs.read_records(spark, f"{base}/processed").count()
    assert stages.process(spark, base)["stored_skips"] == 60
    stages.aggregate(spark, base)
    assert logs.read_records(spark, f"{base}/processed").count() == before
    assert spark.read.parquet(f"{base}/aggregated/day-all").agg(F.sum("count")).first()[0] == before


def test_stored_months_are_pruned(spark, base, tmp_path):
    """A second run reads the folders of new months only, and gives what one run over everything gives."""
    records = logs.read_records(spark, f"{base}/processed")
    first, every = records.filter("year_month = '2015-01'"), str(tmp_path / "every")
    logs.write_records(first, str(tmp_path / "processed"))
    stages.aggregate(spark, str(tmp_path), cutoff=2)
    logs.write_records(records, str(tmp_path / "processed"))
    plan = stages.fresh_identifiers(logs.read_records(spark, str(tmp_path / "processed")), f"{tmp_path}/aggregated/month-doi", 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and "2015-01" in plan.split("PartitionFilters")[1]
    stages.aggregate(spark, str(tmp_path), cutoff=2)
    records.write.partitionBy("year_month").parquet(f"{every}/processed")
    stages.aggregate(spark, every, cutoff=2)
    for name in metrics.METRICS:
        twice, once = (sorted(map(str, spark.read.parquet(f"{p}/aggregated/{name}").collect())) for p in (str(tmp_path), every))
        assert twice == once and twice


def test_months_are_sums_of_days(spark, base):
    days, months = (spark.read.parquet(f"{base}/aggregated/{g}-domain").groupBy("key").agg(F.sum("count").alias("n")).collect() for g in ("day", "month"))
    assert sorted(days) == sorted(months)


def test_filtered_is_within_unfiltered(spark, base):
    kept, every = (chunks.read_counts(spark, f"{base}/analyzed/day-{f}-domain.csv-chunks") for f in ("filtered", "unfiltered"))
    assert kept.exceptAll(every).isEmpty()
    assert {r["key"] for r in every.collect()} - {r["key"] for r in kept.collect()} == {"doi.org", "unknown.special"}


def test_wide_tables(spark, base):
    table = spark.read.option("header", True).csv(f"{base}/analyzed/day-top-10-unfiltered-domains.csv")
    assert table.columns[0] == "Date" and set(table.columns[1:]) == {"example.com", "y.co.uk", "unknown.special", "doi.org"}
    codes = spark.read.option("header", True).csv(f"{base}/distribute/month-code.csv")
    assert sum(int(v) for r in codes.collect() for v in r[1:]) == 60


def test_every_key_is_in_its_bucket(spark, base):
    seen = {}
    for folder in glob.glob(f"{base}/distribute/month-doi.csv-chunks/bucket=*"):
        for row in chunks.read_chunks(spark, folder).select("key").distinct().collect():
            assert row["key"] not in seen
            seen[row["key"]] = folder.rpartition("=")[2]
    assert seen == {k: hashlib.md5(k.encode()).hexdigest().upper()[:4] for k in ("10.1/a", "10.1/b")}


def test_chunk_round_trip(spark, tmp_path):
    rows = [("k1", "2015-01-01", 4), ("k1", "2015-01-02", 5), ("é", "2015-01-01", 1)]
    df = spark.createDataFrame(rows, "key string, date string, count bigint")
    chunks.write_chunks(df, str(tmp_path / "c"))
    assert sorted(map(tuple, chunks.read_counts(spark, str(tmp_path / "c")).collect())) == sorted(rows)
    with pytest.raises(Exception, match="needs a key"):
        chunks.write_chunks(spark.createDataFrame([("", "2015-01-01", 1)], df.schema), str(tmp_path / "d"))


def test_hot_keys_become_several_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chunks, "HOT", 50)
    rows = [("hot", f"{2000 + k // 12}-{1 + k % 12:02d}-01", k) for k in range(300)] + [("b", "2015-01-01", 1), ("a", "2015-01-01", 2)]
    df = spark.createDataFrame(rows, "key string, date string, count bigint")
    chunks.write_chunks(df, str(tmp_path / "c"))
    assert sorted(map(tuple, chunks.read_counts(spark, str(tmp_path / "c")).collect())) == sorted(rows)
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "c")).collect()]
    assert lines.count("hot") == 300 and lines.count("a") == 1
    chunks.write_buckets(df, str(tmp_path / "d"), 3)
    assert sorted(map(tuple, chunks.read_counts(spark, str(tmp_path / "d")).collect())) == sorted(rows)


def test_dates_in_any_session_zone(spark):
    from weblathe.functions import dates

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for own in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", own)
            ts = dates.parse_date(F.col("d"), check_weekday=True)
            df = spark.createDataFrame([("2016-01-05 23:55:23.962-0500",), ("Tue Jan 05 20:55:23 EST 2016",), ("1969-12-31 23:00:00.000Z",), ("x",)], "d string")
            assert [tuple(r) for r in df.select(dates.day(ts), dates.year_month(ts)).collect()] == [("2016-01-06", "2016-01"), ("2016-01-06", "2016-01"), ("1969-12-31", "1969-12"), (None, None)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_layouts_are_broadcast(spark, base):
    """Raw lines are not shuffled by file."""
    from weblathe.functions import lines

    plan = lines.parse_lines(logs.read_logs(spark, f"{base}/logs"))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_record_text_round_trip(spark, tmp_path, base):
    logs.write_record_text(logs.read_records(spark, f"{base}/processed").limit(5), str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).count() == 5
    (tmp_path / "r").mkdir()
    with gzip.open(tmp_path / "r/2015-01.gz", "wt") as f:
        f.write("2015-01-01\t10.1/x\tH\tx.org\t\tx.org\t/\nshort\trow\n")
    assert [tuple(r) for r in logs.read_record_text(spark, str(tmp_path / "r")).collect()] == [("2015-01-01", "10.1/x", "H", "x.org", "", "x.org", "/")]


def test_plain_counts(spark, tmp_path):
    chunks.write_counts(spark.createDataFrame([("2015-01-02", 1), ("2015-01-01", 2)], "date string, count bigint"), str(tmp_path / "c"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "c")).collect()] == ["2015-01-01,2", "2015-01-02,1"]


def test_cutoff(spark):
    rows = [("a", "2015-01-01")] * 4 + [("b", "2015-01-31")] * 5 + [("c", "2015-01-01")] * 3 + [("c", "2015-02-01")] * 3
    counts = metrics.doi_counts(spark.createDataFrame(rows, "doi string, date string"))
    assert [tuple(r) for r in counts.collect()] == [("b", "2015-01-01", 5)]


def test_top_n_ties_go_by_name(spark):
    df = spark.createDataFrame([("z", "d1", 5), ("a", "d1", 5), ("b", "d1", 5), ("a", "d2", 1), ("z", "d2", 9)], "key string, date string, count bigint")
    table = analysis.top_n_table(df, 1)
    assert table.columns == ["Date", "z", "a"] and [tuple(r) for r in table.collect()] == [("d1", 5, 5), ("d2", 9, 1)]
    assert analysis.top_n(df, 1).count() == 4
    assert analysis.top_n_table(df.limit(0), 3).count() == 0


def test_filter_files_and_unmatched_hosts(spark, tmp_path):
    (tmp_path / "list.txt").write_text("Example.COM\n")
    flt = ListedDomains.build(spark, FALLBACK_RULES, domains=("doi.org", "unknown.special"), files=(str(tmp_path / "list.txt"), str(tmp_path / "none.txt")))
    df = spark.createDataFrame([(k,) for k in ("a.example.com", "EXAMPLE.com", "wiki", "local.special", "unknown.special", "x.org")], "key string")
    assert {r["key"] for r in flt.keep(df, "key").collect()} == {"wiki", "local.special", "x.org"}


def test_missing_folder_raises(spark, tmp_path):
    with pytest.raises(ValueError):
        logs.read_logs(spark, str(tmp_path / "none"))


def test_stream_matches_batch(spark, base, tmp_path):
    rules = SuffixRules.build(spark, FALLBACK_RULES)
    counts = stream_counts(spark, f"{base}/logs", rules)
    query = counts.writeStream.outputMode("complete").format("memory").queryName("stream_out").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("stream_out").agg(F.sum("count")).first()[0] == 61

"""Landing folders, sinks, streaming and the session rules."""

import json

import pytest

from listinglake import fixed_values as fv
from listinglake import schemas, session
from listinglake.plans.normalize import all_quarantined, search_tables
from listinglake.sources import sinks
from listinglake.sources.landing import read_pages, read_responses
from listinglake.streaming import landing_stream


def twiddy_page(*ids):
    return json.dumps({"results": [{"propertyId": i, "bedrooms": "3 beds"} for i in ids]})


@pytest.fixture()
def landing(landed, tmp_path):
    path = str(tmp_path / "landing")
    rows = landed(
        (fv.TWIDDY, "search", twiddy_page(1, 2), {"params": {"town": "duck"}}),
        (fv.TWIDDY, "info", "{}"),
        (fv.CREXI, "search", '{"data": []}'),
    )
    rows.write.partitionBy("source", "kind").parquet(path)
    return path


def test_read_responses_prunes_folders(spark, landing):
    df = read_responses(spark, landing, fv.TWIDDY, "search")
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan
    assert [r.listing_id for r in search_tables(df, fv.TWIDDY).rows.collect()] == [1, 2]
    assert read_responses(spark, landing).count() == 3


def test_read_pages_takes_whole_files(spark, tmp_path):
    for name in ("a-1", "b"):
        (tmp_path / f"{name}.html").write_text(f"<p>\n{name}\n</p>")
    rows = read_pages(spark, str(tmp_path), fv.SUNREALTY, "details").collect()
    assert sorted((r.entity_id, r.body) for r in rows) == [
        ("a-1", "<p>\na-1\n</p>"), ("b", "<p>\nb\n</p>")]
    assert [f.name for f in read_pages(spark, str(tmp_path), "s", "k").schema] == [
        f.name for f in spark.createDataFrame([], schemas.RESPONSES).schema]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "`7-Night Total` int, URL string")
    sinks.write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 1
    sinks.write_report({"picks": df}, str(tmp_path / "csv"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv/picks")).columns == df.columns
    sinks.write_report({"picks": df}, str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq/picks")).columns == df.columns
    silver = spark.createDataFrame([("s", "duck", 1)], "source string, town string, x int")
    sinks.write_silver(silver, str(tmp_path / "silver"))
    assert (tmp_path / "silver/source=s/town=duck").is_dir()


def test_quarantine_over_sources(landed):
    rows = landed((fv.TWIDDY, "search", "{}"), (fv.CREXI, "search", "[]"), (fv.TWIDDY, "info", "{}"))
    got = {(r.source, r.kind, r.drift) for r in all_quarantined(rows, [fv.TWIDDY, fv.CREXI]).collect()}
    assert got == {
        (fv.TWIDDY, "search", "missing results"), (fv.CREXI, "search", "missing data list"),
        (fv.TWIDDY, "info", "missing propertyID")}


def test_stream_appends_new_pages_once(spark, landed, tmp_path):
    land, out = str(tmp_path / "in"), str(tmp_path / "out")
    for ids in ((1, 2), (3,)):
        landed((fv.TWIDDY, "search", twiddy_page(*ids))).write.mode("append").parquet(land)
        rows = landing_stream.stream_listings(
            landing_stream.stream_responses(spark, land), fv.TWIDDY
        )
        landing_stream.write_listings(rows, out, tmp_path.name).awaitTermination(120)
    assert sorted(r.listing_id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_checkpoint_dir_is_the_cluster_setting(spark):
    assert session.checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_body_is_parsed_once(landed):
    """Rows come from one scan and one parse; no filter repeats the parse."""
    rows = search_tables(landed((fv.TWIDDY, "search", twiddy_page(1))), fv.TWIDDY).rows
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1

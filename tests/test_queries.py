"""Every registered query against its SQL; also the shape of the registry."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from listinglake.workload import json_sources

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, tables, name):
    _, problems = oracle.compare(
        entry.queries()[name](spark, SF_DIR), tables, entry.oracle_sql()[name]
    )
    assert problems == []


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["listing_id", "name"]
    assert df.count() > 0


def test_silver_holds_all_rows_of_both_sources(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(json_sources, "_folder", lambda spark, name: str(tmp_path / name))
    back = json_sources.silver_round_trip(spark, SF_DIR)
    assert back.count() == spark.read.parquet(f"{tmp_path}/silver/source=crexi").count() > 0
    homes = json_sources.normalize_redfin_search(spark, SF_DIR).count()
    assert homes > 0 and spark.read.parquet(f"{tmp_path}/silver/source=redfin").count() == homes

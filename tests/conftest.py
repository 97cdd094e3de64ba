import sys
from collections import Counter
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from listinglake import schemas  # noqa: E402
from listinglake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        extra={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def landed(spark):
    """Build a responses table from (source, kind, body, other columns)."""

    def make(*rows):
        full = []
        seen = Counter()
        for source, kind, body, *rest in rows:
            extra = rest[0] if rest else {}
            asked = (source, kind, extra.get("entity_id"), str(extra.get("params")))
            seen[asked] += 1  # another page of the request, unless the test says otherwise
            full.append(
                (
                    source, kind, extra.get("entity_id"), extra.get("params"),
                    extra.get("check_in"), extra.get("nights"), extra.get("page", seen[asked]),
                    extra.get("http_status", 200), extra.get("fetched_at"), body,
                )
            )
        return spark.createDataFrame(full, schemas.RESPONSES)

    return make


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a Column function to literal inputs; returns the list of results."""

    def run(fn, values, in_type="string"):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, x {in_type}").repartition(2)
        out = df.select("i", fn(F.col("x")).alias("y")).collect()
        return [r["y"] for r in sorted(out, key=lambda r: r["i"])]

    return run

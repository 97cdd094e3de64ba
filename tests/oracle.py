"""Compare a registered query with its SQL in DuckDB on the same tables."""

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    rows = sorted((tuple(_plain(r[i]) for i in order) for r in records), key=repr)
    return names, rows


def types_match(spark_fields, duck_types):
    alias = {
        "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
        "boolean": "BOOLEAN", "date": "DATE",
    }
    return {
        name: (t, duck_types[name])
        for name, t in spark_fields.items()
        if alias.get(t, t) != duck_types[name]
    }


def compare(df, con, sql):
    """(row count, list of differences)."""
    got_names, got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    want_names, want = rows_of(columns, cur.fetchall())
    problems = []
    if got_names != want_names:
        return len(got), [f"columns {got_names} != {want_names}"]
    types = types_match({f.name: f.dataType.simpleString() for f in df.schema}, duck_types)
    if types:
        problems.append(f"types {types}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {bad[0]}")
    return len(got), problems

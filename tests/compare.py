"""Compares registered queries with their oracles; run as a script for a quick look."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float) and v != v:
        return "NaN"
    return repr(v) if not isinstance(v, float) else repr(float(v))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows]), [columns[i] for i in order]


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and an oracle query; empty when they agree."""
    got, cols = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want, wcols = _rows(rel.columns, rel.fetchall())
    if cols != wcols:
        return [f"columns {cols} != {wcols}"]
    problems = []
    types = dict(zip(rel.columns, map(str, rel.types)))
    for name, t in df.dtypes:
        if _TYPES.get(t, t) != types[name]:
            problems.append(f"type of {name}: {t} != {types[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if not want:
        problems.append("no rows to compare")
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, e.g. {dict(zip(cols, zip(*bad[0])))}")
    return problems


if __name__ == "__main__":
    from tidemark.plans import catalog
    from tidemark.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(), connect(sf_dir)
    wanted = sys.argv[1:]
    for name, fn in catalog.QUERIES.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t0 = time.time()
        try:
            if name in catalog.ORACLES:
                problems = compare(fn(spark, sf_dir), con, catalog.ORACLES[name])
                status = "ok" if not problems else "; ".join(problems)
            else:
                status = f"rows {len(fn(spark, sf_dir).collect())}"
        except Exception as e:  # noqa: BLE001
            status = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        print(f"{name:28s} {time.time() - t0:6.2f}s {status}", flush=True)

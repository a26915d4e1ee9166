"""Run registered queries against their SQL twins in DuckDB.

    python -m checks.compare --sf 0.01 [name ...]
"""

from __future__ import annotations

import argparse
import sys
import tempfile
import time

import pandas as pd

from checks import registry
from checks.adapters import TABLES


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or (not isinstance(value, str) and pd.isna(value)):
        return "NULL"
    if isinstance(value, (bool, str)):
        return str(value)
    if hasattr(value, "year"):
        return str(pd.Timestamp(value))
    return repr(round(float(value), 6) + 0.0)


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    cols = sorted(df.columns)
    out = pd.DataFrame({c: [_text(v) for v in df[c]] for c in cols}, columns=cols)
    return out.sort_values(cols, ignore_index=True)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    a, b = canonical(spark_rows), canonical(sql_rows)
    bad = (a != b).any(axis=1)
    if not bad.any():
        return None
    cols = [c for c in a.columns if (a[c] != b[c]).any()]
    return f"{bad.sum()} rows differ in {cols}: {a[bad][cols].head(2).to_dict('records')} / " \
           f"{b[bad][cols].head(2).to_dict('records')}"


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    rows = registry.QUERIES[name](spark, sf_dir).toPandas()
    if name not in registry.ORACLES:
        return None
    return difference(rows, con.execute(registry.ORACLES[name]).df())


def main() -> int:
    from rivulet import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    registry.load()
    spark = build_session("local[8]", 8, **{"spark.driver.memory": "16g",
                                            "spark.ui.enabled": "false",
                                            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")})
    sf_dir = f"/root/testdata/sf{args.sf}"
    con = connect(sf_dir)
    failed = 0
    for name in args.names or registry.QUERIES:
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:500]}"
        failed += problem is not None
        print(f"{name:36s} {'ok' if problem is None else 'FAIL'} {time.time() - began:.1f}s "
              f"{problem or ''}", flush=True)
    print(f"{failed} failed")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())

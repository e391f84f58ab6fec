"""Run registered queries beside their SQL and report differences: python tests/check_queries.py SF_DIR [name…]"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    """Rows as comparable text, columns sorted by name."""
    pdf = pdf[sorted(pdf.columns)]
    cols = [[None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else v for v in pdf[c].tolist()] for c in pdf]
    return sorted(tuple("NULL" if v is None else repr(float(v)) if isinstance(v, float) else str(v) for v in row) for row in zip(*cols))


def compare(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} / {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} / {len(sql_pdf)}"
    kinds = [
        (c, spark_pdf[c].dtype.kind, sql_pdf[c].dtype.kind)
        for c in spark_pdf
        if spark_pdf[c].dtype.kind in "iuf" and spark_pdf[c].notna().all() and spark_pdf[c].dtype.kind != sql_pdf[c].dtype.kind
    ]
    if kinds:
        return f"types {kinds}"
    a, b = canonical(spark_pdf), canonical(sql_pdf)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None


def main() -> int:
    import __spark_entry__ as contract
    from tabwright.session import local_session

    sf, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(sf)
    queries, oracle = contract.queries(), contract.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            got = fn(spark, sf).toPandas()
            spent = time.time() - start
            if name not in oracle:
                print(f"rows  {name} {len(got)} {spent:.1f}s", flush=True)
                if names:
                    print(got.head(12).to_string())
                continue
            problem = compare(got, con.execute(oracle[name]).df())
        except Exception as e:  # report and go on with the next query
            problem, spent = f"{type(e).__name__}: {str(e)[:1500]}", time.time() - start
        failed += problem is not None
        print(f"{'ok   ' if problem is None else 'FAIL '} {name} {len(got) if problem is None else problem} {spent:.1f}s", flush=True)
    print(f"{failed} failed of {len(queries)} ({len(oracle)} with SQL)")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

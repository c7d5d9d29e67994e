"""Run queries against their SQL checks: python tests/compare.py [sf] [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
DATA = Path("/root/testdata")


# Queries that SQL cannot express, and what checks them instead.
UNCHECKED = {
    "random_search_boosting": "tests/test_binned.py: fits by definition, both layouts, scores of folds",
    **{
        name: "tests/llm: brute force, exact round trips or held-out labels"
        for name in (
            "op1_substring_dedup", "op3_token_counts", "op4_simhash_near_dedup", "op5_toxicity", "op7_hmm_scores",
            "op8_best_fit_packing", "op9_suffix_dedup", "op10_language_id", "op12_pii_disclosure", "pipeline",
        )
    },
}


def connect(sf_dir: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples, columns by name, values in a form both engines share."""

    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return "\0null"
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v))
        return str(v)

    columns = [df[c].map(cell) for c in sorted(df.columns)]
    return sorted(zip(*columns))


def check(spark, con, name: str, query, sql: str | None, sf_dir: Path) -> tuple[bool, str]:
    start = time.time()
    got = query(spark, str(sf_dir)).toPandas()
    took = time.time() - start
    if sql is None:
        return name in UNCHECKED, f"{took:6.1f}s rows={len(got)}, no SQL: {UNCHECKED.get(name, 'no check at all')}"
    start = time.time()
    want = con.execute(sql).fetchdf()
    oracle_took = time.time() - start
    note = f"{took:6.1f}s rows={len(got)} oracle {oracle_took:.1f}s"
    if sorted(got.columns) != sorted(want.columns):
        return False, f"{note} columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return True, note
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    return False, f"{note} want {len(want)} rows; ours {list(only_a)[:2]} theirs {list(only_b)[:2]}"


def main() -> int:
    from conftest import make_session

    import __spark_entry__ as entry

    sf_dir = DATA / (sys.argv[1] if len(sys.argv) > 1 else "sf0.001")
    names = sys.argv[2:] or list(entry.queries())
    spark, con, oracle = make_session(), connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name in names:
        try:
            ok, note = check(spark, con, name, entry.queries()[name], oracle.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:1500]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
    print(f"{failed} failed of {len(names)}")
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)

"""Run registered queries and their SQL side by side.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, sorted; floats bit for bit."""

    def cell(value):
        if value is None or value is pd.NaT or value is pd.NA:
            return None
        if isinstance(value, float):
            return None if math.isnan(value) else value
        if isinstance(value, pd.Timestamp):
            return value.to_pydatetime()
        if hasattr(value, "item"):
            return cell(value.item())
        return value

    frame = frame[sorted(frame.columns)]
    rows = [tuple(cell(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def types(frame: pd.DataFrame) -> dict[str, str]:
    return {name: frame[name].dtype.kind for name in sorted(frame.columns)}


def differences(mine: pd.DataFrame, theirs: pd.DataFrame) -> list[str]:
    found = []
    if sorted(mine.columns) != sorted(theirs.columns):
        return [f"columns {sorted(mine.columns)} / {sorted(theirs.columns)}"]
    kinds = types(mine), types(theirs)
    for name in kinds[0]:
        if kinds[0][name] != kinds[1][name]:
            found.append(f"type of {name}: {mine[name].dtype} / {theirs[name].dtype}")
    left, right = normal(mine), normal(theirs)
    if len(left) != len(right):
        found.append(f"rows {len(left)} / {len(right)}")
    if left != right:
        odd = sorted(set(left) ^ set(right), key=repr)
        found.append(f"{len(odd)} odd rows: {sorted(mine.columns)} {odd[:4]}")
    return found


def main(argv: list[str]) -> int:
    from conftest import make_session

    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = make_session()
    db = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if len(argv) > 2 and name not in argv[2:]:
            continue
        began = time.time()
        mine = query(spark, sf_dir).toPandas()
        spent = time.time() - began
        found = differences(mine, db.execute(oracles[name]).df()) if name in oracles else []
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {len(mine)} rows {spent:.2f}s", *found,
              sep="\n      " if found else " ", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv))

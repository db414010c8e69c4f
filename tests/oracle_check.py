"""Compare registered queries with their reference SQL on one set of tables.

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows_of(table: pa.Table) -> list[tuple]:
    columns = sorted(table.column_names)
    data = table.select(columns).to_pydict()
    return sorted(zip(*(data[c] for c in columns)), key=repr)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns, types and rows agree, else what differs."""
    ours = spark_df.toArrow()
    theirs = con.execute(sql).to_arrow_table()
    mine = {f.name: str(f.type).replace("large_", "") for f in ours.schema}
    other = {f.name: str(f.type).replace("large_", "") for f in theirs.schema}
    if mine != other:
        return f"columns {sorted(set(mine.items()) ^ set(other.items()))}"
    if ours.num_rows != theirs.num_rows:
        return f"rows {ours.num_rows} != {theirs.num_rows}"
    if ours.num_rows == 0:
        return "no rows"
    a, b = rows_of(ours), rows_of(theirs)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    import __spark_entry__ as entry
    from vigia.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master=f"local[{os.environ.get('BENCH_CPUS', '8')}]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            problem = compare(df, con, sqls[name]) if name in sqls else f"(no SQL) {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem) and not problem.startswith("(no SQL)")
        print(f"\n{'ok  ' if not problem else 'DIFF'} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"\n{failed} failed")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()

"""Run queries against their SQL on DuckDB: ``python -m tests.check_queries SF_DIR [names...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(table) -> list[tuple]:
    table = table.select(sorted(table.column_names))
    columns = [c.to_pylist() for c in table.columns]
    return sorted(zip(*columns), key=repr) if columns else []


def compare(spark, con, name: str, function, sql: str, sf_dir: str) -> str:
    """Empty text if both sides agree in column names, types and values."""
    ours = function(spark, sf_dir).toArrow()
    theirs = con.execute(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"
    kinds = {
        c: (str(ours.schema.field(c).type), str(theirs.schema.field(c).type)) for c in sorted(ours.column_names)
    }
    kinds = {c: t for c, t in kinds.items() if t[0].split("[")[0] != t[1].split("[")[0]}
    a, b = _rows(ours), _rows(theirs)
    problems = []
    if kinds:
        problems.append(f"types {kinds}")
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    wrong = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    if not b:
        problems.append("empty result")
    return "; ".join(problems)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from verdigrid.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "check", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    checks, bad = oracle_sql(), 0
    for name, function in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in checks:
                problem = compare(spark, con, name, function, checks[name], sf_dir)
            else:
                problem = "" if function(spark, sf_dir).count() else "empty result"
        except Exception as error:  # a broken query is a finding, the others still run
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} problems")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

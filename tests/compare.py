"""Run a registered query and its SQL twin and compare names, types and values, order aside."""

from __future__ import annotations

import math
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _freeze(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_freeze(v) for v in value)
    return (type(value).__name__, value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_freeze(r[i]) for i in order) for r in rows)


TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def type_difference(df, db, sql: str) -> str | None:
    """Columns whose type differs between the two engines, or None."""
    want = {row[0]: TYPES.get(row[1], row[1]) for row in db.execute(f"DESCRIBE {sql}").fetchall()}
    got = dict(df.dtypes)
    off = {c: (got.get(c), want.get(c)) for c in sorted({*got, *want}) if got.get(c) != want.get(c)}
    return f"types {off}" if off else None


def difference(df, db, sql: str) -> str | None:
    """A short description of the first difference, or None."""
    types = type_difference(df, db, sql)
    if types:
        return types
    got_names, got = _rows(df.columns, df.collect())
    cursor = db.execute(sql)
    want_names, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} vs {sum(want.values())} rows; "
            f"extra {list(extra.items())[:2]}; missing {list(missing.items())[:2]}"
        )
    return None


def main(sf_dir: str, only: str = "") -> None:
    import sys

    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from larder.session import local_session

    spark, db, twins = local_session(), database(sf_dir), e.oracle_sql()
    bad = 0
    for name, run in e.queries().items():
        if only and not any(piece in name for piece in only.split(",")):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in twins:
                verdict = difference(df, db, twins[name])
                note = verdict or f"ok ({df.count()} rows)" if verdict is None else verdict
            else:
                verdict, note = None, f"no twin ({df.count()} rows)"
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict = note = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None
        print(f"{name:34} {time.time() - start:6.2f}s {note}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    import sys

    main(*(sys.argv[1:] or ["/root/testdata/sf0.01"]))

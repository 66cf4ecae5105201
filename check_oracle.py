"""Run every registered query on Spark and its SQL twin on DuckDB; compare
column names, column type families, row counts and order-insensitive values.

    python check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import math
import sys
import time


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _rows(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(t[i]) for i in order) for t in tuples]
    out.sort(key=lambda r: tuple((x is None, repr(x)) for x in r))
    return [names[i] for i in order], out


def duck(sf_dir: str):
    import duckdb

    from reviewops.sources.tables import DRIVER_TABLES

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _spark_kind(t) -> str:
    """Type family of a Spark column (integer widths kept apart)."""
    name = t.simpleString()
    for prefix, kind in [("string", "string"), ("bigint", "bigint"), ("int", "int"),
                         ("smallint", "smallint"), ("tinyint", "tinyint"), ("double", "float"),
                         ("float", "float"), ("decimal", "decimal"), ("timestamp", "timestamp"),
                         ("date", "date"), ("boolean", "boolean"), ("array", "list"),
                         ("struct", "struct"), ("map", "map"), ("binary", "binary")]:
        if name.startswith(prefix):
            return kind
    return name


def _duck_kind(t) -> str:
    name = str(t).upper()
    exact = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint",
             "TINYINT": "tinyint", "DOUBLE": "float", "FLOAT": "float", "DATE": "date",
             "BOOLEAN": "boolean", "BLOB": "binary"}
    if name in exact:
        return exact[name]
    for prefix, kind in [("DECIMAL", "decimal"), ("TIMESTAMP", "timestamp"), ("STRUCT", "struct"),
                         ("MAP", "map")]:
        if name.startswith(prefix):
            return kind
    return "list" if name.endswith("[]") else name


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_names = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, status="rows-only", rows=len(s_rows), spark_s=round(t1 - t0, 2))
    rel = con.sql(sql)
    d_names, d_types = list(rel.columns), list(rel.types)
    d_rows = rel.fetchall()
    sn, sr = _rows(s_names, s_rows)
    dn, dr = _rows(d_names, d_rows)
    s_kinds = {f.name: _spark_kind(f.dataType) for f in df.schema.fields}
    d_kinds = dict(zip(d_names, (_duck_kind(t) for t in d_types)))
    kinds = {c: (s_kinds[c], d_kinds.get(c)) for c in s_kinds if s_kinds[c] != d_kinds.get(c)}
    ok = sn == dn and sr == dr and not kinds
    info = dict(name=name, status="ok" if ok else "MISMATCH", rows=len(sr), duck_rows=len(dr),
                spark_s=round(t1 - t0, 2))
    if kinds:
        info["types"] = kinds
    if not ok:
        if sn != dn:
            info["cols"] = (sn, dn)
        else:
            a, b = set(sr), set(dr)
            info["only_spark"] = list(a - b)[:2]
            info["only_duck"] = list(b - a)[:2]
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from reviewops.plans import ORACLE, QUERIES
    from reviewops.session import get_session

    spark = get_session("local[8]")
    con = duck(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        try:
            info = compare(spark, con, name, fn, ORACLE.get(name), sf_dir)
        except Exception as e:  # report and continue
            info = dict(name=name, status="ERROR", error=str(e)[:400])
        if info["status"] not in ("ok", "rows-only"):
            bad += 1
        print(info, flush=True)
    print(f"{len(QUERIES)} queries, {len(ORACLE)} with SQL twin, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

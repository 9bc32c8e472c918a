"""Compare a Spark result with a DuckDB result: column names, types, row
count and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
from dataclasses import dataclass

SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE",
                 "boolean": "BOOLEAN", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def spark_type(t) -> str:
    s = t.simpleString()
    return SPARK_TO_DUCK.get(s, s.upper())


def norm(v) -> str:
    if v is None:
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def canonical(cols: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


def digest(cols: list[str], rows: list[tuple]) -> str:
    return hashlib.sha256("\n".join(canonical(cols, rows)).encode()).hexdigest()[:16]


@dataclass
class Outcome:
    name: str
    ok: bool
    detail: str


def register_tables(con, sf_dir: str, tables: list[str]) -> None:
    for t in tables:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{p}')")


def compare(name: str, df, con, sql: str) -> Outcome:
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    stypes = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    rel = con.sql(sql)
    ocols, orows = rel.columns, rel.fetchall()
    otypes = {c: str(t) for c, t in zip(ocols, rel.types)}
    problems = []
    if sorted(scols) != sorted(ocols):
        problems.append(f"columns {scols} vs {ocols}")
    if len(srows) != len(orows):
        problems.append(f"rows {len(srows)} vs {len(orows)}")
    tdiff = {c: (stypes[c], otypes.get(c)) for c in stypes if stypes[c] != otypes.get(c)}
    if tdiff:
        problems.append(f"types {tdiff}")
    if not problems and digest(scols, srows) != digest(ocols, [tuple(r) for r in orows]):
        s, o = canonical(scols, srows), canonical(ocols, orows)
        first = next(((a, b) for a, b in zip(s, o) if a != b), None)
        problems.append(f"values differ, first: {first}")
    return Outcome(name, not problems, "; ".join(problems) or f"{len(srows)} rows")

"""Run a registered query and its SQL on the same tables and compare columns, types and values.

As a script: python tests/oracle.py [names...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
FAMILY = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
          "TIMESTAMP": "timestamp", "DATE": "date", "FLOAT": "float"}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def compare(spark, con, name: str, sf_dir: str) -> str:
    from issueloom.plans import catalog

    df = catalog.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    left = sorted((tuple(plain(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr)
    if name not in catalog.SQL:
        return f"rows {len(left)}"
    res = con.execute(catalog.SQL[name])
    names = [d[0] for d in res.description]
    types = dict(zip(names, (str(d[1]) for d in res.description)))
    rows = res.fetchall()
    if sorted(names) != cols:
        return f"COLUMNS spark {cols} sql {sorted(names)}"
    order = [names.index(c) for c in cols]
    right = sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)
    kinds = dict(df.dtypes)
    odd = [(c, kinds[c], types[c]) for c in cols if FAMILY.get(types[c].upper(), types[c]) != kinds[c]]
    if left != right:
        only_l = [x for x in left if x not in set(right)][:3]
        only_r = [x for x in right if x not in set(left)][:3]
        return f"VALUES spark {len(left)} sql {len(right)}\n   spark: {only_l}\n   sql:   {only_r}"
    if odd:
        return f"TYPES {odd}"
    return f"ok {len(left)}" if left else "EMPTY"


if __name__ == "__main__":
    from issueloom.plans import catalog
    from issueloom.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8, 8)
    modules = [a[1:] for a in sys.argv[1:] if a.startswith("@")]
    if modules:
        import importlib

        for m in modules:
            importlib.import_module(f"issueloom.plans.catalog.{m}")
    else:
        catalog.load_all()
    con = duck(sf)
    wanted = [a for a in sys.argv[1:] if not a.startswith("@")] or list(catalog.QUERIES)
    for n in wanted:
        start = time.time()
        try:
            said = compare(spark, con, n, sf)
        except Exception as e:  # noqa: BLE001
            said = "ERROR " + str(e)[:900]
        print(f"{n}: {said} ({time.time() - start:.1f}s)", flush=True)

"""Every registered query on the smallest test data, against its oracle where it has one."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tracemill.plans import core
from tracemill.plans.registry import Registry

DATA = Path("/root/testdata/sf0.001")


def norm(v):
    if isinstance(v, float):
        return "nan" if v != v else f"{v:.9g}" if v else "0"
    return str(v) if v is not None else None


def check(spark, registry, name):
    df = registry.runs[name](spark, str(DATA))
    rows, cols = df.collect(), sorted(df.columns)
    assert len(cols) == len(set(cols))
    if name in registry.sql:
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for p in DATA.glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        cur = con.execute(registry.sql[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == cols
        want = Counter(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())
        assert Counter(tuple(norm(r[c]) for c in cols) for r in rows) == want


@pytest.mark.parametrize("name", sorted(core().runs))
def test_query(spark, name):
    check(spark, core(), name)


def test_names_are_unique():
    r = Registry()
    r.query("a")(lambda s, d: None)
    with pytest.raises(ValueError):
        r.query("a")
        r.query("a")(lambda s, d: None)

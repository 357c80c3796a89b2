import os
import sys
import tempfile

import pytest

os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.environ.get("PYTHONPATH", "")]))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quernstone-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path


@pytest.fixture(scope="session")
def oracle(sf_dir):
    """Compare a query's rows with those of its SQL."""
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")

    def norm(x):
        if x is None or x != x or str(x) in ("NaT", "<NA>"):
            return "null"
        return f"{x:.9g}" if isinstance(x, float) else str(x)

    def check(spark, name, query, sql):
        got, exp = query(spark, sf_dir), con.execute(sql).df()
        cols = sorted(got.columns)
        assert cols == sorted(exp.columns)
        a = sorted(tuple(norm(x) for x in r) for r in (tuple(r[c] for c in cols) for r in got.collect()))
        b = sorted(tuple(norm(None if str(x) in ("NaT", "<NA>") else x) for x in r) for r in exp[cols].astype(object).itertuples(index=False))
        assert len(a) == len(b)
        strip = [[y.replace(" 00:00:00", "") for y in x] for x in a], [[y.replace(" 00:00:00", "") for y in x] for x in b]
        differ = [(x, y) for x, y in zip(*strip, strict=True) if x != y and not all(p == q or _near(p, q) for p, q in zip(x, y, strict=True))]
        assert not differ, differ[:2]

    def _near(p, q):
        try:
            return abs(float(p) - float(q)) <= 1e-6 * max(1.0, abs(float(q)))
        except ValueError:
            return False

    return check

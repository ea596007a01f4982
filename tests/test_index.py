import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docvec import cluster
from docvec.functions import filters as flt
from docvec.operators import index, search

SCHEMA = "id string, vector array<float>, metadata map<string,string>, n int"


def groups(spark, n=6000, dim=16, groups=30, spread=0.05):
    """Vectors around some directions, a third of them around one; with copies, and rows that no index can place."""
    r = np.random.default_rng(7)
    middle = r.normal(size=(groups, dim))
    own = np.where(r.random(n) < 0.3, 0, r.integers(0, groups, n))
    v = (middle[own] + spread * r.normal(size=(n, dim))).astype(np.float32)
    v[100:140] = v[99 % n]
    rows = [(f"v{i}", v[i].tolist(), {"source": f"s{own[i] % 7}", "number": str(i)}, i) for i in range(n)]
    odd = [[0.0] * dim, None, [1.0] * (dim + 1), [1.0, None] + [0.0] * (dim - 2), []]
    rows += [(f"odd{i}", x, {"source": "s1"}, -i) for i, x in enumerate(odd)] + [(None, v[0].tolist(), {}, 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(8), v


@pytest.fixture(scope="module")
def built(spark):
    rows, v = groups(spark)
    path = cluster.scratch_path(spark, "index")
    index.build(rows, path, keys=("source", "number"), cell_rows=150)
    return rows.cache(), path, v


def told(df):
    return [(r["id"], r["score"], r["metadata"]) for r in df.collect()]


def test_every_row_is_kept(spark, built):
    rows, path, _ = built
    again = index.read(spark, path)
    assert again.count() == rows.count() and {"metadata.source", "cell", "angle", *rows.columns} <= set(again.columns)
    assert sorted(map(str, again.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))
    assert again.where("cell = -1").count() == 5


@pytest.mark.parametrize("k", [1, 10, 150])
def test_searches_equal_the_full_scan_and_read_a_part(spark, built, k):
    rows, path, v = built
    for query in (v[99], v[3], v[5] + v[77], -v[8]):
        seen = {}
        got = told(index.search(spark, path, query.tolist(), k, seen=seen))
        assert got == told(search.search(rows, query.tolist(), k)) and len(got) == k
        assert seen["total"] == rows.count() and seen["scored"] <= seen["total"]
        if query is v[3] and k == 10:
            assert seen["scored"] < 0.4 * seen["total"]


@pytest.mark.parametrize("query", [[0.0] * 16, [1.0] * 17, [1.0], [math.nan] + [1.0] * 15, [1e30] * 16])
def test_odd_queries(spark, built, query):
    rows, path, _ = built
    assert str(told(index.search(spark, path, query, 5))) == str(told(search.search(rows, query, 5)))


def test_filters_meet_the_scan(spark, built):
    rows, path, v = built
    wanted = [{"field": "metadata.source", "operator": "IN", "value": '["s3", "s4"]'}, {"field": "number", "operator": "BETWEEN", "value": "[100, 3000]"},
              {"field": "n", "operator": "LESS_THAN", "value": 2500}]
    assert told(index.search(spark, path, v[3].tolist(), 20, wanted)) == told(search.search(rows, v[3].tolist(), 20, wanted))
    none = [{"field": "source", "operator": "EQUAL", "value": "nothing"}]
    seen = {}
    assert told(index.search(spark, path, v[3].tolist(), 20, none, seen)) == [] and seen["scored"] == 0
    plan = flt.apply(index.read(spark, path), wanted)._jdf.queryExecution().executedPlan().toString()
    assert "In(`metadata.source`, [s3" in plan.partition("PushedFilters")[2]
    cells = index.Cells(spark, path, v[3].tolist())
    near = index.read(spark, path).where(cells.within(np.argsort(cells.bound)[:2], 0.3))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "angle" in plan.partition("PushedFilters")[2].partition("ReadSchema")[0] and "cell#" in plan.partition("PartitionFilters")[2].partition("PushedFilters")[0]


def test_fewer_rows_than_asked_for_and_none(spark):
    rows, _ = groups(spark, 40)
    path = cluster.scratch_path(spark, "index")
    index.build(rows, path, cell_rows=10)
    assert told(index.search(spark, path, [1.0] * 16, 500)) == told(search.search(rows, [1.0] * 16, 500))
    for name, few in (("none", rows.limit(0)), ("no", rows.where("id = 'odd1'"))):
        path = cluster.scratch_path(spark, name)
        index.build(few, path)
        assert told(index.search(spark, path, [1.0] * 16, 5)) == [] and index.read(spark, path).count() == few.count()

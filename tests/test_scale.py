"""What grows with the tables: shuffles of long texts, rows handed to tasks, passes over the input."""

import re
from datetime import date

import numpy as np
import pytest

from checks import views as V
from staffcast.operators import near_search, outliers
from staffcast.plans import features
from staffcast.staging import stage
from staffcast.streaming.store import RequestStore


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of small tables from which requests are derived."""
    place = tmp_path_factory.mktemp("tables")
    made = {
        "nation": ([(1, "SPAIN")], "n_nationkey int, n_name string"),
        "customer": ([(i, 1) for i in range(4)], "c_custkey long, c_nationkey int"),
        "part": ([(i, f"ROLE {i}") for i in range(3)], "p_partkey long, p_type string"),
        "documents": ([(i, f"text number {i} " * 50) for i in range(5)], "doc_id long, text string"),
        "lineitem": ([(i % 20, "R" if i % 3 else "N") for i in range(60)], "l_orderkey long, l_returnflag string"),
        "orders": (
            [(i, i % 4, "OFP"[i % 3], 1000.0 * i, date(2001, 1, 1 + i), "1-URGENT") for i in range(22)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
        ),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{place}/{name}.parquet")
    return str(place)


@pytest.fixture
def unbroadcast(spark):
    """Plans as they are for large tables."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def above(df, leaf):
    """Names of the plan's nodes from the root down to the first line that holds ``leaf``."""
    path = []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(re.match(r"[\s:+|-]*", line).group())
        path = [(d, n) for d, n in path if d < depth]
        if leaf in line and "Scan" in line:
            return [n for _, n in path]
        path.append((depth, line.strip(" :+-").split(" ")[0].split("(")[-1] if "Exchange" not in line else "Exchange"))
    raise ValueError(f"{leaf} is not in the plan")


def test_texts_of_requests_are_shuffled_once(spark, tables, unbroadcast):
    requests = V.requests(spark, tables)
    assert requests.count() == 22 and requests.select("minimum_requirements").distinct().count() == 5
    assert above(requests, "text#").count("Exchange") == 1


def test_a_batch_does_not_shuffle_the_base(spark, tables, tmp_path, unbroadcast):
    store = RequestStore(spark, str(tmp_path / "store"), buckets=4)
    store.create(V.requests(spark, tables))
    keys = spark.createDataFrame([("REQ3",), ("REQ7",), ("REQ99",)], "request_code string")
    rows = store.rows(keys)
    assert "Exchange" not in above(rows, "key_bucket")
    assert sorted(r[0] for r in rows.select("request_code").collect()) == ["REQ3", "REQ7"]


def test_the_exact_search_writes_no_vector_for_each_pair(spark, monkeypatch):
    written = []

    def staged(df, name, *rest):
        out = stage(df, name, *rest)
        written.append((name, out.columns, out.count()))
        return out

    rng = np.random.default_rng(6)
    points = np.concatenate([rng.normal(size=(280, 20)), np.full((3, 20), np.nan), rng.integers(0, 2, (40, 20))])
    df = spark.createDataFrame([(f"k{i:03d}", [float(c) for c in p]) for i, p in enumerate(points)], "id string, v array<double>")
    _, residents = outliers.distinct_vectors(df, 5)
    monkeypatch.setattr(outliers, "stage", staged)
    found = {}
    for r in outliers.nearest(residents, 5, cell_rows=10, block_rows=8).collect():
        found.setdefault(r.rep, []).append((r.d, r.other_id))
    assert written and all(n <= len(points) for _, columns, n in written if {"v", "x"} & set(columns))
    ids = [f"k{i:03d}" for i in range(len(points))]
    for i in range(len(points)):
        d = np.sqrt(((points - points[i]) ** 2).sum(1))
        wanted = sorted((d[j], ids[j]) for j in range(len(points)) if j != i and np.isfinite(d[j]) and d[j] > 0)[:5]
        got = sorted(found.get(ids[i], []))
        assert [o for _, o in got] == [o for _, o in wanted]
        np.testing.assert_allclose([x for x, _ in got], [x for x, _ in wanted], rtol=1e-9)


def test_hashes_reach_the_target_or_leave_all_pairs_to_the_exact_search(spark):
    rng = np.random.default_rng(7)
    points = spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(rng.normal(size=(2500, 64)))], "id long, v array<double>")
    _, residents = outliers.distinct_vectors(points, 7)
    _, share = near_search.nearest_by_hashes(residents, 7, block_rows=40)
    assert share >= near_search.TARGET
    with pytest.raises(near_search.NotFound, match="nearly all pairs"):
        near_search.nearest_by_hashes(residents, 7, target=1.01, block_rows=400, effort=1.0)


class Staged(Exception):
    pass


def test_words_are_cut_in_more_tasks_than_the_requests_came_in(spark, tables, unbroadcast, monkeypatch):
    made = {}

    def stage(df, name):
        made[name] = df
        raise Staged

    monkeypatch.setattr(features, "stage", stage)
    with pytest.raises(Staged):
        features.fit_encoding(V.requests(spark, tables).coalesce(1), spark.range(0), V.CONF)
    assert made["cleaned"].rdd.getNumPartitions() > 1

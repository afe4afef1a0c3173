"""What the star does once and not once a row: texts cleaned, rows moved, keys counted."""

import re

import pytest

from surestar.operators import details, keys, quality
from surestar.plans import dims
from surestar.queries.base import run_sql
from surestar.queries.standins import CLEAN, PLANNED, clean

SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double",
}
ROWS = {
    # Orders that come twice, without key, client or lines; lines without order, part or supplier.
    "orders": [(1, 7, "F", 10.5, None, "1-URGENT"), (1, 7, "F", 10.5, None, "1-URGENT"), (2, 7, "O", None, None, None),
               (10, 8, "O", 3.0, None, "5-LOW"), (None, 8, "O", 4.0, None, "2-HIGH"), (12, None, "O", 5.0, None, "x"), (13, 9, "O", 1.0, None, "x")],
    "lineitem": [(1, 5, 6, 1, 2.0), (1, 4, 9, 2, 3.0), (1, 4, 9, 2, 3.0), (2, None, 3, 1, 4.0), (10, 8, None, 1, 5.0), (None, 1, 1, 1, 6.0), (12, 2, 2, 1, 7.0)],
    "events": [(1, None, 7, "click", 1.0), (1, None, 7, "click", 1.0), (2, None, 8, "view", None), (None, None, 7, None, 2.0),
               (4, None, None, "error", 3.0), (5, None, 9, "error", 4.0), (6, None, 99, "view", 5.0)],
}


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A folder of small tables with nulls, repeated rows and references without parents."""
    folder = str(tmp_path_factory.mktemp("odd"))
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(ROWS[name], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(PLANNED))
def test_planned_inputs_hold_the_same_rows(spark, odd, name):
    wanted, found = run_sql(spark, odd, CLEAN[name]), clean(spark, odd, name)
    assert found.schema == wanted.schema
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect())) != []


def test_policies_stay_where_they_are_for_their_coverages(spark, odd, shuffled):
    sums = details.sum_by_key(clean(spark, odd, "coverages"), "id_poliza", "suma_garantizada", "insured_sum")
    df = details.left_details(clean(spark, odd, "policies"), "id_poliza", sums, "id_poliza", "insured_sum")
    assert planned(df).count("Exchange hashpartitioning") == 3, "orders, their lines and the coverages, each once"
    assert "lineitem" not in planned(clean(spark, odd, "policies").select("id_poliza", "cobertura"))


def test_claims_are_moved_once_for_policy_and_item(spark, odd, shuffled):
    plan = planned(clean(spark, odd, "claims"))
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", plan)) == 1
    assert plan.index("[user_id") < plan.index("[first_order"), "the item joins the first policies, below the join with the events"
    assert "orders" not in planned(clean(spark, odd, "claims").select("id_parte"))


def test_texts_are_cleaned_after_they_are_distinct(spark):
    texts = [" A", "A", "A", "A ", None, "nan", " ", "B", "C", "C"]
    df = spark.createDataFrame([(x, x) for x in texts], "tipo_siniestro string, payee string")
    types = dims.claim_type_input(df)
    assert sorted(r[0] for r in types.collect()) == ["", "A", "B", "C", "nan"]
    known = spark.createDataFrame([("C",), (None,)], "id string")
    others = dims.third_parties(df, "payee", [(known, "id")])
    assert sorted(r["person_id"] for r in others.collect()) == ["A", "B"]
    places = spark.createDataFrame(
        [("x", "uno", "dos."), ("x", "UNO", "dos"), (None, "uno", "dos"), ("x", None, "dos"), ("x", "uno", "s/d")], "pais string, provincia string, localidad string"
    )
    found = dims.location_input(places, places.select("provincia", "localidad"))
    assert sorted(map(str, map(tuple, found.collect()))) == ["('Argentina', 'Uno', 'Dos')", "('X', 'Uno', 'Dos')", "(None, 'Uno', 'Dos')"]
    for frame, pattern in ((types, "RLIKE"), (others, "RLIKE"), (found, "regexp_replace")):
        lines = optimised(frame).splitlines()
        of_rows = max(i for i, line in enumerate(lines) if "Aggregate [" in line and pattern not in line.partition("], [")[0])
        assert not any(pattern in line for line in lines[of_rows + 1:]), "no row is cleaned, nor a filter on cleaned texts run over rows"


def test_keys_by_hash_do_not_move_the_digest(spark, shuffled):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, n int")
    numbered = keys.keys_by_hash(df, "k", "sk", 5)
    assert sorted((r["sk"], r["k"]) for r in numbered.collect()) == [(6, "a"), (7, "b"), (8, "b")], "in the order of the MD5 texts 0cc1 and 92eb"
    window = planned(numbered).partition("Window [row_number")[2]
    below = window[window.index("Exchange hashpartitioning"):]
    assert "_digest" in window[: window.index("Exchange hashpartitioning")] and "_digest" not in below.partition("BroadcastExchange")[0]


def test_repeated_keys_are_counted_as_they_are_typed(spark):
    rows = [(1, "1"), (1, "x"), (2, "x"), (3, None), (4, None), (None, "y"), (7, "x")]
    df = spark.createDataFrame(rows, "sk bigint, name string")
    report = quality.unique_report("t", df, "sk", "name")
    assert {tuple(r) for r in report.collect()} == {("t: sk unique", 1), ("t: name unique", 2)}, "null is a value like any other"
    assert {tuple(r) for r in quality.unique_report("t", df, "name").collect()} == {("t: name unique", 2)}
    report = quality.unique_report("t", df, "sk", "name")
    assert "as string" not in optimised(report) and planned(report).count("Exchange hashpartitioning") == 1

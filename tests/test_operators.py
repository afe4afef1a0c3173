"""Operators on skewed and awkward inputs, and the shape of their plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from surestar.operators import dedupe, details, keys, lookup, refint, scd
from surestar.operators.rules import kept
from surestar.plans import curate, dims
from surestar.queries import ALL
from surestar.queries.base import table
from surestar.queries.standins import parent, raw
from surestar.session import materialise, shared_folder
from surestar.sources.feeds import MALFORMED, NULL_CELLS, ORDINAL, read_csv, read_csv_any_encoding
from surestar.plans.full_load import build_master_geography

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, another third has no key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    return spark.range(0, 30000, 1, 8).select(F.col("id"), key.alias("key"))


def test_mark_last_with_a_hot_key(skewed):
    marked = dedupe.mark_last(skewed.withColumn("ok", F.col("key").isNotNull()), ["key"], "id", "ok")
    assert marked.count() == 30000
    last = marked.where("_is_last").groupBy().agg(F.count("*"), F.countDistinct("key")).first()
    assert tuple(last) == (10001, 10001)
    assert marked.where("_is_last and key = 'hot'").first()["id"] == 29997
    assert "Window" not in plan_of(marked), "no task may hold all rows of a key"


def test_keep_last_and_first_with_a_hot_key(skewed):
    assert dedupe.keep_last(skewed, ["key"], ["id"]).where("key = 'hot'").first()["id"] == 29997
    assert dedupe.keep_first(skewed, ["key"], ["id"]).where("key = 'hot'").first()["id"] == 0
    assert "Window" not in plan_of(dedupe.keep_last(skewed, ["key"], ["id"]))


def test_null_keys_spread_in_a_shuffled_lookup(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = skewed.where("key is not null").groupBy("key").agg(F.min("id").alias("sk"))
        found = lookup.lookup(skewed, [F.col("key")], known, ["key"], {"sk": "found"}, spread="id")
        assert found.count() == 30000
        assert found.where("found = -1").count() == 10000
        nulls = found.where("key is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(nulls) > 1, "rows without a key must not meet in one task"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_marker_and_tolerant_filter(spark, skewed):
    parents = spark.createDataFrame([("hot",), ("hot",), (None,)], "id string")
    marked = refint.mark_parent(skewed, "key", parents, "id", "found", spread="id")
    assert marked.count() == 30000 and marked.where("found").count() == 10000
    assert refint.semi_or_null(skewed, "key", parents, "id", "id").count() == 20000
    assert refint.semi(skewed, "key", parents, "id").count() == 10000


def test_dense_keys(spark):
    df = spark.range(0, 5000, 1, 7).select(F.md5(F.col("id").cast("string")).alias("k"))
    for numbered in (keys.keys_in_order(df, ["k"], "sk", 10), keys.keys_by_hash(df, "k", "sk", 10)):
        stats = numbered.agg(F.min("sk"), F.max("sk"), F.countDistinct("sk"), F.count("*")).first()
        assert tuple(stats) == (11, 5010, 5000, 5000)
    ordered = [r["k"] for r in keys.keys_in_order(df, ["k"], "sk").orderBy("sk").collect()]
    assert ordered == sorted(ordered)
    once = keys.keys_by_hash(df, "k", "sk").collect()
    again = keys.keys_by_hash(df.repartition(3), "k", "sk").collect()
    assert sorted(once) == sorted(again), "keys do not depend on where rows lie"
    nothing = df.where("k = 'none'")
    assert keys.keys_in_order(nothing, ["k"], "sk").count() == 0 == keys.keys_by_hash(nothing, "k", "sk").count()


def test_scd2_is_idempotent_and_versions_do_not_overlap(spark):
    schema = "person_id string, location_sk bigint, occupation string, segment string, sex string, is_third_party boolean"
    one = spark.createDataFrame([("a", 1, "x", "s", "M", False), ("b", None, None, "s", "F", False)], schema)
    two = spark.createDataFrame([("a", 2, "x", "s", "M", False), ("c", 1, "y", "s", "F", True)], schema)
    existing = spark.createDataFrame([], "sk bigint, " + schema + ", valid_from date, valid_to date, is_current boolean")
    day = dt.date(2026, 1, 1)
    first = dims.load_persons(existing, one, day)
    same = dims.load_persons(first, one, day + dt.timedelta(1))
    assert sorted(map(str, first.collect())) == sorted(map(str, same.collect()))
    changed = dims.load_persons(same, two, day + dt.timedelta(2))
    rows = {(r["person_id"], r["sk"]): r for r in changed.collect()}
    assert set(rows) == {("a", 1), ("b", 2), ("a", 3), ("c", 4)}
    assert rows[("a", 1)]["valid_to"] == rows[("a", 3)]["valid_from"] == day + dt.timedelta(2)
    assert rows[("b", 2)]["is_current"], "members that vanish stay"
    back = dims.load_persons(changed, two, day + dt.timedelta(3))
    assert back.count() == 4


def test_scd1_takes_a_null_and_keeps_vanished_members(spark):
    old = spark.createDataFrame([(-1, "N/A", "?"), (1, "a", "x"), (2, "b", "y")], "sk bigint, k string, v string")
    new = spark.createDataFrame([("a", None), ("c", "z")], "k string, v string")
    merged = {r["k"]: (r["sk"], r["v"]) for r in scd.scd1_merge(old, new, "k", ["v"], "sk").collect()}
    assert merged == {"N/A": (-1, "?"), "a": (1, None), "b": (2, "y"), "c": (3, "z")}
    assert scd.ensure_unknown_member(old, "sk", {}).count() == 3


def test_fan_out_and_detail_sums(spark):
    df = spark.createDataFrame([("p",), ("q",)], "id string")
    lines = spark.createDataFrame([("p", 1), ("p", 1), ("r", 5)], "id string, v bigint")
    summed = details.left_details(df, "id", details.sum_by_key(lines, "id", "v", "s"), "id", "s")
    assert sorted(map(tuple, summed.collect())) == [("p", 2), ("q", None)]


def test_csv_reading(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('Id. X ,"b, c"\n1,"x, y"\nNA,\n2,n/d\n', encoding="utf-8")
    df = read_csv(spark, str(path))
    assert df.columns == ["id_x", "b,_c", MALFORMED, ORDINAL]
    assert [tuple(r)[:2] for r in df.collect()] == [("1", "x, y"), (None, None), ("2", "n/d")]
    latin = tmp_path / "b.csv"
    latin.write_bytes("id,nombre\n1,Tucumán\n".encode("latin-1"))
    assert read_csv_any_encoding(spark, str(latin)).first()["nombre"] == "Tucumán"
    assert "NA" in NULL_CELLS


def test_csv_quotes_and_broken_rows(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,x,y\n1,"Casa ""La Paz""",a\n2,"C:\\",z\n3,b,c,surplus\n4,short\n5,"two\nlines",d\n6,e,f\n', encoding="utf-8")
    rows = {r["id"]: r for r in read_csv(spark, str(path)).collect()}
    assert (rows["1"]["x"], rows["2"]["x"], rows["2"]["y"]) == ('Casa "La Paz"', "C:\\", "z")
    assert rows["3"][MALFORMED] == "3,b,c,surplus" and rows["4"][MALFORMED] == "4,short"
    assert rows["1"][MALFORMED] is None and rows["6"][MALFORMED] is None
    assert rows["5"][MALFORMED] is not None, "a line break in a cell is not lost without a word"
    whole = {r["id"]: r for r in read_csv(spark, str(path), multi_line=True).collect()}
    assert whole["5"]["x"] == "two\nlines" and whole["5"][MALFORMED] is None and len(whole) == 6


def test_files_of_a_folder_need_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("id,name\n1,y\n2,z\n")
    rows = read_csv(spark, str(tmp_path)).orderBy(ORDINAL).collect()
    assert [(r["id"], r["name"]) for r in rows] == [("1", "x"), ("1", "y"), ("2", "z")]
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path)).collect()


def test_malformed_rows_go_to_quarantine(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id_parte,confirmado_fraude\nE1,1\nE1,1,0\nE2\nE9,1\n")
    read_csv(spark, str(path)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    marked = curate.fraud_indicators(raw, spark.createDataFrame([("E1",), ("E2",)], "id_parte string"))
    found = {r["_row_json"]: r["_reasons"] for r in marked.where("not _kept").collect()}
    assert marked.count() == 4 and marked.where("_kept").count() == 1
    assert sorted(map(tuple, found.values())) == [("malformed_row",), ("malformed_row",), ("unknown_claim",)]
    assert any('"_malformed":"E1,1,0"' in text for text in found)


def test_last_row_of_a_real_feed_is_a_hash_aggregate(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id_perito,nombre,apellido,zona_cobertura\nS1,a,b,c\nS1,d,e,f\n")
    marked = curate.adjusters(read_csv(spark, str(path)))
    assert "SortAggregate" not in plan_of(marked)
    assert {r["nombre"] for r in marked.where("_kept").collect()} == {"D"}


def test_hot_reference_is_one_join_per_id(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ALL["curate_payments"].run(spark, FOLDER)).split("== Physical Plan ==")[-1]
        # what is known of the last rows, claims and payees, and the markers back to the rows
        assert plan.count("SortMergeJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    raw = spark.range(6000).selectExpr(
        f"id AS {ORDINAL}", "'G' || id AS id_pago", "'E' || id AS id_parte", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'C' || id END AS id_receptor",
        "'1' AS monto_pagado", "'2020-01-01' AS fecha_pago",
    )
    claims = spark.range(6000).selectExpr("'E' || id AS id_parte")
    clients = spark.createDataFrame([("hot",), ("C1",), ("C2",)], "id_cliente string")
    insured = spark.createDataFrame([("hot",), ("hot",), ("C2",), (None,)], "id_asegurado string")
    marked = curate.payments(raw, claims, clients, insured)
    assert marked.count() == 6000 and marked.where("_kept").count() == 2001
    assert marked.where("id_receptor = 'C1'").first()["_reasons"] == ["payee_not_insured"]


def test_all_references_of_a_row_share_two_joins(spark):
    known = [materialise(parent(spark, FOLDER, name)) for name in ("known_policies", "known_clients", "known_adjusters", "known_items")]
    rows = materialise(raw(spark, FOLDER, "claims"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(curate.claims(rows, *known)).split("== Physical Plan ==")[-1]
        # the rows whole, their ids, and their key with the ordinal
        assert plan.count("SortMergeJoin") == 2 and plan.count("_ordinal") and len(re.findall(r"FileScan parquet \[_ordinal", plan)) <= 3, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_markers_of_all_references(spark):
    rows = [(1, "k1", True, "a", None), (2, "k1", True, "b", "x"), (3, "k1", False, None, "y"), (4, None, False, "a", "x"), (5, "k2", True, "c", "a")]
    df = spark.createDataFrame(rows, "o bigint, k string, ok boolean, p string, q string")
    first = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    second = spark.createDataFrame([("a",), ("x",)], "name string")
    marked = refint.mark_all(df, "o", [("p", first, "id", "in_1"), ("p", second, "name", "in_2"), ("q", second, "name", "q_2")], ("k", "ok", "last"))
    found = {r["o"]: (r["in_1"], r["in_2"], r["q_2"], r["last"]) for r in marked.collect()}
    assert found == {
        1: (True, True, False, False), 2: (True, False, True, True), 3: (False, False, False, False), 4: (True, True, True, False),
        5: (False, False, True, True),
    }
    assert marked.columns == [*df.columns, "in_1", "in_2", "q_2", "last"]


def test_kept_rows_are_filtered_by_the_scan(spark, tmp_path):
    raw = spark.createDataFrame([(1, "S1", "a", "b", "z"), (2, None, "a", "b", "z")], f"{ORDINAL} long, id_perito string, nombre string, apellido string, zona_cobertura string")
    curate.adjusters(raw).write.parquet(str(tmp_path / "t"))
    plan = plan_of(kept(spark.read.parquet(str(tmp_path / "t"))).select("id_perito"))
    assert "EqualTo(_kept,true)" in plan or "_kept" in re.findall(r"PushedFilters: \[([^\]]*)\]", plan)[-1]


def test_an_item_that_is_too_dear_is_rejected(spark):
    raw = spark.createDataFrame([(1, "O1", "9999999999.99"), (2, "O2", "10000000000")], f"{ORDINAL} int, id_objeto string, valor_asegurado string")
    assert {r["id_objeto"]: r["_reasons"] for r in curate.items(raw).collect()} == {"O1": [], "O2": ["value_too_large"]}


def test_an_earlier_as_of_is_refused(spark):
    schema = "person_id string, location_sk bigint, occupation string, segment string, sex string, is_third_party boolean"
    person = spark.createDataFrame([("a", 1, "x", "s", "M", False)], schema)
    existing = spark.createDataFrame([], "sk bigint, " + schema + ", valid_from date, valid_to date, is_current boolean")
    first = dims.load_persons(existing, person, dt.date(2026, 7, 1))
    with pytest.raises(ValueError, match="before 2026-07-01"):
        dims.load_persons(first, person.withColumn("occupation", F.lit("y")), dt.date(2026, 6, 30))


def test_ordinal_follows_file_order_over_many_splits(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("id_parte,confirmado_fraude\n" + "".join(f"E{i % 50},{i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_csv(spark, str(path))
        assert df.rdd.getNumPartitions() > 5
        stored = str(tmp_path / "raw")
        df.write.parquet(stored)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    last = dedupe.keep_last(spark.read.parquet(stored), ["id_parte"], [ORDINAL]).collect()
    assert {r["id_parte"]: int(r["confirmado_fraude"]) for r in last} == {f"E{i}": 19950 + i for i in range(50)}


def test_master_geography_round_trip(spark, tmp_path):
    (tmp_path / "p.csv").write_text('"id","nombre"\n"02","Córdoba"\n"06","Salta"\n', encoding="utf-8")
    (tmp_path / "l.csv").write_text("provincia_id,nombre\n02,Villa María\n02,villa maria\n06,Cachí\n99,x\n", encoding="latin-1")
    target = str(tmp_path / "master")
    built = build_master_geography(spark, str(tmp_path / "p.csv"), str(tmp_path / "l.csv"), target)
    pairs = {("CORDOBA", "VILLA MARIA"), ("SALTA", "CACHI")}
    assert {tuple(r) for r in built.collect()} == pairs
    again = read_csv(spark, target).drop(ORDINAL, MALFORMED)
    assert again.columns == ["provincia", "localidad"] and {tuple(r) for r in again.collect()} == pairs


def test_items_can_be_checked_against_policies(spark):
    raw = spark.createDataFrame([(1, "O1", "1"), (2, "O2", "1")], f"{ORDINAL} int, id_objeto string, valor_asegurado string")
    policies = spark.createDataFrame([("O1",)], "id_objeto_asegurado string")
    reasons = {r["id_objeto"]: r["_reasons"] for r in curate.items(raw, policies).collect()}
    assert reasons == {"O1": [], "O2": ["no_policy"]}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) != shared_folder(spark)
    assert materialise(spark.range(5)).count() == 5


# Plans


@pytest.mark.parametrize(
    "name",
    ["canonical_text", "title_junk_clean", "dedupe_mark_last", "dedupe_keep_last", "ri_null_tolerant", "agg_sum_left",
     "curate_claims", "curate_policies", "scd2_state", "fact_policy", "fact_claim", "quarantine"],
)
def test_plans_stay_distributed(spark, name):
    plan = plan_of(ALL[name].run(spark, FOLDER))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad
    # The only exchange into one task carries the bucket counts of the fact keys.
    single = re.findall(r"Exchange SinglePartition.*\n(.*)", plan)
    assert all("HashAggregate(keys=[_bucket" in below for below in single), single
    if name in ("fact_policy", "fact_claim"):
        assert "SortAggregate" not in plan


def test_pushdown_and_pruning(spark):
    plan = plan_of(ALL["project_rename"].run(spark, FOLDER))
    assert "EqualTo(o_orderstatus,F)" in plan
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", plan)[-1]
    assert "o_totalprice" not in schema and "o_orderpriority" not in schema
    agents = table(spark, FOLDER, "supplier").where("s_name <> 'N/A'").select("s_suppkey")
    assert "Not(EqualTo(s_name,N/A))" in plan_of(agents)

"""What a load finds out while it writes: encodings, places of rows, key intervals; and that it does not read or move its history."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from surestar import schemas
from surestar.operators import dedupe, keys, refint
from surestar.operators import quality as q
from surestar.plans import full_load as job
from surestar.session import materialise, scratch, shared_folder
from surestar.sources.feeds import MALFORMED, ORDINAL, decoded, encoding_counts, file_offsets, found_encoding, read_csv, read_csv_any_encoding
from surestar.sources.files import read_text, write_text
from surestar.sources.store import Buckets, Store
from tests.feeds import write_feeds

DAY = dt.date(2026, 6, 30)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Encodings


def test_latin_1_and_utf_8_feeds_in_one_load(spark, tmp_path):
    folder = tmp_path / "feeds"
    write_feeds(folder)
    path = folder / "clientes.csv"
    path.write_bytes(path.read_text(encoding="utf-8").encode("latin-1"))
    audit = job.full_load(spark, str(folder), str(tmp_path / "wh"), DAY, "r1").collect()
    notes = {r["step"]: r["message"] or "" for r in audit}
    assert "encoding: ISO-8859-1" in notes["ingest clients"] and "rows that are not UTF-8: " in notes["ingest clients"]
    assert "encoding: UTF-8" in notes["ingest agents"] and "not UTF-8" not in notes["ingest agents"]
    store = Store(spark, str(tmp_path / "wh"))
    people = {r["id_cliente"]: r["nombre_completo"] for r in store.read("curated_clients").where("_kept").collect()}
    agents = {r["id_agente"]: r["nombre_completo"] for r in store.read("curated_agents").where("_kept").collect()}
    assert people["C1"] == "PEREZ, JOSE" and agents["A1"] == "GOMEZ, INES"
    # The same rows from UTF-8 files.
    job.full_load(spark, write_feeds(tmp_path / "plain"), str(tmp_path / "wh2"), DAY, "r1")
    other = Store(spark, str(tmp_path / "wh2"))
    for table in ("curated_clients", "curated_agents", "curated_items"):
        assert sorted(map(str, store.read(table).collect())) == sorted(map(str, other.read(table).collect()))


def test_each_byte_survives(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("id,año,x\n1,Tucumán,😀\n2,plain,y,surplus ñ\n".encode())
    raw = read_csv(spark, str(path), None)
    assert raw.columns == ["id", "año", "x", MALFORMED, ORDINAL]
    counts = raw.agg(*encoding_counts(raw)).first().asDict()
    assert found_encoding(counts) == "UTF-8" and list(counts.values()) == [2, 0]
    rows = {r["id"]: r for r in decoded(raw, "UTF-8").collect()}
    assert (rows["1"]["año"], rows["1"]["x"], rows["2"][MALFORMED]) == ("Tucumán", "😀", "2,plain,y,surplus ñ")
    (tmp_path / "b.csv").write_bytes(b"\xef\xbb\xbfid,name\n1,\xf1\n2,\xc3\xb1\n\n")
    df = read_csv_any_encoding(spark, str(tmp_path / "b.csv"))
    assert df.columns[:2] == ["id", "name"] and [r["name"] for r in df.orderBy("id").collect()] == ["ñ", "Ã±"]


def test_the_file_is_not_read_again(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(b"id,name\n" + b"".join(f"{i},Jos\xe9\n".encode("latin-1") for i in range(1000)))
    df = read_csv_any_encoding(spark, str(path))
    path.unlink()
    assert "FileScan csv" not in plan_of(df) and df.where("name = 'José'").count() == 1000


# Places of rows


def test_equal_file_names_in_two_folders(spark, tmp_path):
    for name, text in (("a", "first"), ("b", "second")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(f"id,text\nk,{text}\nk,{text} again\n")
    df = read_csv(spark, f"{tmp_path}/*/")
    df.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw")).withColumn("ok", F.col("id").isNotNull())
    assert raw.select(ORDINAL).distinct().count() == 4
    marked = dedupe.mark_last(raw, ["id"], ORDINAL, "ok")
    assert [r["text"] for r in marked.where("_is_last").collect()] == ["second again"]
    assert "SortAggregate" not in plan_of(marked)
    assert [r["text"] for r in raw.orderBy(ORDINAL).collect()] == ["first", "first again", "second", "second again"]


def test_any_number_of_files():
    files = [(f"file:///feeds/{i % 7}/part-{i:05d}.csv", 2**40 + i) for i in range(40_000)]
    offsets = file_offsets(reversed(files))
    assert [p for p, _ in offsets] == sorted(p for p, _ in files)
    sizes = dict(files)
    assert all(low + sizes[p] < high for (p, low), (_, high) in zip(offsets, offsets[1:]))
    assert offsets[-1][1] < 2**63


def test_many_small_files_keep_their_order(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"p{i:04d}.csv").write_text(f"id,n\n{i % 5},{i}\n{i % 5},{i}b")
    rows = read_csv(spark, str(tmp_path)).orderBy(ORDINAL).collect()
    assert [r["n"] for r in rows] == [x for i in range(300) for x in (str(i), f"{i}b")]


# History


@pytest.fixture()
def history(spark, tmp_path):
    store = Store(spark, str(tmp_path / "it's a store"))
    for run, low in (("r1", 0), ("r2", 1000)):
        part = spark.range(low, low + 1000).selectExpr("'P' || id AS policy_id", "id + 1 AS sk")
        seen = {"rows_out": 1000, "new_keys": 1000, "least": low + 1, "highest": low + 1000, "key_sum": (2 * low + 1001) * 500}
        store.append("facts", part, run, lambda seen=seen, low=low: q.noted_keys(seen, {}, low), Buckets("policy_id", 8))
    yield store
    store.release()


def test_history_is_not_moved(spark, history):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = spark.range(1500, 2500).selectExpr("'P' || id AS policy_id", "id AS x")
        fresh = refint.anti_key(new, "policy_id", history.read_appended("facts"))
        plan = plan_of(fresh)
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan, plan
        assert fresh.count() == 500
        looked_up = new.join(history.read_appended("facts"), "policy_id", "left")
        assert plan_of(looked_up).count("Exchange") == 1 and looked_up.where("sk is null").count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert history.read_appended("facts", before="r2").count() == history.read_part("facts", "r2").count() == 1000
    assert history.read_appended("facts").columns == ["policy_id", "sk"]


def test_parts_with_other_buckets_or_none_are_read_all_the_same(spark, history):
    part = spark.range(5000, 5010).selectExpr("'P' || id AS policy_id", "id + 1 AS sk")
    history.append("facts", part, "r3", buckets=Buckets("policy_id", 3))
    assert history.read_appended("facts").count() == 2010
    history.append("facts", part, "r4")
    assert history.read_appended("facts").count() == 2020 and history.part_notes("facts")["r4"] is None


def test_parts_without_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    none = spark.createDataFrame([], "policy_id string, sk bigint")
    store.append("facts", none, "r1", buckets=Buckets("policy_id", 4))
    assert store.read_appended("facts").count() == 0 and store.read_part("facts", "r1").columns == ["policy_id", "sk"]
    store.append("facts", spark.range(9).selectExpr("'P' || id AS policy_id", "id AS sk"), "r2", buckets=Buckets("policy_id", 4))
    assert store.read_appended("facts").count() == 9 and store.read_appended("facts", before="r2").count() == 0
    store.release()


def test_loads_do_not_scan_for_keys_or_rules(spark, tmp_path, monkeypatch):
    def refuse(*args):
        raise AssertionError("keys are scanned")

    monkeypatch.setattr(job, "max_key", refuse)
    monkeypatch.setattr(job.scd, "max_key", refuse)
    monkeypatch.setattr(job.q, "rule_report", refuse)  # rules are counted while tables are written
    feeds, warehouse = write_feeds(tmp_path / "feeds"), str(tmp_path / "wh")
    for run, day in (("r1", DAY), ("r2", DAY + dt.timedelta(1)), ("r1", DAY + dt.timedelta(2))):
        audit = {r["step"]: r for r in job.full_load(spark, feeds, warehouse, day, run).collect()}
        assert audit["full load"]["status"] == "OK", audit
    store = Store(spark, warehouse)
    for name in schemas.DIMENSIONS:
        assert store.notes(name)["highest"] == keys.max_key(store.read(name), "sk"), name
    for name, key in job.FACT_IDS.items():
        noted, rows = store.part_notes(name), store.read_appended(name)
        assert max(n["highest"] for n in noted.values()) == keys.max_key(rows, "sk")
        assert {n["rows"] for n in noted.values()} == {rows.count(), 0} and all(n["buckets"] == [key, 16] for n in noted.values())
    report = {r["rule"]: r["violations"] for r in store.read_appended("dq_report").collect() if ": keys " in r["rule"]}
    assert len(report) == 6 and not any(report.values())
    for name in (*schemas.DIMENSIONS, *schemas.FACTS):
        rules = job.report_rules(name)
        rows = store.read_part(name, "r2", schemas.FACTS[name]) if name in schemas.FACTS else store.read(name).where("sk <> -1")
        noted = store.part_notes(name)["r2"] if name in schemas.FACTS else store.notes(name)
        assert noted["violations"] == q.violations(rules, rows.agg(*q.rule_counters(rules)).first().asDict()), name
    missed = {n: v for n, v in store.part_notes("fact_policy")["r1"]["violations"].items() if v}
    assert missed.get("plan_sk found") and missed.get("item_sk found")
    assert not [n for n in spark.catalog.listTables() if n.name.startswith("surestar_") and n.tableType != "EXTERNAL"]


def test_a_store_without_notes_is_scanned(spark, tmp_path):
    feeds, warehouse = write_feeds(tmp_path / "feeds"), str(tmp_path / "wh")
    job.full_load(spark, feeds, warehouse, DAY, "r1")
    for note in (tmp_path / "wh").rglob("_notes.json"):
        if "raw_" not in str(note):
            note.write_text("{}")
    states = [sorted(map(str, Store(spark, warehouse).read_appended(n).collect())) for n in schemas.FACTS]
    audit = {r["step"]: r for r in job.full_load(spark, feeds, warehouse, DAY, "r2").collect()}
    assert audit["full load"]["status"] == "OK"
    assert states == [sorted(map(str, Store(spark, warehouse).read_appended(n).collect())) for n in schemas.FACTS]


def test_a_small_file_changed_by_hand_can_be_read(spark, tmp_path):
    path = tmp_path / "_notes.json"
    for text in ("first", "second"):
        write_text(spark, str(path), text)
        assert read_text(spark, str(path)) == text
    path.write_text("{}")
    assert read_text(spark, str(path)) == "{}"


def test_two_runs_with_one_key_are_seen_without_their_rows(spark):
    def part(least, most, rows=None, odd=False):
        return {"rows": most - least + 1 if rows is None else rows, "intervals": [[least, most]], "odd": odd, "highest": most}

    def report(**notes):
        return [r["violations"] for r in q.key_interval_report(spark, "t", notes).collect()]

    assert report(a=part(1, 10), b=part(11, 20)) == [0, 0, 0] == report()
    assert report(a=part(1, 10), b=part(10, 20)) == [1, 0, 0]
    assert report(a=part(1, 100), b=part(20, 30), c=part(25, 26)) == [13, 0, 0]
    assert report(a=part(1, 10, rows=8)) == [0, 2, 0]
    assert report(a=part(1, 10, odd=True), b=None) == [0, 0, 2]
    # A repeated run keeps its interval and adds another.
    again = q.noted_keys({"rows_out": 12, "new_keys": 2, "least": 21, "highest": 22, "key_sum": 43}, part(1, 10), 20)
    assert again["intervals"] == [[1, 10], [21, 22]] and not again["odd"] and report(a=again, b=part(11, 20)) == [0, 0, 0]
    assert q.noted_keys({"rows_out": 2, "new_keys": 2, "least": 1, "highest": 3, "key_sum": 4}, {}, 0)["odd"]
    assert q.noted_keys({"rows_out": 0, "new_keys": 0, "least": None, "highest": None, "key_sum": None}, {}, 7)["intervals"] == []


def test_counts_of_new_keys(spark):
    df = spark.createDataFrame([(3,), (4,), (5,), (1,)], "sk bigint")
    counts = df.agg(*q.new_key_counts("sk", 2), F.count("*").alias("rows_out")).first().asDict()
    noted = q.noted_keys(counts, {"intervals": [[1, 1]], "highest": 1}, 2)
    assert noted == {"rows": 4, "intervals": [[1, 1], [3, 5]], "highest": 5, "odd": False}
    twice = spark.createDataFrame([(3,), (3,), (4,), (6,)], "sk bigint").agg(*q.new_key_counts("sk", 2), F.count("*").alias("rows_out"))
    assert q.noted_keys(twice.first().asDict(), {}, 2)["odd"]


# The shared folder


def test_a_folder_of_one_machine_is_refused_on_a_cluster(spark, tmp_path):
    def session(master, **conf):
        settings = {"spark.sql.warehouse.dir": f"file:{tmp_path}", **conf}
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)),
            sparkContext=SimpleNamespace(master=master), _jvm=spark._jvm, _jsc=spark._jsc,
        )

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master))
        assert shared_folder(session(master, **{"spark.surestar.sharedWarehouse": "true"})).startswith(f"file:{tmp_path}")
        assert shared_folder(session(master, **{"spark.checkpoint.dir": "file:/mnt/all"})).startswith("file:/mnt/all/")
    assert shared_folder(session("local[4]")).startswith(f"file:{tmp_path}")


def test_a_step_leaves_nothing_behind(spark):
    with scratch(spark):
        kept = materialise(spark.range(5))
        (path,) = {f.rsplit("/", 1)[0] for f in kept.inputFiles()}
        assert kept.count() == 5
        with scratch(spark):
            materialise(spark.range(3))
        assert kept.count() == 5
    with pytest.raises(Exception, match="(?i)path_not_found|not exist"):
        spark.read.parquet(path).count()


def members(spark, n, **changed):
    values = {i: f"m{i}" for i in range(1, n + 1)} | {int(k[1:]): v for k, v in changed.items()}
    rows = [(-1, "unknown"), *sorted(values.items())]
    return spark.createDataFrame(rows, "sk long, name string")


def test_only_ranges_that_differ_are_written(spark, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))

    def load(df):
        return store.replace_ranges("d", df, df, "sk", 10, lambda: {"highest": 7})

    def files(version):
        return {p.parent.name for p in (tmp_path / "wh" / "d" / version).rglob("*.parquet")}

    assert load(members(spark, 35)) == [-1, 0, 1, 2, 3] and store.notes("d")["highest"] == 7
    assert load(members(spark, 35)) == [] and store._versions("d") == [1]
    assert load(members(spark, 35, k12="x")) == [1] and files("v=2") == {"_range=1"}
    grown = members(spark, 41, k12="x", k5=None)
    assert load(grown) == [0, 3, 4] and files("v=3") == {"_range=0", "_range=3", "_range=4"}
    assert sorted(store.read("d").collect()) == sorted(grown.collect()) and store.read("d").columns == ["sk", "name"]
    fewer = members(spark, 19, k12="x", k5=None)
    assert load(fewer) == [] and sorted(store.read("d").collect()) == sorted(fewer.collect())
    store.replace("d", members(spark, 3))
    assert store.read("d").count() == 4


def test_a_version_of_ranges_counts_once_it_is_complete(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "wh"))
    old, new = members(spark, 25), members(spark, 25, k3="x")
    store.replace_ranges("d", old, old, "sk", 10)

    def fails(*args, **more):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_note", fails)
        with pytest.raises(OSError):
            store.replace_ranges("d", new, new, "sk", 10)
    assert sorted(store.read("d").collect()) == sorted(old.collect())
    assert store.replace_ranges("d", new, new, "sk", 10) == [0]
    assert sorted(store.read("d").collect()) == sorted(new.collect())

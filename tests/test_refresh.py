"""Refreshes from new files alone give what a build from all files gives, and touch no more than they must."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cashline.operators.buckets import bucket_of, write_buckets
from cashline.operators.versions import changed_periods, scd2
from cashline.plans import build, commits, refresh
from cashline.plans.build import BuildResult, Model, build_models
from cashline.plans.commits import build_log, current_tables, remove_old_builds, stored_tables
from cashline.plans.publish import publish
from cashline.plans.refresh import new_raw_rows, refresh_all, refresh_tables
from cashline.schema import RAW_COLUMNS
from cashline.sources.raw import raw_tables
from cashline.sources.seeds import exchange_rates
from conftest import raw_frame

DAYS = [f"202601{d:02d}" for d in range(1, 9)]
ONLY = ["fct_delivery_items"]


def put(folder, r, day):
    """Some rows of every table on a day; few keys, so that most come again."""
    doc, who = (lambda: f"{r.randrange(1, 7):010d}"), (lambda: f"{r.randrange(1, 4):010d}")
    date = lambda: r.choice(DAYS + ["00000000"])
    item = lambda: f"{r.randrange(1, 3) * 10:06d}"
    some = lambda make: [make() for _ in range(r.randrange(4))]
    amount = lambda: f"{r.randrange(1000)}.50"
    rows = {
        "KNA1": some(lambda: {"KUNNR": who(), "NAME1": "N", "ORT01": r.choice(["Pella", "Ames", ""]), "LAND1": "US", "ERDAT": day}),
        "MARA": some(lambda: {"MATNR": doc(), "MTART": r.choice("AB"), "ERSDA": day, "LAEDA": date()}),
        "MAKT": some(lambda: {"MATNR": doc(), "SPRAS": r.choice("DE"), "MAKTX": r.choice("xyz")}),
        "VBAK": some(lambda: {"VBELN": doc(), "AUDAT": r.choice(DAYS), "KUNNR": who(), "WAERK": "CAD", "NETWR": amount(), "ERDAT": day, "AEDAT": date()}),
        "VBAP": some(lambda: {"VBELN": doc(), "POSNR": item(), "MATNR": doc(), "KWMENG": "5", "NETWR": amount(), "WAERK": r.choice(["USD", "CAD"]), "ERDAT": day, "AEDAT": date()}),
        "VBRK": some(lambda: {"VBELN": doc(), "FKDAT": r.choice(DAYS), "KUNRG": who(), "WAERK": "USD", "NETWR": amount(), "ERDAT": day, "AEDAT": date()}),
        "VBRP": some(lambda: {"VBELN": doc(), "POSNR": item(), "AUBEL": doc(), "AUPOS": item(), "MATNR": doc(), "FKIMG": "2", "NETWR": amount(), "ERDAT": day, "AEDAT": date()}),
        "LIKP": some(lambda: {"VBELN": doc(), "KUNNR": who(), "LFDAT": r.choice(DAYS), "ERDAT": day, "AEDAT": date()}),
        "LIPS": some(lambda: {"VBELN": doc(), "POSNR": item(), "VGBEL": doc(), "VGPOS": item(), "LFIMG": "1", "ERDAT": day, "AEDAT": date()}),
        "BSID": some(lambda: {"BUKRS": "1", "BELNR": doc(), "GJAHR": "2026", "BUZEI": "1", "KUNNR": who(), "BUDAT": r.choice(DAYS), "WRBTR": amount(), "WAERS": "USD"}),
        "BSAD": some(lambda: {"BUKRS": "1", "BELNR": doc(), "GJAHR": "2026", "BUZEI": "1", "KUNNR": who(), "BUDAT": r.choice(DAYS), "AUGDT": r.choice(DAYS)}),
    }
    for table, found in rows.items():
        folder.rows(table, day, *found)


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def same_as_a_build(spark, out, tables=None):
    raw = raw_tables(spark, f"{out}/raw")
    rates = exchange_rates(spark)
    whole = build.all_tables(raw, rates)
    now = current_tables(spark, out)
    for name in tables or refresh.ALL_TABLES:
        assert rows_of(now[name]) == rows_of(whole[name]), name


def test_days_in_any_order_give_the_tables_of_one_build(spark, folder, tmp_path):
    r, out = random.Random(1), str(tmp_path / "out")
    days = r.sample(DAYS, 5)
    for some in (days[:3], days[3:]):
        for day in some:
            put(folder, r, day)
        done = refresh_all(spark, str(folder), out, n_buckets=4, only=refresh.ALL_TABLES)
        assert done.files == 11 * len(some)
    same_as_a_build(spark, out)
    before = stored_tables(spark, out)
    again = refresh_all(spark, str(folder), out, n_buckets=4)
    assert again.build_id is None and not again.buckets and stored_tables(spark, out) == before
    # Rows that were taken in before change nothing.
    old = {t: df for t, df in raw_tables(spark, f"{out}/raw").items() if t in ("KNA1", "VBAK", "VBAP")}
    assert not refresh_tables(spark, out, old).buckets


def orders(n, **more):
    return {"VBELN": f"{n:010d}", "KUNNR": "0000000001", "AUDAT": "20260103", "WAERK": "USD", "NETWR": "1.00", "ERDAT": "20260101", "AEDAT": "00000000", **more}


def items(n, **more):
    return {"VBELN": f"{n:010d}", "POSNR": "000010", "KWMENG": "1", "NETWR": "1.00", "WAERK": "USD", "ERDAT": "20260101", "AEDAT": "00000000", **more}


@pytest.fixture
def small(spark, folder, tmp_path):
    """Forty orders of one item, of which every fifth is of customer 2, after a first refresh."""
    out = str(tmp_path / "out")
    who = lambda n: f"{2 if n % 5 == 0 else 1:010d}"
    folder.rows("KNA1", "20260101", *[{"KUNNR": f"{n:010d}", "ORT01": "Pella"} for n in (1, 2)])
    folder.rows("VBAK", "20260101", *[orders(n, KUNNR=who(n)) for n in range(40)])
    folder.rows("VBAP", "20260101", *[items(n) for n in range(40)])
    refresh_all(spark, str(folder), out, n_buckets=16, only=["fct_sales_order_items"])
    return out


def test_only_new_files_are_read_and_only_their_buckets_written(spark, folder, small):
    folder.rows("VBAK", "20260102", orders(7, NETWR="9.00", AEDAT="20260102"))
    folder.rows("VBAP", "20260102", items(7), items(8))
    before = stored_tables(spark, small)
    done = refresh_all(spark, str(folder), small, only=["fct_sales_order_items"])
    after = stored_tables(spark, small)
    bucket = done.buckets["stg_sap__vbak"]
    assert len(bucket) == 1 and done.buckets["fct_sales_order_items"] == sorted({*bucket, *done.buckets["stg_sap__vbap"]})
    assert len(done.buckets["stg_sap__vbap"]) <= 2 and "dim_customer" not in done.buckets
    for name, table in before.items():
        kept = set(table.paths) - set(done.buckets.get(name, ()))
        assert {b: table.paths[b] for b in kept} == {b: after[name].paths[b] for b in kept}
    read = new_raw_rows(spark, f"{small}/raw", "VBAK", ["VBAK_20260102.csv"])
    assert {f.split("/")[-2] for f in read.inputFiles()} == {"_source_file=VBAK_20260102.csv"}
    same_as_a_build(spark, small, done.buckets)


def test_the_refresh_reads_the_folders_of_new_files_alone(spark, folder, small, monkeypatch):
    seen = []
    read = refresh.new_raw_rows
    monkeypatch.setattr(refresh, "new_raw_rows", lambda *a: seen.append((a[2], a[3])) or read(*a))
    monkeypatch.setattr(build, "raw_tables", None)
    folder.rows("VBAP", "20260104", items(3, KWMENG="4", AEDAT="20260104"))
    folder.rows("KNA1", "20260104")
    refresh_all(spark, str(folder), small, only=["fct_sales_order_items"])
    assert seen == [("VBAP", ["VBAP_20260104.csv"])]


def test_late_customer_days_reach_the_facts_dated_there_and_no_others(spark, folder, small):
    folder.rows("KNA1", "20260102", {"KUNNR": "0000000002", "ORT01": "Ames"})
    done = refresh_all(spark, str(folder), small, only=["fct_sales_order_items"])
    facts = current_tables(spark, small)["fct_sales_order_items"]
    theirs = facts.filter(F.col("sales_order_id").cast("int") % 5 == 0)
    touched = {r[0] for r in theirs.select(refresh.bucket_of(["sales_order_id"], 16)).distinct().collect()}
    assert set(done.buckets["fct_sales_order_items"]) == touched
    assert set(done.buckets) == {"customer_days", "dim_customer", "fct_sales_order_items"}
    assert theirs.select("customer_key").distinct().count() == 1
    same_as_a_build(spark, small, ["fct_sales_order_items", "dim_customer"])
    # A day after all orders makes a version that no order is dated in.
    folder.rows("KNA1", "20260105", {"KUNNR": "0000000002", "ORT01": "Pella"})
    done = refresh_all(spark, str(folder), small, only=["fct_sales_order_items"])
    assert "fct_sales_order_items" not in done.buckets and "dim_customer" in done.buckets
    same_as_a_build(spark, small, ["fct_sales_order_items", "dim_customer"])


def test_late_days_split_extend_and_merge_versions(spark, tmp_path):
    out = str(tmp_path / "out")

    def comes(*days):
        """States (day, city) of one customer."""
        rows = [(f"KNA1_202601{d:02d}.csv", 1, {"KUNNR": "0000000001", "ORT01": c}) for d, c in days]
        refresh_tables(spark, out, {"KNA1": raw_frame(spark, "KNA1", rows)}, only=["dim_customer"], n_buckets=2)
        versions = current_tables(spark, out)["dim_customer"].orderBy("valid_from").collect()
        assert all(v.valid_to == w.valid_from - dt.timedelta(1) for v, w in zip(versions, versions[1:]))
        return [(r.city, r.valid_from.day) for r in versions]

    assert comes((5, "A"), (9, "A")) == [("A", 5)]
    assert comes((7, "B")) == [("A", 5), ("B", 7), ("A", 9)]  # splits
    assert comes((8, "A"), (3, "A")) == [("A", 3), ("B", 7), ("A", 8)]  # extends to earlier starts
    assert comes((6, "B"), (2, "B")) == [("B", 2), ("A", 3), ("B", 6), ("A", 8)]
    rows = [("KNA1_20260107.csv", 2, {"KUNNR": "0000000001", "ORT01": "A"}), ("KNA1_20260106.csv", 2, {"KUNNR": "0000000001", "ORT01": "A"})]
    refresh_tables(spark, out, {"KNA1": raw_frame(spark, "KNA1", rows)}, only=["dim_customer"])
    found = current_tables(spark, out)["dim_customer"].orderBy("valid_from").collect()
    assert [(r.city, r.valid_from.day) for r in found] == [("B", 2), ("A", 3)]  # merges


def test_a_state_of_the_same_day_replaces_and_merges(spark, tmp_path):
    out = str(tmp_path / "out")
    row = lambda day, load, city: (f"KNA1_{day}.csv", load, {"KUNNR": "0000000001", "ORT01": city})
    first = raw_frame(spark, "KNA1", [row("20260101", 1, "A"), row("20260102", 1, "B"), row("20260103", 1, "A")])
    refresh_tables(spark, out, {"KNA1": first}, only=["dim_customer"], n_buckets=2)
    # Loaded before what is there, so it is passed over; then one loaded after.
    for load, n in ((0, 3), (2, 1)):
        later = raw_frame(spark, "KNA1", [row("20260102", load, "A")])
        refresh_tables(spark, out, {"KNA1": later}, only=["dim_customer"])
        assert current_tables(spark, out)["dim_customer"].count() == n
    later = raw_frame(spark, "KNA1", [row("20260101", 3, "C")])
    refresh_tables(spark, out, {"KNA1": later}, only=["dim_customer"])
    found = current_tables(spark, out)["dim_customer"].orderBy("valid_from").collect()
    assert [(r.city, r.valid_from.day) for r in found] == [("C", 1), ("A", 2)]


@pytest.mark.parametrize("seed", range(3))
def test_changed_periods_day_by_day(spark, seed):
    r = random.Random(seed)
    start = dt.date(2026, 1, 1)
    rows = [(k, start + dt.timedelta(r.randrange(20)), r.choice("AB"), n) for n, k in enumerate(r.choices([1, 2, None], k=40))]

    def history(some):
        df = spark.createDataFrame(some, "id int, valid_from date, city string, n int")
        return scd2(df, key="id", attributes=["city"], order_by=[F.desc("n")])

    old, new = history(rows[:25]), history(rows)
    found = changed_periods(old, new, key="id", version_key="version_key").collect()
    in_force = lambda df: {
        (v.id, d): v.version_key for v in df.collect() for d in days if v.valid_from <= d <= v.valid_to
    }
    days = [start + dt.timedelta(n) for n in range(-2, 25)]
    before, after = in_force(old), in_force(new)
    want = {(k, d) for k in (1, 2, None) for d in days if before.get((k, d)) != after.get((k, d))}
    got = [(p.id, d) for p in found for d in days if p.first_day <= d <= p.last_day]
    assert set(got) == want and len(got) == len(want)


def test_a_refresh_that_dies_is_made_up_for_by_the_next(spark, folder, small, monkeypatch):
    before = rows_of(current_tables(spark, small)["fct_sales_order_items"])
    folder.rows("VBAP", "20260104", items(3, KWMENG="4", AEDAT="20260104"))

    def die(*_, **__):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(refresh, "commit", die)
    with pytest.raises(RuntimeError):
        refresh_all(spark, str(folder), small, only=["fct_sales_order_items"])
    assert rows_of(current_tables(spark, small)["fct_sales_order_items"]) == before
    monkeypatch.undo()
    assert refresh_all(spark, str(folder), small, only=["fct_sales_order_items"]).files == 1
    same_as_a_build(spark, small, ["fct_sales_order_items"])
    gone = remove_old_builds(spark, small, keep=1)
    assert gone  # the folders of the refresh that died, and buckets that were replaced
    same_as_a_build(spark, small, ["fct_sales_order_items", "stg_sap__vbap", "stg_sap__vbak"])


def test_changed_rates_reach_all_facts(spark, folder, small):
    rates = spark.createDataFrame([("USD", 2)], "currency string, n int").select("currency", F.col("n").cast("decimal(9,6)").alias("rate_to_usd"))
    done = refresh_tables(spark, small, {}, rates=rates, only=["fct_sales_order_items"])
    assert set(done.buckets) == {"fct_sales_order_items"}
    facts = current_tables(spark, small)["fct_sales_order_items"]
    assert facts.filter("net_value_usd = 2").count() == facts.count() == 40


def test_failed_checks_keep_readers_where_they_were(spark, folder, small):
    folder.rows("VBAP", "20260104", items(3, WAERK="EUR", AEDAT="20260104"))
    with pytest.raises(refresh.RefreshFailed, match="accepted_values_stg_sap__vbap_currency"):
        refresh_all(spark, str(folder), small, only=["fct_sales_order_items"], check=True)
    assert current_tables(spark, small)["stg_sap__vbap"].filter("currency = 'EUR'").isEmpty()


def test_tables_that_are_not_there_are_made_of_all_files(spark, folder, small):
    folder.rows("VBAK", "20260104", orders(50))
    done = refresh_all(spark, str(folder), small, only=["dim_date"], n_buckets=8)
    assert done.files == 4  # among them those that the first refresh took in without billing documents
    same_as_a_build(spark, small, ["dim_date", "stg_sap__vbak", "stg_sap__vbrk"])


def test_readers_see_one_build_and_can_go_back(spark, folder, small):
    first = build_log(spark, small).first()["build_id"]
    folder.rows("VBAP", "20260104", items(60), items(3, KWMENG="4", AEDAT="20260104"))
    second = refresh_all(spark, str(folder), small, only=["fct_sales_order_items"]).build_id
    for name, n in ((first, 40), (second, 41), (None, 41)):
        assert current_tables(spark, small, name)["stg_sap__vbap"].count() == n
    publish(spark, small, first)
    assert spark.sql("select count(*) from staging.stg_sap__vbap").first()[0] == 40
    publish(spark, small)
    found = spark.sql("select * from staging.stg_sap__vbap")
    assert found.count() == 41 and found.columns == current_tables(spark, small)["stg_sap__vbap"].columns
    with pytest.raises(ValueError, match="no build nowhere"):
        current_tables(spark, small, "nowhere")


def test_a_reader_during_a_build_sees_the_build_before(spark, tmp_path):
    out, seen = str(tmp_path / "out"), []

    def model(n):
        def make(tables):
            seen.append({name: df.count() for name, df in current_tables(spark, out).items()})
            return spark.range(n)

        return make

    for n in (1, 2):
        models = {"a": Model("marts", (), model(n)), "b": Model("marts", ("a",), model(n))}
        build_models(spark, {}, out, BuildResult(None), models=models)
    assert seen == [{}, {}, {"a": 1, "b": 1}, {"a": 1, "b": 1}]
    assert {name: df.count() for name, df in current_tables(spark, out).items()} == {"a": 2, "b": 2}


def test_two_writers_of_the_log_lose_no_row(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    entry = [commits.Entry("t", "marts", "marts/t")]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: commits.commit(spark, str(tmp_path), f"b{n}", entry), range(8)))
    assert build_log(spark, str(tmp_path)).count() == 8


def test_a_refresh_of_nothing(spark, tmp_path):
    done = refresh_tables(spark, str(tmp_path / "out"), {}, n_buckets=2)
    assert set(done.buckets) >= set(refresh.ALL_TABLES) - {"dim_date"}
    now = current_tables(spark, str(tmp_path / "out"))
    assert set(now) == set(refresh.ALL_TABLES) and not any(df.count() for df in now.values())
    assert all(now[spec_name].columns for spec_name in now) and len(RAW_COLUMNS) == 11


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    """Two buckets of 8 tasks' rows: split by size, so that no task sorts a whole bucket."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    saved = spark.conf.get(name, None)
    spark.conf.set(name, "64kb")
    try:
        df = spark.range(0, 80_000, 1, 8).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
        write_buckets(df, ["id"], 2, str(tmp_path / "out"))
    finally:
        spark.conf.unset(name) if saved is None else spark.conf.set(name, saved)
    for bucket in (0, 1):
        assert len(list((tmp_path / f"out/bucket={bucket}").glob("part-*"))) > 2
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.filter(stored.bucket != bucket_of(["id"], 2)).count() == 0
    assert rows_of(stored.drop("bucket")) == rows_of(df)


def test_first_rows_are_compared_with_nothing(spark, tmp_path, monkeypatch):
    """A first refresh neither joins new rows with a table that has none nor writes them twice; the next one compares."""
    joined, settled = [], []
    newer, settle = refresh.newer_rows, refresh._Refresh.settled
    monkeypatch.setattr(refresh, "newer_rows", lambda *a: joined.append(a[4]) or newer(*a))
    monkeypatch.setattr(refresh._Refresh, "settled", lambda self, df, name: settled.append(name) or settle(self, df, name))
    out = str(tmp_path / "out")
    row = lambda load, day, net: raw_frame(spark, "VBAK", [
        (f"VBAK_{day}.csv", load, {"VBELN": "1", "AUDAT": day, "KUNNR": "c", "NETWR": net, "ERDAT": day})
    ])
    first = refresh_tables(spark, out, {"VBAK": row(1, "20260101", "1.00")}, only=["stg_sap__vbak"], n_buckets=2)
    assert not joined and settled == ["new-stg_sap__vbak"] and len(first.buckets["stg_sap__vbak"]) == 1
    refresh_tables(spark, out, {"VBAK": row(2, "20260102", "2.00")}, only=["stg_sap__vbak"])
    assert joined == [("order_date",)]
    assert [r["net_value"] for r in current_tables(spark, out)["stg_sap__vbak"].collect()] == [2]


@pytest.mark.parametrize("n_buckets, looked", [(1, 0), (64, 1)])
def test_documents_are_looked_for_until_all_buckets_are_touched(spark, folder, tmp_path, monkeypatch, n_buckets, looked):
    calls = []
    matching = refresh.matching
    monkeypatch.setattr(refresh, "matching", lambda *a: calls.append(a) or matching(*a))
    invoice = lambda n, **more: {"VBELN": f"{n:010d}", "FKDAT": "20260103", "KUNRG": "0000000001", "ERDAT": "20260101", **more}
    billed = lambda n: {"VBELN": f"{n:010d}", "POSNR": "000010", "AUBEL": f"{n:010d}", "AUPOS": "000010", "ERDAT": "20260101"}
    folder.rows("KNA1", "20260101", {"KUNNR": "0000000001"})
    folder.rows("VBRK", "20260101", *[invoice(n) for n in range(9)])
    folder.rows("VBRP", "20260101", *[billed(n) for n in range(9)])
    refresh_all(spark, str(folder), str(tmp_path / "out"), n_buckets=n_buckets, only=["fct_billing_items"])
    assert not calls
    # One invoice changes, and the order items of all come late.
    folder.rows("VBRK", "20260102", invoice(3, FKSTO="X", AEDAT="20260102"))
    folder.rows("VBAP", "20260102", *[items(n) for n in range(9)])
    refresh_all(spark, str(folder), str(tmp_path / "out"), only=["fct_billing_items"])
    assert len(calls) == looked
    facts = current_tables(spark, str(tmp_path / "out"))["fct_billing_items"]
    assert facts.filter("not is_orphan_item").count() == 9 and facts.filter("is_cancelled").count() == 1

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from cashline.schema import LOADED_AT, RAW_COLUMNS, SOURCE_FILE
from cashline.sources import extracts, raw
from cashline.sources.claims import Claims
from cashline.sources.extracts import LoadError
from cashline.storage import create_new
from cashline.streaming.ingest import stream_extracts
from conftest import collected


def customer(n, **more):
    return {"KUNNR": f"{n:010d}", "NAME1": f"C{n}", "ORT01": "Pella", "LAND1": "US", "ERDAT": "20260101", **more}


def fill(folder, days):
    for day in days:
        folder.rows("KNA1", day, customer(1), customer(2))
        folder.rows("VBAK", day)
        folder.rows("MAKT", day, {"MATNR": "1", "SPRAS": "E", "MAKTX": "x"})


def load(spark, folder, tmp_path):
    return raw.load_extracts(spark, str(folder), str(tmp_path / "raw"))


def rows(spark, tmp_path, table="KNA1"):
    return raw.raw_table(spark, str(tmp_path / "raw"), table)


def log(spark, tmp_path):
    return raw.load_log(spark, str(tmp_path / "raw"))


def test_every_file_once_then_only_new_days(spark, folder, tmp_path):
    fill(folder, ["20260101", "20260102"])
    assert load(spark, folder, tmp_path) == raw.LoadResult(6, 0, 6)
    assert str(load(spark, folder, tmp_path)) == "loaded 0 files (0 rows), skipped 6"
    fill(folder, ["20260103"])
    assert load(spark, folder, tmp_path) == raw.LoadResult(3, 6, 3)
    assert log(spark, tmp_path).agg(F.count("*"), F.sum("row_count")).first() == (9, 9)
    assert rows(spark, tmp_path).count() == 6
    assert collected(log(spark, tmp_path).filter("table_name = 'VBAK'").select("row_count").distinct()) == [(0,)]


def test_raw_is_text_with_lineage(spark, folder, tmp_path):
    folder.put("KNA1", "20260101", '100,0000000001,"Smith, Jones & ""Co""",,"",\\N,00000000\n')
    load(spark, folder, tmp_path)
    got = rows(spark, tmp_path)
    assert got.columns == [*RAW_COLUMNS["KNA1"], LOADED_AT, SOURCE_FILE]
    assert {t for c, t in got.dtypes if c != LOADED_AT} == {"string"}
    assert tuple(got.drop(LOADED_AT).first()) == (
        "100", "0000000001", 'Smith, Jones & "Co"', "", "", None, "00000000", "KNA1_20260101.csv",
    )


def test_columns_are_read_by_name(spark, folder, tmp_path):
    fill(folder, ["20260101"])
    folder.put("KNA1", "20260102", "US,7,100,n,c,r,20260102\n", "LAND1,KUNNR,MANDT,NAME1,ORT01,REGIO,ERDAT\n")
    load(spark, folder, tmp_path)
    got = rows(spark, tmp_path).filter(F.col(SOURCE_FILE) == "KNA1_20260102.csv").select("KUNNR", "LAND1", "REGIO")
    assert collected(got) == [("7", "US", "r")]


def test_line_breaks_inside_quotes(spark, folder, tmp_path):
    folder.put("KNA1", "20260101", '100,1,"two\nlines ""q"" ",a,b,US,20260101\n100,2,5" pipe,a,b,US,20260101\n,,,,,,\n')
    folder.put("KNA1", "20260102", '100,3,"a\r\nb",x,y,US,20260101\r\n100,4,"\n\n","\n",y,US,20260101\r\n', ",".join(RAW_COLUMNS["KNA1"]) + "\r\n")
    assert load(spark, folder, tmp_path).rows_loaded == 5
    assert collected(rows(spark, tmp_path).select("KUNNR", "NAME1", "ORT01"), "KUNNR") == [
        ("", "", ""), ("1", 'two\nlines "q" ', "a"), ("2", '5" pipe', "a"), ("3", "a\r\nb", "x"), ("4", "\n\n", "\n"),
    ]


def test_line_breaks_across_many_small_splits(spark, folder, tmp_path):
    """Splits of a few bytes start anywhere, also inside quotes and next to stray quotes."""
    names = ["plain", "a\nb", 'q"x', '"', "\n", "x,y\n,", 'end"\n"', ""] * 40
    body = "".join(
        '100,{:05d},"{}",c{},r,US,20260101\n'.format(n, name.replace('"', '""'), '"' if n % 3 == 0 else "")
        for n, name in enumerate(names)
    )
    folder.put("KNA1", "20260101", body)
    settings = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "1b"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lines = spark.read.text(str(folder.root / "KNA1"))
        assert lines.rdd.getNumPartitions() > 10
        assert load(spark, folder, tmp_path).rows_loaded == len(names)
    finally:
        for key in settings:
            spark.conf.unset(key)
    got = collected(rows(spark, tmp_path).select("KUNNR", "NAME1", "ORT01"), "KUNNR")
    assert got == [(f"{n:05d}", name, 'c"' if n % 3 == 0 else "c") for n, name in enumerate(names)]


@pytest.mark.parametrize(
    "header, body, complaint",
    [
        ("MANDT,VBELN\n", "100,1\n", "lacking"),
        ("", "", "lacking"),
        ("MANDT,KUNNR,NAME1,ORT01,REGIO,LAND1,ERDAT,MORE\n", "1,1,1,1,1,1,1,1\n", "\\['MORE'\\] unknown"),
        ("MANDT,KUNNR,NAME1,ORT01,REGIO,LAND1,ERDAT,MANDT\n", "1,1,1,1,1,1,1,1\n", "repeats"),
        (None, b"100,9,M\xfcller,X,Y,US,20260106\n", "UTF-8"),
        (None, "100,9,short\n", "expected 7"),
        (None, "100,9,a,b,c,d,e,f\n", "expected 7"),
        (None, '100,9,"open,b,c,d,e\n', "quotes"),
        (None, '100,9,"x\ny",b\n', "expected 7"),
    ],
)
def test_bad_file_is_named_and_leaves_nothing(spark, folder, tmp_path, header, body, complaint):
    fill(folder, ["20260101"])
    folder.put("KNA1", "20260106", body, header)
    with pytest.raises(LoadError, match=f"KNA1_20260106.csv: .*{complaint}"):
        load(spark, folder, tmp_path)
    assert rows(spark, tmp_path).filter(F.col(SOURCE_FILE) == "KNA1_20260106.csv").count() == 0
    assert log(spark, tmp_path).count() == 3  # the good files are loaded
    with pytest.raises(LoadError):
        load(spark, folder, tmp_path)
    assert rows(spark, tmp_path).count() == 2


@pytest.mark.parametrize("text", ["x\n" * 60, "x " * 60, "x" * 120])
def test_record_limit_holds_alike_on_one_line_and_on_several(spark, folder, tmp_path, text):
    folder.put("KNA1", "20260101", f'100,1,"{text}",a,b,US,20260101\n')
    with pytest.raises(LoadError, match="longer than 100"):
        raw.load_extracts(spark, str(folder), str(tmp_path / "raw"), max_record_bytes=100)
    raw.load_extracts(spark, str(folder), str(tmp_path / "raw"), max_record_bytes=200)
    assert rows(spark, tmp_path).count() == 1


@pytest.mark.parametrize("text", ["x" * 3_000_000, "x" * 1_500_000 + "\n" + "y" * 1_500_000])
def test_a_record_of_three_megabytes(spark, folder, tmp_path, text):
    folder.put("KNA1", "20260101", f'100,1,"{text}",a,b,US,20260101\n')
    with pytest.raises(LoadError, match="longer than 2000000"):
        load(spark, folder, tmp_path)
    raw.load_extracts(spark, str(folder), str(tmp_path / "raw"), max_record_bytes=4_000_000)
    assert rows(spark, tmp_path).first()["NAME1"] == text


def test_many_unusual_headers_and_no_work_folders_left(spark, folder, tmp_path):
    columns = RAW_COLUMNS["KNA1"]
    for n in range(len(columns)):
        turned = columns[n:] + columns[:n]
        name = 'a\nb' if n % 2 else "a"
        folder.put("KNA1", f"202601{n + 10}", ",".join(f'"{name} {n}"' if c == "NAME1" else str(n) for c in turned) + "\n", ",".join(turned) + "\n")
    assert load(spark, folder, tmp_path).files_loaded == len(columns)
    got = {r["KUNNR"]: r["NAME1"] for r in rows(spark, tmp_path).collect()}
    assert got == {str(n): ("a\nb" if n % 2 else "a") + f" {n}" for n in range(len(columns))}
    from cashline.session import work_folder
    from cashline.storage import folders_in

    assert folders_in(spark, work_folder(spark, str(tmp_path / "raw"))) == []


def test_missing_and_empty_folders(spark, folder, tmp_path):
    with pytest.raises(LoadError, match="nope"):
        raw.load_extracts(spark, str(tmp_path / "nope"), str(tmp_path / "raw"))
    assert load(spark, folder, tmp_path) == raw.LoadResult(0, 0, 0)
    assert rows(spark, tmp_path).count() == 0


def test_only_extract_files_of_the_table_folders_count(spark, folder, tmp_path):
    fill(folder, ["20260101"])
    (folder.root / "KNA1" / "notes.csv").write_text("x\n")
    (folder.root / "KNA1" / "old").mkdir()
    (folder.root / "KNA1" / "old" / "KNA1_20250101.csv").write_text("x\n")
    (folder.root / "OTHER").mkdir()
    (folder.root / "OTHER" / "OTHER_20260101.csv").write_text("x\n")
    assert load(spark, folder, tmp_path).files_loaded == 3


def test_load_that_died_before_the_log_is_repeated_without_duplicates(spark, folder, tmp_path, monkeypatch):
    fill(folder, ["20260101"])

    def die(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(raw, "_verify", die)
    with pytest.raises(RuntimeError):
        load(spark, folder, tmp_path)
    assert rows(spark, tmp_path).count() == 0  # written, but not in the log
    monkeypatch.undo()
    assert load(spark, folder, tmp_path) == raw.LoadResult(3, 0, 3)
    assert rows(spark, tmp_path).count() == 2


def test_no_log_entry_when_rows_are_missing(spark, folder, tmp_path, monkeypatch):
    fill(folder, ["20260101"])
    whole = raw.scan
    monkeypatch.setattr(raw, "scan", lambda *args: whole(*args).limit(1))
    with pytest.raises(LoadError, match="has 1 of 2 rows"):
        load(spark, folder, tmp_path)
    assert log(spark, tmp_path).count() == 0


def test_stream_loads_new_files_only(spark, folder, tmp_path):
    fill(folder, ["20260101"])

    def run():
        query = stream_extracts(spark, str(folder), str(tmp_path / "raw"))
        query.awaitTermination()
        return rows(spark, tmp_path).count(), log(spark, tmp_path).count()

    assert run() == (2, 3)
    assert run() == (2, 3)
    fill(folder, ["20260102"])
    assert run() == (4, 6)
    assert load(spark, folder, tmp_path) == raw.LoadResult(0, 6, 0)


def test_stream_batches_check_their_own_files_only(spark, folder, tmp_path, monkeypatch):
    opened = []
    check = raw.inspect_files
    monkeypatch.setattr(raw, "inspect_files", lambda s, listing, *more: opened.append({n for _, n, _ in listing}) or check(s, listing, *more))
    monkeypatch.setattr(raw, "discover", None)  # nobody lists the folder
    for day in ("20260101", "20260102"):
        folder.rows("KNA1", day, customer(1))
        stream_extracts(spark, str(folder), str(tmp_path / "raw")).awaitTermination()
    assert opened == [{"KNA1_20260101.csv"}, {"KNA1_20260102.csv"}]
    # A stream that has lost its checkpoint sees all files again and loads none.
    stream_extracts(spark, str(folder), str(tmp_path / "raw"), checkpoint_dir=str(tmp_path / "new")).awaitTermination()
    assert opened[2:] == [set()] and log(spark, tmp_path).count() == 2


def test_stream_finds_empty_files(spark, folder, tmp_path):
    fill(folder, ["20260101"])
    (folder.root / "KNA1" / "KNA1_20260102.csv").write_text("")
    with pytest.raises(Exception, match="KNA1_20260102.csv"):
        stream_extracts(spark, str(folder), str(tmp_path / "raw")).awaitTermination()
    assert log(spark, tmp_path).count() == 3


def test_two_loads_at_once_load_each_file_once(spark, folder, tmp_path):
    fill(folder, [f"202601{day:02d}" for day in range(1, 6)])
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda _: load(spark, folder, tmp_path), range(2)))
    names = [r.file_name for r in log(spark, tmp_path).collect()]
    assert len(names) == len(set(names)) == sum(d.files_loaded for d in done) == 15
    assert sum(d.rows_loaded for d in done) == 15 and rows(spark, tmp_path).count() == 10
    assert load(spark, folder, tmp_path) == raw.LoadResult(0, 15, 0)


def test_claimed_files_are_left_until_the_claim_expires(spark, folder, tmp_path):
    folder.rows("KNA1", "20260101", customer(1))
    folder.rows("KNA1", "20260102", customer(2))
    other = Claims(spark, str(tmp_path / "raw"))
    assert other.take(["KNA1_20260101.csv"]) == {"KNA1_20260101.csv"}
    assert other.take(["KNA1_20260101.csv"]) == set()
    done = load(spark, folder, tmp_path)
    assert done == raw.LoadResult(1, 0, 1, 1) and str(done).endswith("left 1 to other loads")
    # The other load has died; after a while its file is anybody's.
    assert raw.load_extracts(spark, str(folder), str(tmp_path / "raw"), claim_expires=0) == raw.LoadResult(1, 1, 1)
    assert load(spark, folder, tmp_path) == raw.LoadResult(0, 2, 0)


def test_a_load_that_was_overtaken_logs_nothing(spark, folder, tmp_path, monkeypatch):
    fill(folder, ["20260101"])
    write = raw.scan

    def slow(*args):
        Claims(spark, str(tmp_path / "raw"), expires=-1).take(["KNA1_20260101.csv"])
        return write(*args)

    monkeypatch.setattr(raw, "scan", slow)
    with pytest.raises(LoadError, match="have claimed KNA1_20260101.csv"):
        load(spark, folder, tmp_path)
    assert log(spark, tmp_path).count() == 0


def test_of_many_that_create_a_file_one_does(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda _: create_new(spark, str(tmp_path / "claims" / "x")), range(16)))
    assert sum(made) == 1

import pytest

from obsmatch.plans import silver
from obsmatch.schemas import ContractBroken, RawContract
from obsmatch.sources import catalog as C
from obsmatch.sources.delimited import read_delimited, write_delimited


def test_contract_names_missing_and_case(spark):
    df = spark.createDataFrame([("1", "x")], "num_acc string, jour string")
    with pytest.raises(ContractBroken, match="BAAC lacks 2 of its 3 contract columns: Num_Acc, mois") as broken:
        RawContract("BAAC", ("Num_Acc", "jour", "mois")).enforce(df)
    assert broken.value.absent == ("Num_Acc", "mois")


def test_files_with_different_column_order(spark, tmp_root):
    a = spark.createDataFrame([("1", "x")], "k string, v string")
    b = spark.createDataFrame([("y", "2")], "v string, k string")
    write_delimited(a, f"{tmp_root}/a")
    write_delimited(b, f"{tmp_root}/b", compression="gzip")
    got = sorted(tuple(r) for r in read_delimited(spark, tmp_root).select("k", "v").collect())
    assert got == [("1", "x"), ("2", "y")]


def test_partition_values_stay_strings(spark, tmp_root):
    df = spark.createDataFrame([("01", "a")], "department string, v string")
    write_delimited(df, tmp_root, partition_cols=["department"])
    r = read_delimited(spark, tmp_root, base_path=tmp_root).first()
    assert r["department"] == "01"


def test_catalog_picks_zero_one_two(spark):
    cat = spark.createDataFrame(
        [(1, "Caracteristiques-2020", "csv", "u1"), (2, "caract_2021", "csv", "u2"), (3, "carcteristiques 2021", "csv", "u3"),
         (4, "vehicules-immatricules-2020", "csv", "u4"), (5, "vehicules-2020", "csv", "u5"),
         (6, "HOR_departement_01_periode_2020-2023", "csv", "u6"), (7, "hor_departement_01_periode_2022-2029", "csv", "u7")],
        "id long, title string, format string, url string",
    )
    acc = C.pick_accident_resources(cat, C.accident_requests(spark, [2020, 2021, 2022], ["caract", "vehicules"]))
    got = {(r["year"], r["resource_type"]): (r["candidates"], r["resource_id"]) for r in acc.collect()}
    assert got[(2020, "caract")] == (1, 1) and got[(2021, "caract")] == (1, 2)
    assert got[(2020, "vehicules")] == (1, 5) and got[(2022, "caract")] == (0, None)
    wea = C.pick_weather_resources(cat, C.weather_requests(spark, [2021, 2022, 2030], ["1"]))
    got = {r["year"]: (r["candidates"], r["resource_id"]) for r in wea.collect()}
    assert got == {2021: (1, 6), 2022: (2, None), 2030: (0, None)}
    with pytest.raises(Exception, match="no or several"):
        C.require_single(wea).collect()


def test_silver_weather_department_from_partition(spark):
    raw = spark.createDataFrame([("1", "S", "45.0", "1.0", "2024010100", "1.5", "", None, "10", "07")],
                                "NUM_POSTE string, NOM_USUEL string, LAT string, LON string, AAAAMMJJHH string, "
                                "T string, RR1 string, FF string, DD string, department string")
    r = silver.weather(raw, [2024]).first()
    assert (r["department"], r["temperature"], r["rainfall_1h"]) == ("07", 1.5, None)


def test_accident_pick_years_of_any_width(spark):
    cat = spark.createDataFrame([(1, "usagers-999", "csv", "u"), (2, "usagers-12020", "csv", "v")], "id long, title string, format string, url string")
    got = {r["year"]: r["candidates"] for r in C.pick_accident_resources(cat, C.accident_requests(spark, [999, 2020, 12020], ["usagers"])).collect()}
    assert got == {999: 1, 2020: 1, 12020: 1}


def test_one_object_guard_and_namespaces(spark, tmp_root):
    from obsmatch.sources import layout
    from obsmatch.sources.sinks import ensure_namespaces

    df = spark.createDataFrame([("01", "a"), ("02", "b")], "department string, v string")
    write_delimited(df, tmp_root, partition_cols=["department"])
    files = layout.landed_files(spark, tmp_root)
    expected = spark.createDataFrame([("01",), ("03",)], "department string")
    counts = {r["department"]: r["files"] for r in layout.file_counts(files, ["department"], expected=expected).collect()}
    assert counts == {"01": 1, "03": 0}
    with pytest.raises(Exception, match="exactly one object"):
        layout.file_counts(files, ["department"], strict=True, expected=expected).collect()
    assert layout.file_counts(files, ["department"], strict=True).count() == 2
    ensure_namespaces(spark, ["obsmatch_silver", "obsmatch_gold"])
    assert spark.catalog.databaseExists("obsmatch_silver") and spark.catalog.databaseExists("obsmatch_gold")


def test_picks_have_no_width_or_first_match_cap(spark):
    cat = spark.createDataFrame(
        [(1, "usagers-1234567890", "csv", "u"),
         (2, "HOR_departement_01_periode_2020-2022 et HOR_departement_02_periode_2019-2021", "csv", "v"),
         (3, "HOR_departement_03_periode_2000-2001, HOR_departement_03_periode_2020-2021", "csv", "w")],
        "id long, title string, format string, url string",
    )
    reqs = spark.createDataFrame([(1234567890, "usagers")], "year int, resource_type string")
    assert C.pick_accident_resources(cat, reqs).first()["resource_id"] == 1
    wea = C.pick_weather_resources(cat, C.weather_requests(spark, [2021], ["1", "2", "3"]))
    assert {r["department"]: r["resource_id"] for r in wea.collect()} == {"01": 2, "02": 2, "03": None}


def _landed(root, files):
    import gzip
    import os

    for name, body in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with (gzip.open if name.endswith(".gz") else open)(path, "wb") as f:
            f.write(body)


def test_headers_are_read_in_tasks(spark, tmp_path, monkeypatch):
    from obsmatch.sources import delimited, layout

    def refuse(*_):
        raise AssertionError("the driver opened a file")

    monkeypatch.setattr(delimited, "_hadoop_header", refuse)
    _landed(tmp_path, {
        "a/one.csv": b"k;v\n1;x\n",
        "a/mark.csv": b"\xef\xbb\xbfk;v\r\n2;y\r\n",  # byte order mark, CRLF
        "b c/deep/late.csv": b"\n  \nv;k\nz;3\n",  # blank lines before another order; a space in a folder
        "b c/packed.csv.gz": b"v;k;w\nu;4;5\n",
        "b c/empty.csv": b"",
        "b c/blank.csv": b"\n\n",
    })
    files, gzip_files = delimited.file_headers(spark, str(tmp_path))
    got = {r["path"].rsplit("/", 1)[1]: r["header"] for r in files.collect()}
    assert got == {"one.csv": "k;v", "mark.csv": "k;v", "late.csv": "v;k", "packed.csv.gz": "v;k;w", "blank.csv": None}
    assert gzip_files == 1
    rows = sorted(tuple(r) for r in read_delimited(spark, str(tmp_path)).select("k", "v", "w").collect())
    assert rows == [("1", "x", None), ("2", "y", None), ("3", "z", None), ("4", "u", "5")]


def test_one_header_is_read_without_a_list_of_files(spark, tmp_path):
    _landed(tmp_path, {f"p/{n}/f.csv": b"k;v\n%d;x\n" % n for n in range(5)} | {"p/none.csv": b""})
    df = read_delimited(spark, str(tmp_path), with_file=True)
    assert sorted(r["k"] for r in df.collect()) == ["0", "1", "2", "3", "4"]
    assert df.select("source_file").distinct().count() == 5
    with pytest.raises(FileNotFoundError):
        (tmp_path / "nothing").mkdir()
        read_delimited(spark, str(tmp_path / "nothing"))


def test_blank_files_have_no_columns(spark, tmp_path):
    _landed(tmp_path, {"a.csv": b"", "b.csv": b"\n"})
    df = read_delimited(spark, str(tmp_path))
    assert df.columns == [] and df.count() == 0
    _landed(tmp_path, {"empty/a.csv": b""})
    with pytest.raises(FileNotFoundError):
        read_delimited(spark, str(tmp_path / "empty"))


def test_files_that_only_hadoop_opens(spark, tmp_root):
    write_delimited(spark.createDataFrame([("1", "x")], "k string, v string"), f"{tmp_root}/a", compression="deflate")
    write_delimited(spark.createDataFrame([("y", "2")], "v string, k string"), f"{tmp_root}/b", compression="bzip2")
    assert sorted(tuple(r) for r in read_delimited(spark, tmp_root).select("k", "v").collect()) == [("1", "x"), ("2", "y")]


def test_many_small_folders_are_written_by_several_tasks(spark, tmp_root, monkeypatch):
    from obsmatch.sources import delimited, layout

    monkeypatch.setattr(delimited, "FOLDERS_PER_TASK", 10, raising=False)
    rows = [(f"{i % 7:02d}", f"r{i}", str(i)) for i in range(60)]
    write_delimited(spark.createDataFrame(rows, "department string, resource string, body string"), tmp_root, partition_cols=["department", "resource"])
    files = layout.landed_files(spark, tmp_root).collect()
    assert sorted((f["department"], f["resource"]) for f in files) == sorted((d, r) for d, r, _ in rows)
    tasks = [f["file_name"].split("-")[1] for f in files]
    assert len(set(tasks)) > 4 and max(tasks.count(t) for t in tasks) < 30


def test_driver_holds_neither_all_folders_nor_all_files(spark, tmp_root, monkeypatch):
    """Folders land in several jobs and are listed in tasks: the same files, values and columns as Spark's index finds."""
    from obsmatch.sources import delimited, layout

    monkeypatch.setattr(delimited, "FOLDERS_PER_JOB", 15, raising=False)
    odd = ["a b", "x/y", "100%", "k=v", "é:ü", "%41", "q?#", None]
    rows = [(f"{i % 7:02d}", f"r{i}", str(i)) for i in range(60)] + [(d, r, "odd") for d in ("01", None) for r in odd]
    df = spark.createDataFrame(rows, "department string, resource string, body string")
    write_delimited(df, tmp_root, partition_cols=["department", "resource"])
    files = layout.landed_files(spark, tmp_root)
    assert not [f for f in files.inputFiles() if "resource=" in f]
    found = files.collect()
    assert sorted((str(f["department"]), str(f["resource"])) for f in found) == sorted((str(d), str(r)) for d, r, _ in rows)
    assert len({f["file_name"].split("-", 2)[2] for f in found}) > 1
    index = spark.read.format("binaryFile").option("basePath", tmp_root).load(tmp_root)
    assert sorted(map(repr, files.select("path", "size_bytes", "department", "resource").collect())) == sorted(
        map(repr, index.selectExpr("path", "length as size_bytes", "department", "resource").collect())
    )
    write_delimited(df.limit(1), tmp_root, partition_cols=["department", "resource"])
    assert layout.landed_files(spark, tmp_root).count() == 1


def test_files_left_out_of_the_list(spark, tmp_path):
    from obsmatch.sources import layout

    _landed(tmp_path, {"k=1/a.csv": b"x", "k=1/empty.csv": b"", "k=1/.hidden": b"x", "k=1/_tmp": b"x", "k=2/sub/b.csv": b"xy", "_SUCCESS": b"x", "_old/c.csv": b"x", "top.csv": b"x"})
    got = layout.landed_files(spark, str(tmp_path)).collect()
    assert sorted((f["k"], f["file_name"], f["size_bytes"]) for f in got) == [("1", "a.csv", 1), ("2", "b.csv", 2)]
    _landed(tmp_path, {"none/_SUCCESS": b"", "l=1/a.csv": b"x"})
    assert layout.landed_files(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(Exception, match="partition columns"):
        layout.landed_files(spark, str(tmp_path))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        layout.landed_files(spark, f"{tmp_path}/missing")

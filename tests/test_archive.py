"""Reading real zip files, whole and in ranges."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from checks import jobs
from checks.compare import TESTDATA
from rostrum.session import SETTINGS, configure
from rostrum.sources.archive import folder_key, json_documents, read_archives


@pytest.fixture
def archives(tmp_path):
    expected = set()
    for name, method in (("a b.zip", zipfile.ZIP_DEFLATED), ("c.zip", zipfile.ZIP_STORED)):
        with zipfile.ZipFile(tmp_path / name, "w", method) as archive:
            archive.mkdir("json")
            archive.mkdir("json/acteur")
            for i in range(40):
                entry = f"json/{'acteur' if i % 2 else 'organe'}/é{i}.{'json' if i % 5 else 'txt'}"
                body = f"{name} {i} " + "déjà vu\n" * (i * 50)
                archive.writestr(entry, body)
                expected.add((name, entry, body))
            archive.writestr("empty.json", "")
            expected.add((name, "empty.json", ""))
    return tmp_path, expected


def found(documents):
    name = F.regexp_extract("archive", r"([^/]+)\z", 1)
    rows = documents.select(name, "entry", "body").collect()
    assert len(rows) == len(set(rows))
    return {tuple(row) for row in rows}


def test_whole_archives(spark, archives):
    folder, expected = archives
    assert found(read_archives(spark, str(folder))) == expected


@pytest.mark.parametrize("range_bytes", [500, 3000, 1 << 30])
def test_archives_in_ranges(spark, archives, range_bytes):
    folder, expected = archives
    documents = read_archives(spark, str(folder), whole_up_to=0, range_bytes=range_bytes)
    assert found(documents) == expected
    if range_bytes == 3000:
        tasks = documents.select(F.spark_partition_id()).distinct().count()
        assert tasks > 5


def test_some_whole_some_in_ranges(spark, archives):
    folder, expected = archives
    sizes = sorted(path.stat().st_size for path in folder.iterdir())
    documents = read_archives(spark, str(folder), whole_up_to=sizes[0], range_bytes=2000)
    assert found(documents) == expected


def test_a_damaged_member_fails(spark, tmp_path):
    path = tmp_path / "d.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("json/a.json", "0123456789")
    path.write_bytes(path.read_bytes().replace(b"0123456789", b"0123456780"))
    with pytest.raises(Exception, match="Bad CRC-32"):
        read_archives(spark, str(path), whole_up_to=0).collect()
    with pytest.raises(Exception, match="Bad CRC-32"):
        read_archives(spark, str(path)).collect()


def test_prefix_and_suffix(spark, archives):
    folder, expected = archives
    kept = json_documents(read_archives(spark, str(folder)), "json/acteur/")
    assert found(kept) == {
        row for row in expected if row[1].startswith("json/acteur/") and row[1].endswith(".json")
    }


@pytest.mark.parametrize("whole_up_to", [0, 1 << 30])
@pytest.mark.parametrize(
    "method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA]
)
def test_every_method_and_only_wanted_entries(spark, tmp_path, method, whole_up_to):
    with zipfile.ZipFile(tmp_path / "m.zip", "w", method) as archive:
        for i in range(9):
            archive.writestr(f"json/acteur/é{i}.json", f"body {i} " * 300)
            archive.writestr(f"json/acteur/{i}.png", b"\x89PNG\xff\xfe")  # not text
    documents = read_archives(
        spark,
        str(tmp_path),
        names=[("json/acteur/", ".json")],
        whole_up_to=whole_up_to,
        range_bytes=900,
    )
    assert found(documents) == {("m.zip", f"json/acteur/é{i}.json", f"body {i} " * 300) for i in range(9)}


def test_one_archive_is_spread_after_unpacking(spark, archives):
    folder, expected = archives
    documents = read_archives(spark, str(folder), range_bytes=500)
    assert found(documents) == expected
    assert documents.select(F.spark_partition_id()).distinct().count() > 3


def test_folder_key(spark):
    paths = {
        "json/DL1/AM1.json": "DL1",
        "json/DL1/TEXTE/AM1.json": "DL1",
        "DL2/AM1.json": "DL2",
        "/DL3/x/AM1.json": "DL3",
        "json/AM1.json": "AM1.json",
        "AM1.json": "inconnu",
        "json": "inconnu",
    }
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select(
        "p", folder_key(F.col("p")).alias("k")
    )
    assert {r.p: r.k for r in rows.collect()} == paths


def test_archive_queries_bound_what_a_python_task_holds(spark):
    """Before, a batch held 10,000 documents or all archives of a task, whatever their length."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    try:
        jobs.QUERIES["read_archive_all"](spark, f"{TESTDATA}/sf0.001")
        assert spark.conf.get(name) == SETTINGS[name]
    finally:
        configure(spark)

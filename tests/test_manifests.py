import hashlib
import json

import pytest
from pyspark.sql import functions as F

from fixture_tables import ROWS, write_tables
from parcelflow.schemas import DATASET_FILES
from parcelflow.plans.ingest import validated_ingestion
from parcelflow.sources import manifests as m
from parcelflow.sources.lake import Lake
from parcelflow.sources.raw_csv import raw_path, read_raw


def write_raw(folder):
    write_tables(folder, extra={"orders": [",".join(["x"] * 8)]})
    return folder


@pytest.fixture
def raw(tmp_path):
    return write_raw(tmp_path / "raw")


@pytest.fixture(scope="module")
def manifest(spark, tmp_path_factory):
    """The manifest of files like those of ``raw``."""
    built = build(spark, write_raw(tmp_path_factory.mktemp("raw")))
    return spark.createDataFrame(built.collect(), built.schema)


def listing(spark, raw, wrong=None, skip=None):
    rows = [
        (f.name, "2021-10-01", f.stat().st_size + (1 if f.name == wrong else 0))
        for f in raw.iterdir()
        if f.name != skip
    ]
    return spark.createDataFrame(rows, "name string, creationDate string, totalBytes bigint")


def build(spark, raw, **changes):
    return m.build_manifest(
        spark, str(raw), "owner/dataset", 2, "2026-01-01", listing(spark, raw, **changes)
    )


def test_build(raw, manifest):
    rows = {r["file_id"]: r for r in manifest.collect()}
    assert set(rows) == set(DATASET_FILES)
    row = rows["orders"]
    content = (raw / DATASET_FILES["orders"]).read_bytes()
    assert row["sha256"] == hashlib.sha256(content).hexdigest()
    assert row["size_byte"] == len(content)
    assert (row["row_count"], row["column_count"], len(row["column_names"])) == (2, 8, 8)
    assert (row["dataset"], row["dataset_version"]) == ("owner/dataset", 2)
    assert row["dataset_created"] == "2021-10-01"


def test_hashes_of_files_with_awkward_names(spark, tmp_path):
    content = {"a b.bin": b"x" * 3_000_000, "50%25.bin": b"z", "c#d.bin": b"y"}
    (tmp_path / "empty.bin").touch()
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    found = sorted(r["sha256"] for r in m.file_hashes(spark, str(tmp_path)).collect())
    assert found == sorted(hashlib.sha256(data).hexdigest() for data in content.values())


def test_listing_must_agree(spark, raw):
    with pytest.raises(m.ManifestError, match="the listing says"):
        build(spark, raw, wrong=DATASET_FILES["orders"])
    with pytest.raises(m.ManifestError, match="None"):
        build(spark, raw, skip=DATASET_FILES["sellers"])


def test_missing_file(spark, raw):
    sizes = listing(spark, raw)
    (raw / DATASET_FILES["orders"]).rename(raw.parent / "elsewhere")
    with pytest.raises(FileNotFoundError, match=DATASET_FILES["orders"]):
        m.build_manifest(spark, str(raw), "o/d", 2, "now", sizes)


def test_benchmark_is_kept_and_temporary_replaced(spark, manifest, tmp_path):
    folder = str(tmp_path / "manifests")
    table = manifest
    assert m.load_manifest(spark, folder) is None
    assert m.save_manifest(table, folder) == m.BENCHMARK
    for version in (3, 4):
        changed = table.withColumn("dataset_version", F.lit(version))
        assert m.save_manifest(changed, folder) == m.TEMPORARY

    def stored(name):
        return {r[0] for r in m.load_manifest(spark, folder, name).select("dataset_version").collect()}

    assert stored(m.BENCHMARK) == {2} and stored(m.TEMPORARY) == {4}


def test_valid_files_pass(spark, raw, manifest):
    assert m.validate_files(spark, str(raw), manifest) is None
    assert m.validate_files(spark, str(raw), manifest, raise_on_first=False).count() == 0


@pytest.mark.parametrize(
    "column, value",
    [
        ("file_name", "wrong.csv"),
        ("size_byte", 1),
        ("row_count", 99),
        ("column_count", 99),
        ("sha256", "0" * 64),
    ],
)
def test_wrong_metrics(spark, raw, manifest, column, value):
    changed = manifest.withColumn(
        column, F.when(F.col("file_id") == "orders", F.lit(value)).otherwise(F.col(column))
    )
    with pytest.raises(m.ManifestError, match=f"{column} of orders"):
        m.validate_files(spark, str(raw), changed)


def test_all_violations_at_once(spark, raw, manifest):
    is_orders = F.col("file_id") == "orders"
    changed = manifest.withColumns(
        {
            "row_count": F.when(is_orders, 99).otherwise(F.col("row_count")),
            "sha256": F.when(is_orders, "0").otherwise(F.col("sha256")),
        }
    )
    rows = m.validate_files(spark, str(raw), changed, raise_on_first=False)
    found = [(r["file_id"], r["check_name"]) for r in rows.orderBy("check_order").collect()]
    assert found == [("orders", "row_count"), ("orders", "sha256")]


def test_folder_rules(spark, raw, manifest, tmp_path):
    with pytest.raises(FileNotFoundError, match="does not exist"):
        m.validate_files(spark, str(tmp_path / "none"), manifest)
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError, match="does not contain"):
        m.validate_files(spark, str(tmp_path / "empty"), manifest)
    with pytest.raises(FileNotFoundError, match="benchmark"):
        m.validate_files(spark, str(raw), None)
    (raw / "more.csv").write_text("a\n")
    with pytest.raises(FileNotFoundError, match="Found 10 files"):
        m.validate_files(spark, str(raw), manifest)
    (raw / DATASET_FILES["orders"]).rename(raw.parent / "elsewhere")
    with pytest.raises(FileNotFoundError, match=DATASET_FILES["orders"]):
        m.validate_files(spark, str(raw), manifest)


def test_validated_ingestion(spark, tmp_path):
    folder = write_tables(tmp_path / "raw")
    manifest = build(spark, tmp_path / "raw")
    root = str(tmp_path / "lake")
    run_id = validated_ingestion(spark, folder, root, manifest, manifest)
    assert Lake(spark, root).current_run() == run_id
    newer = manifest.withColumn("dataset_version", F.lit(3))
    with pytest.raises(m.ManifestError, match="dataset_version"):
        validated_ingestion(spark, folder, root, manifest, newer)
    assert Lake(spark, root).current_run() == run_id


FILE = {
    "file_name": "orders.csv",
    "dataset": "owner/dataset",
    "dataset_version": 2,
    "file_path": "data/raw/orders.csv",
    "sha256": "abc",
    "size_byte": 10,
    "download_date": "2026-01-01",
    "dataset_created": "2021-10-01",
    "column_count": 2,
    "row_count": 2,
    "column_names": ["order_id", "customer_id"],
}


def entries(spark, tmp_path, name, changes=None, drop=None, more=None):
    file = {**FILE, **(changes or {})}
    if drop:
        file.pop(drop)
    content = {
        "dataset_metadata": {"dataset_name": "owner/dataset", "dataset_version": 2},
        "orders": file,
        **(more or {}),
    }
    path = tmp_path / name
    path.write_text(json.dumps(content, indent=2))
    return m.read_manifest(spark, str(path))


def test_json_manifest_gives_typed_rows_and_back(spark, tmp_path):
    read = entries(spark, tmp_path, "a.json")
    row = m.manifest_table(read).first().asDict()
    assert row == {"file_id": "orders", **FILE}
    again = m.manifest_entries(m.manifest_table(read))
    assert m.manifest_differences(read, again).count() == 0


def test_cut_manifest_fails(spark, tmp_path):
    path = tmp_path / "cut.json"
    path.write_text(json.dumps({"orders": FILE})[:-20])
    with pytest.raises(Exception, match="MALFORMED"):
        m.read_manifest(spark, str(path)).collect()


def test_line_breaks_in_quotes_of_any_table(spark, tmp_path):
    """One record each, for the reader and for the counted rows."""
    broken = {}
    for name, values in ROWS.items():
        broken[name] = [",".join([*values[:-1], f'"{values[-1]}\n{",".join(values)}"'])]
    folder = write_tables(tmp_path / "raw", extra=broken)
    counted = {r["file_name"]: r["row_count"] for r in m.csv_shapes(spark, folder).collect()}
    assert counted == {file: 2 for file in DATASET_FILES.values()}
    for name, values in ROWS.items():
        rows = read_raw(spark, raw_path(folder, name), name).collect()
        assert sorted(r[-1] for r in rows) == sorted(
            [values[-1], f'{values[-1]}\n{",".join(values)}']
        )


def test_absent_manifest_is_none(spark, tmp_path):
    assert m.read_manifest(spark, str(tmp_path / "no.json")) is None
    assert m.compare_manifests(None, entries(spark, tmp_path, "a.json")) is False


def test_equal_manifests_may_differ_in_date_and_path(spark, tmp_path):
    left = entries(spark, tmp_path, "a.json")
    right = entries(
        spark, tmp_path, "b.json", {"download_date": "2027-02-02", "file_path": "elsewhere"}
    )
    assert m.compare_manifests(left, right) is True


@pytest.mark.parametrize(
    "change",
    [
        {"file_name": "x.csv"},
        {"dataset": "other/dataset"},
        {"dataset_version": 3},
        {"sha256": "abd"},
        {"size_byte": 11},
        {"dataset_created": "2021-10-02"},
        {"column_count": 3},
        {"row_count": 3},
        {"column_names": ["order_id"]},
        {"column_names": ["customer_id", "order_id"]},
        {"row_count": None},
        {"row_count": "2"},
    ],
)
def test_different_values(spark, tmp_path, change):
    left = entries(spark, tmp_path, "a.json")
    right = entries(spark, tmp_path, "b.json", change)
    with pytest.raises(m.ManifestError, match=next(iter(change))):
        m.compare_manifests(left, right)


def test_different_keys(spark, tmp_path):
    left = entries(spark, tmp_path, "a.json")
    for right in (
        entries(spark, tmp_path, "b.json", drop="file_path"),
        entries(spark, tmp_path, "c.json", more={"sellers": FILE}),
    ):
        with pytest.raises(m.ManifestError):
            m.compare_manifests(left, right)


def test_fingerprint_ignores_order_but_not_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "i int, t string")
    same = spark.createDataFrame([(2, "y"), (1, "x"), (2, "y")], "i int, t string")
    fewer = spark.createDataFrame([(1, "x"), (2, "y")], "i int, t string")
    first = m.table_fingerprint(a).first()
    assert first == m.table_fingerprint(same).first()
    assert first != m.table_fingerprint(fewer).first()
    assert m.table_fingerprint(a.limit(0)).first()["row_count"] == 0


def test_fingerprint_sees_where_nulls_are(spark):
    left = spark.createDataFrame([(1, None)], "a int, b int")
    right = spark.createDataFrame([(None, 1)], "a int, b int")
    from parcelflow.sources.manifests import table_fingerprint

    assert table_fingerprint(left).first() != table_fingerprint(right).first()

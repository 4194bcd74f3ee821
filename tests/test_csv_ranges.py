"""Files cut into ranges against files read whole."""

import random

import pytest

from parcelflow import catalog
from parcelflow.adapters import TABLE_SCHEMAS
from parcelflow.schemas import STAGING
from parcelflow.session import checkpoint_folder
from parcelflow.sources import raw_csv
from parcelflow.sources.csv_ranges import read_raw_ranges
from parcelflow.sources.raw_csv import read_raw, write_raw

TABLE = "order_reviews"


@pytest.fixture
def ranges_of(spark):
    """Set the size of a range for a test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def set_size(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield set_size
    for name in names:
        spark.conf.unset(name)


def values(chance):
    return chance.choice([
        "plain", "", 'say "hi"', "two\nlines", "\n\n", '"\n"', "a,b", " spaced ", "é漢😀", "x" * 300,
        '""', "cr\r\nlf", "line\n" * 20, ",", '"', None,
    ])


def written(tmp_path, seed, n, ending="\n"):
    """A CSV file with every value quoted or not, as another program would write it."""
    chance = random.Random(seed)
    columns = [f.name for f in STAGING[TABLE].raw_schema.fields]
    lines = [",".join(columns)]
    for i in range(n):
        cells = [f"id{i}"]
        for _ in columns[1:]:
            v = values(chance)
            if v is None:
                cells.append("")
            elif chance.random() < 0.3 and not set(v) & set('",\n\r '):
                cells.append(v)
            else:
                cells.append('"' + v.replace('"', '""') + '"')
        lines.append(",".join(cells))
    path = tmp_path / f"f{seed}.csv"
    path.write_bytes((ending.join(lines) + ending * (seed % 2)).encode())
    return str(path)


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [120, 1 << 27])
@pytest.mark.parametrize("seed, ending", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_equals_the_whole_file(spark, tmp_path, ranges_of, size, seed, ending):
    path = written(tmp_path, seed, 60, ending)
    wanted = ordered(read_raw(spark, path, TABLE))
    ranges_of(size)
    found = read_raw_ranges(spark, path, TABLE)
    assert found.schema == read_raw(spark, path, TABLE).schema
    if ending == "\r\n":
        # There the whole-file reader shortens the line breaks inside quotes as well.
        assert any("cr\r\nlf" in tuple(r) for r in found.collect())
        found = found.replace("cr\r\nlf", "cr\nlf")
    assert ordered(found) == wanted and len(wanted) == 60


def test_several_files_and_what_write_raw_wrote(spark, tmp_path, ranges_of):
    paths = [written(tmp_path, seed, 30) for seed in (4, 5, 6)]
    wanted = ordered(read_raw(spark, paths, TABLE))
    ranges_of(500)
    assert ordered(read_raw_ranges(spark, paths, TABLE)) == wanted
    write_raw(read_raw(spark, paths, TABLE).repartition(3), str(tmp_path / "out"))
    assert ordered(read_raw_ranges(spark, str(tmp_path / "out"), TABLE)) == wanted


def test_a_file_is_read_by_many_tasks(spark, tmp_path, ranges_of):
    columns = [f.name for f in STAGING[TABLE].raw_schema.fields]
    path = tmp_path / "large.csv"
    with open(path, "w") as file:
        file.write(",".join(columns) + "\n")
        for i in range(100_000):
            file.write(f'{i},{i % 7},"some\nlines of ""text"" {i}"' + ",x" * (len(columns) - 3) + "\n")
    ranges_of(500_000)
    found = read_raw_ranges(spark, str(path), TABLE)
    assert spark.read.text(str(path)).rdd.getNumPartitions() >= 8
    assert found.count() == 100_000 and found.exceptAll(read_raw(spark, str(path), TABLE)).isEmpty()


@pytest.mark.parametrize("body", ['a,"b\nc,d\n', "a,b,c,d,e,f,g,h\n"])
def test_bad_files_fail(spark, tmp_path, body):
    columns = [f.name for f in STAGING["sellers"].raw_schema.fields]
    path = tmp_path / "bad.csv"
    path.write_text(",".join(columns) + "\n" + body)
    with pytest.raises(Exception, match="quote|MALFORMED|column"):
        read_raw_ranges(spark, str(path), "sellers").collect()
    path.write_text("wrong,names\n1,2\n")
    with pytest.raises(Exception, match="expected"):
        read_raw_ranges(spark, str(path), "sellers").collect()


def test_header_alone_and_empty_file(spark, tmp_path):
    columns = [f.name for f in STAGING["sellers"].raw_schema.fields]
    (tmp_path / "a.csv").write_text(",".join(columns))
    (tmp_path / "b.csv").write_text("")
    assert read_raw_ranges(spark, str(tmp_path), "sellers").collect() == []


def test_the_query_writes_files_of_bounded_size(spark, tmp_path, ranges_of, monkeypatch):
    chance = random.Random(7)
    docs = [(i, (values(chance) or "") + "\n" * 50, "en", "s", 1) for i in range(300)]
    labels = [(i, 1, 0) for i in range(0, 300, 2)]
    for name, rows in (("documents", docs), ("labels", labels)):
        spark.createDataFrame(rows, TABLE_SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(raw_csv, "FILE_BYTES", 4000)
    ranges_of(1000)
    paths = []
    read = catalog.read_raw_ranges
    monkeypatch.setattr(catalog, "read_raw_ranges", lambda s, path, t: paths.append(path) or read(s, path, t))
    found = catalog.csv_ranges(spark, str(tmp_path))
    assert ordered(found) == ordered(catalog.csv_round_trip(spark, str(tmp_path)))
    files = spark.read.text(paths[0]).select("_metadata.file_path", "_metadata.file_size").distinct().collect()
    assert len(files) >= 5 and max(f.file_size for f in files) < 8000
    assert paths[0].startswith(checkpoint_folder(spark)) and found.count() == 150

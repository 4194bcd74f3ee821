"""Dataset manifests: build, store, read, compare and check against the files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from functools import reduce
from urllib.parse import quote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.schemas import DATASET_FILES
from parcelflow.sources.raw_csv import raw_path

# The keys of a file entry, and those that two manifests may differ in.
FILE_KEYS = (
    "file_name",
    "dataset",
    "dataset_version",
    "file_path",
    "sha256",
    "size_byte",
    "download_date",
    "dataset_created",
    "column_count",
    "row_count",
    "column_names",
)
IGNORED_KEYS = ("download_date", "file_path")
DATASET_ENTRY = "dataset_metadata"

BENCHMARK, TEMPORARY = "benchmark", "temporary"


class ManifestError(ValueError):
    """Files or manifests disagree."""


# --- reading and writing ---------------------------------------------------------


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows (file_id, key, value) of a JSON object of objects; None when absent.

    Values keep their JSON text with its type, so 5 and "5" differ. A file that is no such
    object, a cut one for instance, fails the read.
    """
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    entries = text.select(
        F.explode(
            F.from_json("value", "map<string,map<string,variant>>", {"mode": "FAILFAST"})
        ).alias("file_id", "file")
    )
    return entries.select("file_id", F.explode("file").alias("key", "value")).select(
        "file_id", "key", F.to_json("value").alias("value")
    )


def _json_text(value: Column) -> Column:
    """One value as JSON text: that of an array of it, without the brackets."""
    listed = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def manifest_table(entries: DataFrame) -> DataFrame:
    """Typed rows, one per file, from (file_id, key, value) entries."""

    def text(key: str):
        return F.max(F.when(F.col("key") == key, F.col("value")))

    def value(key: str):
        return F.variant_get(F.parse_json(text(key)), "$", "string")

    return (
        entries.where(F.col("file_id") != DATASET_ENTRY)
        .groupBy("file_id")
        .agg(
            value("file_name").alias("file_name"),
            value("dataset").alias("dataset"),
            value("dataset_version").cast("int").alias("dataset_version"),
            value("file_path").alias("file_path"),
            value("sha256").alias("sha256"),
            value("size_byte").cast("bigint").alias("size_byte"),
            value("download_date").alias("download_date"),
            value("dataset_created").alias("dataset_created"),
            value("column_count").cast("int").alias("column_count"),
            value("row_count").cast("bigint").alias("row_count"),
            F.from_json(text("column_names"), "array<string>").alias("column_names"),
        )
    )


def manifest_entries(table: DataFrame) -> DataFrame:
    """(file_id, key, value) entries from typed rows, dataset entry included."""
    pairs = [
        F.struct(F.lit(k).alias("key"), _json_text(F.col(k)).alias("value")) for k in FILE_KEYS
    ]
    files = table.select("file_id", F.inline(F.array(*pairs)))
    dataset = table.agg(
        F.max("dataset").alias("dataset_name"),
        F.max("dataset_version").alias("dataset_version"),
    ).select(
        F.lit(DATASET_ENTRY).alias("file_id"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("key"), _json_text(F.col(k)).alias("value"))
                    for k in ("dataset_name", "dataset_version")
                ]
            )
        ),
    )
    return files.unionByName(dataset)


def save_manifest(table: DataFrame, folder: str) -> str:
    """Store as the benchmark the first time; later runs replace the temporary one."""
    spark = table.sparkSession
    name = BENCHMARK if load_manifest(spark, folder, BENCHMARK) is None else TEMPORARY
    mode = "errorifexists" if name == BENCHMARK else "overwrite"
    table.coalesce(1).write.mode(mode).parquet(f"{folder.rstrip('/')}/manifest={name}")
    return name


def load_manifest(spark: SparkSession, folder: str, name: str = BENCHMARK) -> DataFrame | None:
    """Typed rows of a stored manifest; None when it was never saved."""
    try:
        return spark.read.parquet(f"{folder.rstrip('/')}/manifest={name}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


# --- building --------------------------------------------------------------------


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (file_name, path, size_byte) of a folder; the contents are not read."""
    try:
        files = spark.read.format("binaryFile").load(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"The folder '{folder}' does not exist.") from error
        raise
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "path",
        F.col("length").alias("size_byte"),
    )


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (path, sha256). Files are hashed in parallel, each read in pieces of constant
    size. Spark does not list empty files."""

    # Nested, so that tasks get the function itself and need no copy of the package.
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        def opened(path: str):
            scheme, _, rest = path.partition(":")
            if scheme == "file":
                return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"))
            scheme = "s3" if scheme in ("s3a", "s3n") else scheme
            system, inner = fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
            return system.open_input_stream(inner)

        for batch in batches:
            digests = []
            for path in batch["path"]:
                digest = hashlib.sha256()
                with opened(path) as stream:
                    while chunk := stream.read(1024 * 1024):
                        digest.update(chunk)
                digests.append(digest.hexdigest())
            yield pd.DataFrame({"path": batch["path"], "sha256": digests})

    paths = spark.read.format("binaryFile").load(folder).select("path")
    return paths.mapInPandas(hashed, "path string, sha256 string")


def csv_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (file_name, column_count, row_count, column_names) of the expected tables.

    Rows are parsed records, not lines: any table may have line breaks in quotes.
    """
    shapes = []
    for name, file_name in DATASET_FILES.items():
        table = spark.read.csv(
            raw_path(folder, name),
            header=True,
            quote='"',
            escape='"',
            multiLine=True,
        )
        header = table.columns
        counted = table.agg(F.count("*").alias("row_count"))
        shapes.append(
            counted.select(
                F.lit(file_name).alias("file_name"),
                F.lit(len(header)).alias("column_count"),
                "row_count",
                F.array(*[F.lit(c) for c in header]).alias("column_names"),
            )
        )
    return reduce(DataFrame.unionByName, shapes)


def expected_files(spark: SparkSession) -> DataFrame:
    """Rows (file_id, file_name) of the nine-file contract."""
    pairs = [
        F.struct(F.lit(k).alias("file_id"), F.lit(v).alias("file_name"))
        for k, v in DATASET_FILES.items()
    ]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def listing_violations(files: DataFrame, listing: DataFrame) -> DataFrame:
    """Files that the publisher's listing (name, creationDate, totalBytes) lacks or
    gives another size for."""
    listed = listing.select(
        F.col("name").alias("file_name"), F.col("totalBytes").alias("listed_bytes")
    )
    return (
        files.join(listed, "file_name", "left")
        .where(~F.col("listed_bytes").eqNullSafe(F.col("size_byte")))
        .select("file_name", "size_byte", "listed_bytes")
    )


def build_manifest(
    spark: SparkSession,
    folder: str,
    dataset: str,
    version: int,
    download_date: str,
    listing: DataFrame,
) -> DataFrame:
    """One typed manifest row per expected file, after its size agrees with the listing."""
    files = expected_files(spark).join(list_files(spark, folder), "file_name", "left")
    absent = files.where(F.col("path").isNull()).orderBy("file_name").first()
    if absent:
        raise FileNotFoundError(f"File {absent['file_name']} not found.")
    wrong = listing_violations(files, listing).orderBy("file_name").first()
    if wrong:
        raise ManifestError(
            f"{wrong['file_name']} has {wrong['size_byte']} bytes, "
            f"the listing says {wrong['listed_bytes']}."
        )
    created = listing.select(
        F.col("name").alias("file_name"), F.col("creationDate").alias("dataset_created")
    )
    return (
        files.join(created, "file_name")
        .join(file_hashes(spark, folder), "path")
        .join(csv_shapes(spark, folder), "file_name")
        .select(
            "file_id",
            "file_name",
            F.lit(dataset).alias("dataset"),
            F.lit(version).alias("dataset_version"),
            F.col("path").alias("file_path"),
            "sha256",
            "size_byte",
            F.lit(download_date).alias("download_date"),
            "dataset_created",
            "column_count",
            "row_count",
            "column_names",
        )
    )


# --- checking --------------------------------------------------------------------

_CHECKED = ("file_name", "size_byte", "row_count", "column_count", "sha256")


def file_violations(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Rows (file_id, check_order, check_name, expected, found) where the files differ
    from the manifest. ``manifest`` is typed."""
    found = (
        list_files(spark, folder)
        .join(file_hashes(spark, folder), "path")
        .join(csv_shapes(spark, folder), "file_name")
        .join(expected_files(spark), "file_name")
    )
    wanted = manifest.select(
        "file_id", *[F.col(c).cast("string").alias(f"expected_{c}") for c in _CHECKED]
    )
    both = wanted.join(
        found.select("file_id", *[F.col(c).cast("string").alias(c) for c in _CHECKED]),
        "file_id",
        "full_outer",
    )
    checks = [
        F.struct(
            F.lit(i).alias("check_order"),
            F.lit(c).alias("check_name"),
            F.col(f"expected_{c}").alias("expected"),
            F.col(c).alias("found"),
        )
        for i, c in enumerate(_CHECKED)
    ]
    rows = both.select("file_id", F.inline(F.array(*checks)))
    return rows.where(~F.col("expected").eqNullSafe(F.col("found")))


def validate_files(
    spark: SparkSession, folder: str, manifest: DataFrame | None, raise_on_first: bool = True
) -> DataFrame | None:
    """Check folder, file set and every file against the benchmark manifest."""
    files = list_files(spark, folder)
    count = files.count()
    if count == 0:
        raise FileNotFoundError(f"The folder '{folder}' does not contain any files.")
    if count != len(DATASET_FILES):
        raise FileNotFoundError(f"Found {count} files, expected {len(DATASET_FILES)}.")
    missing = expected_files(spark).join(files, "file_name", "left_anti").first()
    if missing:
        raise FileNotFoundError(f"{missing['file_name']} is not a file.")
    if manifest is None:
        raise FileNotFoundError("The benchmark manifest was not found.")
    violations = file_violations(spark, folder, manifest)
    if raise_on_first:
        first = violations.orderBy("check_order", "file_id").first()
        if first:
            raise ManifestError(
                f"{first['check_name']} of {first['file_id']} does not match: "
                f"expected {first['expected']}, found {first['found']}."
            )
        return None
    return violations


def manifest_differences(
    left: DataFrame, right: DataFrame, ignored: tuple[str, ...] = IGNORED_KEYS
) -> DataFrame:
    """Entries that differ or exist on one side only: rows (file_id, key, left_value,
    right_value, left_present, right_present)."""

    def side(entries: DataFrame, name: str) -> DataFrame:
        return entries.select(
            "file_id",
            "key",
            F.col("value").alias(f"{name}_value"),
            F.lit(True).alias(f"{name}_present"),
        )

    both = side(left, "left").join(side(right, "right"), ["file_id", "key"], "full_outer")
    one_sided = F.col("left_present").isNull() | F.col("right_present").isNull()
    differs = ~F.col("key").isin(*ignored) & ~F.col("left_value").eqNullSafe(F.col("right_value"))
    return both.where(one_sided | differs).select(
        "file_id",
        "key",
        "left_value",
        "right_value",
        F.coalesce("left_present", F.lit(False)).alias("left_present"),
        F.coalesce("right_present", F.lit(False)).alias("right_present"),
    )


def compare_manifests(benchmark: DataFrame | None, other: DataFrame | None) -> bool:
    """Raise on the first difference; False when a manifest is missing and nothing was
    compared."""
    if benchmark is None or other is None:
        return False
    first = manifest_differences(benchmark, other).orderBy("file_id", "key").first()
    if first:
        raise ManifestError(
            f"{first['file_id']}.{first['key']} differs: "
            f"{first['left_value']} against {first['right_value']}."
        )
    return True


def table_fingerprint(df: DataFrame) -> DataFrame:
    """One row (row_count, content_hash) that ignores row order but keeps duplicates.

    The hash skips nulls, so it also gets where they are."""
    nulls = [F.col(f"`{c}`").isNull() for c in df.columns]
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(
            F.sum(F.xxhash64(*nulls, *df.columns).cast("decimal(38,0)")),
            F.lit(0).cast("decimal(38,0)"),
        ).alias("content_hash"),
    )


def fingerprints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (table_name, row_count, content_hash), one aggregate per table."""
    return reduce(
        DataFrame.unionByName,
        [
            table_fingerprint(df).select(F.lit(name).alias("table_name"), "*")
            for name, df in tables.items()
        ],
    )

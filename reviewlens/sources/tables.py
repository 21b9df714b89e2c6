"""Reading and writing review tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reviewlens.session import materialize

REVIEWS_SCHEMA = (
    "review_id string, app_id string, app_name string, `author.steamid` string, review string, "
    "recommended string, `author.playtime_at_review` string, received_for_free string, "
    "votes_helpful string"
)


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    """The same rows; raises with the list of missing columns. Reads no data."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {', '.join(missing)}")
    return df


def read_reviews(
    spark: SparkSession, path: str, schema: str | None = REVIEWS_SCHEMA,
    columns: Sequence[str] | None = None, multiline: bool = True,
) -> DataFrame:
    """Review rows from CSV with a header; columns are matched by name.

    Quoted line breaks need ``multiline``, which reads a file in one task. Pass
    large exports through ``store_reviews`` once and read its Parquet parts
    from then on, or give ``multiline=False`` where texts hold no line breaks.
    The header decides the column order; ``schema`` sets the types by name.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    rows = reader.csv(path)
    if schema:
        types = {f.name: f.dataType for f in spark.createDataFrame([], schema).schema}
        known = [name for name in rows.columns if name in types]
        rows = rows.select(*[F.col(f"`{name}`").try_cast(types[name]).alias(name) for name in known])
    if columns is not None:
        require_columns(rows, columns, path)
        rows = rows.select(*[f"`{name}`" for name in columns])
    return rows


def store_reviews(spark: SparkSession, path: str, target: str, parts: int = 200, **options) -> DataFrame:
    """The CSV export as a Parquet table of ``parts`` files, written once; options as for ``read_reviews``."""
    read_reviews(spark, path, **options).repartition(parts).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


# spellings found in exports, and the names the operators expect
COLUMN_NAMES = {
    "author.steamid": "rater_id",
    "author.playtime_at_review": "playtime_minutes",
    "author_playtime_at_review": "playtime_minutes",
    "playtime_at_review": "playtime_minutes",
}


def plain_names(df: DataFrame) -> DataFrame:
    """Known columns under the operators' default names; the first spelling wins."""
    renames: dict[str, str] = {}
    for name, plain in COLUMN_NAMES.items():
        if name in df.columns and plain not in df.columns and plain not in renames.values():
            renames[name] = plain
    return df.withColumnsRenamed(renames)


def write_processed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_processed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the named columns leave the scan."""
    return require_columns(spark.read.parquet(path), columns, path).select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder with headers; null is an empty field, quotes are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def append_results(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_json_records(records: DataFrame, path: str) -> None:
    """One JSON record per line."""
    records.select("record").write.mode("overwrite").text(path)


PROFILE_PARTS = ("items", "clusters", "manifest")


def write_profiles(items: DataFrame, clusters: DataFrame, manifest: DataFrame, path: str) -> None:
    """Item table, themes with their vectors, and the run summary as JSON."""
    items.write.mode("overwrite").parquet(f"{path}/items")
    clusters.write.mode("overwrite").parquet(f"{path}/clusters")
    stamped = manifest.withColumn("prepared_utc", F.current_timestamp())
    stamped.write.mode("overwrite").json(f"{path}/manifest")


def load_profiles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, clusters and manifest; raises with the parts that are missing."""
    missing = [name for name in PROFILE_PARTS if newest_change(spark, f"{path}/{name}") is None]
    if missing:
        raise FileNotFoundError(f"{path}: missing {', '.join(missing)}")
    return (
        spark.read.parquet(f"{path}/items"),
        spark.read.parquet(f"{path}/clusters"),
        spark.read.json(f"{path}/manifest"),
    )


def newest_change(spark: SparkSession, path: str):
    """Latest modification time below a path, or null; file contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = files.option("ignoreMissingFiles", True)
    try:
        return files.load(path).agg(F.max("modificationTime")).first()[0]
    except Exception as error:  # the folder does not exist yet
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


_FINGERPRINT = "file string, path string, length long, modified timestamp"


def fingerprints(spark: SparkSession, source: str) -> DataFrame:
    """Name as rows know it, path, length and modification time of every file below a path; contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    return files.select(F.input_file_name().alias("file"), "path", "length", F.col("modificationTime").alias("modified"))


def _commits(spark: SparkSession, target: str) -> tuple[int, DataFrame] | None:
    """Number and content of the last commit below a target: every source file and the commit that holds its rows."""
    try:
        markers = spark.read.schema(f"{_FINGERPRINT}, home long, number long").parquet(f"{target}/commits")
        last = markers.agg(F.max("number")).first()[0]
    except Exception as error:  # nothing was ever committed
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return None if last is None else (last, markers.filter(F.col("number") == last).drop("number"))


def current_table(spark: SparkSession, target: str) -> DataFrame:
    """What the last commit of ``refresh_if_stale`` made visible."""
    found = _commits(spark, target)
    if found is None:
        raise FileNotFoundError(target)
    _, files = found
    rows = spark.read.option("basePath", f"{target}/data").parquet(*[
        f"{target}/data/home={row[0]}" for row in files.select("home").distinct().collect()])
    if "_file" in rows.columns:
        # of a home only the files that have not been built anew since
        rows = rows.join(files.select(F.col("file").alias("_file"), "home"), ["_file", "home"], "left_semi")
    return rows.drop("_file", "home")


def refresh_if_stale(
    spark: SparkSession, source: str, target: str, build: Callable[..., DataFrame], force: bool = False, row_wise: bool = False,
) -> DataFrame:
    """The table at ``target`` derived from the files below ``source``, built anew where these have changed.

    Every build writes files of its own and then a marker, a single file that
    names all source files with length and modification time. Readers follow
    the last marker, so they have the old table until a build is complete, and
    a build that fails changes nothing. ``build(spark, source)`` makes the whole
    table. A ``row_wise`` build makes its rows one by one from those of its
    files, without shuffles; it is called with the list of files that are new
    or have changed, and rows of other files stay where they are. Without any
    change, and without ``force``, nothing is built. Files of earlier commits
    are left to running readers.
    """
    try:
        now = materialize(fingerprints(spark, source))
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(source) from error
        raise
    if now.isEmpty():
        raise FileNotFoundError(source)
    last = _commits(spark, target)
    number = 0 if last is None else last[0] + 1
    names = ["file", "path", "length", "modified"]
    kept = now.limit(0).withColumn("home", F.lit(0).cast("long")) if last is None or force else now.join(last[1], names)
    # one row for each source file that has to be read
    changed = now.join(kept, "file", "left_anti")
    gone = last is not None and not last[1].join(now, "file", "left_anti").isEmpty()
    if changed.isEmpty() and not gone:
        return current_table(spark, target)
    home = f"{target}/data/home={number}"
    if row_wise:
        files = sorted(row[0] for row in changed.select("path").collect())
        if files:
            build(spark, files).withColumn("_file", F.input_file_name()).write.mode("overwrite").parquet(home)
        marker = kept.unionByName(changed.withColumn("home", F.lit(number).cast("long")))
    else:
        build(spark, source).write.mode("overwrite").parquet(home)
        marker = now.withColumn("home", F.lit(number).cast("long"))
    marker.withColumn("number", F.lit(number).cast("long")).coalesce(1).write.mode("append").parquet(f"{target}/commits")
    return current_table(spark, target)

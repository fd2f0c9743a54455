"""Tables kept in buckets by a hash of their key, so that a load writes the buckets it changes and no others.

A version of such a table is a catalog table partitioned by `_bucket`. Each of its partitions lies where that bucket
was last written, in the version's own folder or in one of an older version. The manifest, a small table in the version's
folder, says where; it has a row per bucket that holds rows. Readers see one whole version, as with other tables, for it is shown by
the same swap of a view.

A version also has its repeated keys, with their counts. A key lies in one bucket, so only the buckets that a load writes are counted again.

Rows without a key are in bucket 0. Rows of one key are in one bucket, which the writer spreads over several tasks and files
if it is large. The number of buckets is given once and bounds what reaches the driver: numbers and places of buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowloom.functions.text import quoted

BUCKET = "_bucket"
BUCKETS = 256
_KEY, _COUNT, _FOLDER = "bucket_key", "buckets", "bucket_folder"


@dataclass(frozen=True)
class Buckets:
    """How a version is laid out: the key, the number of buckets, and the version's folder."""

    key: str
    n: int
    folder: str


def bucket_of(key: Column, n: int) -> Column:
    """The bucket of a key; told from MD5, which other engines that read the files have as well."""
    number = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return F.coalesce(F.pmod(number, F.lit(n)), F.lit(0)).cast("int")


def buckets_of(spark: SparkSession, version: str | None) -> Buckets | None:
    """The layout of a version; None if it is not kept in buckets."""
    if not version or not spark.catalog.tableExists(version):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {version}").collect()}
    return Buckets(found[_KEY], int(found[_COUNT]), found[_FOLDER]) if _COUNT in found else None


def _fs(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, layout: Buckets) -> DataFrame:
    """(bucket, place) of a version; empty if it was never completed."""
    path, fs = _fs(spark, f"{layout.folder}/manifest/_SUCCESS")
    schema = "bucket int, place string"
    return spark.read.schema(schema).parquet(f"{layout.folder}/manifest") if fs.exists(path) else spark.createDataFrame([], schema)


def places(spark: SparkSession, layout: Buckets) -> dict[int, str]:
    return {r["bucket"]: r["place"] for r in manifest(spark, layout).collect()}          # at most layout.n


def repeated(spark: SparkSession, layout: Buckets) -> DataFrame | None:
    """(bucket, key, cnt): the keys that a version has more than once, and its rows without a key; None if it was never counted."""
    path, fs = _fs(spark, f"{layout.folder}/repeated/_SUCCESS")
    return spark.read.parquet(f"{layout.folder}/repeated") if fs.exists(path) else None


def _count_keys(spark: SparkSession, version: str, layout: Buckets, before: Buckets | None, changed: list[int] | None) -> None:
    """Notes the repeated keys of a version: of the changed buckets as they are now, of the others as they were."""
    rows, known = spark.table(version), repeated(spark, before) if before else None
    if known is not None:
        rows = rows.where(F.col(BUCKET).isin(changed or []))
    counts = rows.groupBy(F.col(BUCKET).alias("bucket"), F.col(quoted(layout.key)).alias("key")).agg(F.count("*").alias("cnt"))
    counts = counts.where("cnt > 1 OR key IS NULL")
    if known is not None:
        counts = counts.unionByName(known.where(~F.col("bucket").isin(changed or [])))
    counts.write.parquet(f"{layout.folder}/repeated")


def hit(keys: DataFrame, layout: Buckets) -> list[int]:
    """The buckets in which the keys of a table's only column lie: at most layout.n numbers."""
    found = keys.select(bucket_of(F.col(quoted(keys.columns[0])), layout.n).alias(BUCKET)).distinct()
    return sorted(r[0] for r in found.collect())


def write_version(df: DataFrame, version: str, layout: Buckets, before: Buckets | None = None, changed: list[int] | None = None) -> None:
    """Makes a version: `df` has all rows, or with `before` those of the `changed` buckets, the others staying where they are.

    The table comes first, so that whoever drops a version that was never completed finds its folder.
    """
    spark = df.sparkSession
    rows = df.withColumn(BUCKET, bucket_of(F.col(quoted(layout.key)), layout.n))
    spark.createDataFrame([], rows.schema).write.partitionBy(BUCKET).option("path", layout.folder).saveAsTable(version)
    spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('{_KEY}' = '{layout.key}', '{_COUNT}' = '{layout.n}', '{_FOLDER}' = '{layout.folder}')")
    # small buckets share a task, a large one is split
    rows.hint("rebalance", F.col(BUCKET)).write.mode("append").partitionBy(BUCKET).parquet(layout.folder)
    path, fs = _fs(spark, layout.folder)
    written = {}
    for f in fs.listStatus(path):                                                         # at most layout.n folders
        name = f.getPath().getName()
        if name.startswith(f"{BUCKET}="):
            written[int(name.partition("=")[2])] = f"{layout.folder}/{name}"
    if before:
        if astray := sorted(set(written) - set(changed or ())):
            raise ValueError(f"rows for buckets that were not to be changed: {astray[:10]}")
        kept = {b: place for b, place in places(spark, before).items() if b not in set(changed or ())}
        written = kept | written
    if written:
        parts = " ".join(f"PARTITION ({BUCKET} = {b}) LOCATION '{place}'" for b, place in sorted(written.items()))
        spark.sql(f"ALTER TABLE {version} ADD IF NOT EXISTS {parts}")
    _count_keys(spark, version, layout, before, changed)
    spark.createDataFrame(sorted(written.items()), "bucket int, place string").coalesce(1).write.parquet(f"{layout.folder}/manifest")


def drop_files(spark: SparkSession, layout: Buckets, others: list[Buckets]) -> None:
    """Deletes the files of a version that is being dropped, but for buckets that other versions show as well."""
    used = {place for other in others for place in places(spark, other).values()}
    gone = set(places(spark, layout).values()) - used
    for place in gone:
        path, fs = _fs(spark, place)
        fs.delete(path, True)
    for folder in {layout.folder} | {place.rpartition("/")[0] for place in gone}:
        path, fs = _fs(spark, folder)
        if folder == layout.folder:
            for notes in ("manifest", "repeated"):
                fs.delete(_fs(spark, f"{folder}/{notes}")[0], True)
        in_use = any(place.startswith(f"{folder}/") for place in used) or any(other.folder == folder for other in others)
        if fs.exists(path) and not in_use:
            fs.delete(path, True)

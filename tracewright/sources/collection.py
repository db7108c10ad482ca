"""A collection on disk as DataFrames: one for each kind of file, over all datasets at once.

A collection is a tree <root>/<user>/<dataset>/{meta,data,videos}. The name <user>/<dataset>
comes from each file's path, so a collection is a partition key and never a loop.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.sources import sinks

INFO = "codebase_version string, total_episodes bigint, total_frames bigint, total_videos bigint, chunks_size int, fps double, splits map<string,string>, features map<string,struct<dtype:string,shape:array<int>>>"
EPISODES = "episode_index bigint, length bigint"
STATS = "episode_index bigint, stats variant"


def name_of(path: Column, below: str) -> Column:
    return F.regexp_extract(path, f"([^/]+/[^/]+)/{below}", 1)


def info(spark: SparkSession, roots: list[str]) -> DataFrame:
    """name, root, the declared metadata, and defaults: version ?, totals 0, chunks of 1000."""
    path = F.col("_metadata.file_path")
    read = spark.read.schema(INFO).option("multiLine", True).json([f"{r}/*/*/meta/info.json" for r in roots])
    rows = read.withColumn("name", name_of(path, "meta/info[.]json$")).withColumn("root", F.regexp_extract(path, "^(.*)/[^/]+/[^/]+/meta/info[.]json$", 1))
    totals = {c: F.coalesce(c, F.lit(0)) for c in ("total_episodes", "total_frames", "total_videos")}
    return rows.withColumns(totals | {"codebase_version": F.coalesce("codebase_version", F.lit("?")), "chunks_size": F.coalesce("chunks_size", F.lit(1000))})


def duplicates(rows: DataFrame) -> DataFrame:
    """Names found under several roots."""
    return rows.groupBy("name").agg(F.countDistinct("root").alias("roots")).filter("roots > 1")


def episodes(spark: SparkSession, root: str) -> DataFrame:
    """Declared episodes of v2 datasets; blank lines are skipped."""
    read = spark.read.schema(EPISODES).json(f"{root}/*/*/meta/episodes.jsonl")
    return read.withColumn("name", name_of(F.col("_metadata.file_path"), "meta/episodes[.]jsonl$")).filter("episode_index IS NOT NULL")


def episode_stats(spark: SparkSession, root: str) -> DataFrame:
    """Statistics of v2.1 episodes; values stay variants, as their nesting varies."""
    read = spark.read.text(f"{root}/*/*/meta/episodes_stats.jsonl").filter("trim(value) <> ''")
    parsed = read.select(name_of(F.col("_metadata.file_path"), "meta/episodes_stats[.]jsonl$").alias("name"), F.parse_json("value").alias("v"))
    return parsed.select("name", F.variant_get("v", "$.episode_index", "bigint").alias("episode_index"), F.variant_get("v", "$.stats", "variant").alias("stats"))


def frames(spark: SparkSession, root: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Frames of all datasets with the given columns, and only these are read; all columns for None."""
    roots = [root] if isinstance(root, str) else root
    read = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(*[f"{r}/*/*/data" for r in roots])
    path = F.col("_metadata.file_path")
    return read.select(name_of(path, "data/").alias("name"), path.alias("path"), *[F.col(f"`{c}`") for c in (read.columns if columns is None else columns)])


def footer_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows of each data file; no column is read."""
    read = spark.read.schema("episode_index bigint").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root}/*/*/data")
    counted = read.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(name_of(F.col("path"), "data/").alias("name"), F.regexp_extract("path", "episode_([0-9]+)[.]parquet$", 1).try_cast("bigint").alias("episode_index"), "path", "n")


def files(spark: SparkSession, root: str) -> DataFrame:
    """name, path and size of every file; contents are not read."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return read.withColumn("name", F.regexp_extract("path", "([^/]+/[^/]+)/(?:meta|data|videos)/", 1)).filter("name <> ''")


def total_sizes(rows: DataFrame) -> DataFrame:
    """rows (name, length), a file each: name and size_bytes."""
    return rows.groupBy("name").agg(F.sum("length").alias("size_bytes"))


def sizes(spark: SparkSession, root: str) -> DataFrame:
    return total_sizes(files(spark, root))


def discover(spark: SparkSession, roots: list[str]) -> DataFrame:
    """``info`` of all datasets; fails if there are none, or if a name stands under several roots."""
    rows = info(spark, roots)
    if rows.isEmpty():
        raise ValueError(f"no datasets under {roots}")
    twice = [r["name"] for r in duplicates(rows).orderBy("name").limit(20).collect()]
    if twice:
        raise ValueError(f"datasets found under several roots: {twice}")
    return rows


def documents(spark: SparkSession, roots: list[str], below: str) -> DataFrame:
    """name, root, path and text of one file of every dataset that has it, read as a whole."""
    read = spark.read.text([f"{r}/*/*/{below}" for r in roots], wholetext=True)
    path = F.col("_metadata.file_path")
    pattern = below.replace(".", "[.]")
    return read.select(name_of(path, f"{pattern}$").alias("name"), F.regexp_extract(path, f"^(.*)/[^/]+/[^/]+/{pattern}$", 1).alias("root"), path.alias("path"), F.col("value").alias("text"))


def stats(spark: SparkSession, roots: list[str]) -> DataFrame:
    """name, root, path and stats (feature to statistic to its JSON text) of the datasets that have meta/stats.json."""
    return documents(spark, roots, "meta/stats.json").withColumn("stats", F.from_json("text", "map<string,map<string,string>>")).drop("text")


def episode_table(spark: SparkSession, roots: list[str], columns: str | None = None) -> DataFrame:
    """Columns (DDL; all for None) of the episode tables of v3 datasets, and name; columns that a dataset lacks are null.

    All columns can be had only if datasets agree on their types; ``schemas`` tells where they don't.
    """
    reader = spark.read.schema(columns) if columns else spark.read.option("mergeSchema", True)
    read = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(*[f"{r}/*/*/meta/episodes" for r in roots])
    return read.withColumn("name", name_of(F.col("_metadata.file_path"), "meta/episodes/"))


def schemas(spark: SparkSession, root: str) -> DataFrame:
    """name, path, column and type of every column of every data file, from the footers alone."""
    paths = files(spark, root).filter("path LIKE '%/data/%.parquet'").select("name", "path")

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            for name, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, at = sinks.filesystem(path)
                found = pq.read_schema(at, filesystem=system)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found)), pa.array([path] * len(found)), pa.array(found.names), pa.array([str(t) for t in found.types])], names=["name", "path", "column", "type"])

    return paths.mapInArrow(footers, "name string, path string, column string, type string")


def index_extremes(spark: SparkSession, root: str, column: str = "index") -> DataFrame:
    """name, path, rows, low and high of a column of each data file: footer statistics, or the column itself where a file has none."""
    paths = files(spark, root).filter("path LIKE '%/data/%.parquet'").select("name", "path")
    kinds = [("name", pa.string()), ("path", pa.string()), ("rows", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for name, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, at = sinks.filesystem(path)
                file = pq.ParquetFile(at, filesystem=system)
                number = file.schema_arrow.get_field_index(column)
                found = [g.column(number).statistics for g in map(file.metadata.row_group, range(file.metadata.num_row_groups))] if number >= 0 else []
                if found and all(s is not None and s.has_min_max for s in found):
                    low, high = min(s.min for s in found), max(s.max for s in found)
                else:
                    ends = pc.min_max(file.read([column]).column(0)).as_py() if number >= 0 and file.metadata.num_rows else {"min": None, "max": None}
                    low, high = ends["min"], ends["max"]
                out.append({"name": name, "path": path, "rows": file.metadata.num_rows, "low": low, "high": high})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kinds))

    return paths.mapInArrow(footers, "name string, path string, rows long, low long, high long")


def resolved(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """wanted (name, kind, chunk, episode), found (name, kind, chunk, episode, path): the path of each, in its own chunk or else the first of any; null if there is none."""
    exact = F.min(F.when(F.col("_at") == F.col("chunk"), F.col("path")))
    keys = ["name", "kind", "episode"]
    both = wanted.join(found.select(*keys, F.col("chunk").alias("_at"), "path"), keys, "left")
    return both.groupBy("name", "kind", "chunk", "episode").agg(F.coalesce(exact, F.min("path")).alias("path"))


def episode_files(spark: SparkSession, root: str) -> DataFrame:
    """name, kind (data, or the key of a camera), chunk, episode and path of the files of v2 datasets that hold one episode each."""
    path = F.col("path")
    video = F.regexp_extract(path, "/videos/chunk-[0-9]+/([^/]+)/episode_[0-9]+[.]mp4$", 1)
    data = path.rlike("/data/chunk-[0-9]+/episode_[0-9]+[.]parquet$")
    rows = files(spark, root).withColumn("kind", F.when(data, "data").when(video != "", video)).filter("kind IS NOT NULL")
    return rows.select("name", "kind", F.regexp_extract(path, "/chunk-([0-9]+)/", 1).cast("long").alias("chunk"), F.regexp_extract(path, "episode_([0-9]+)[.]", 1).cast("long").alias("episode"), "path")


def wanted(rows: DataFrame, names: DataFrame, key: str = "name") -> tuple[DataFrame, DataFrame]:
    """The rows whose key is among ``names``, and the names that no row has."""
    return rows.join(names.select(key), key, "left_semi"), names.select(key).join(rows.select(key), key, "left_anti")


def subset(rows: DataFrame, chosen: list[str] | None) -> tuple[DataFrame, list[str]]:
    """The rows of the chosen names (None: all, empty: none), and the names that don't exist."""
    if chosen is None:
        return rows, []
    names = rows.sparkSession.createDataFrame([(n,) for n in sorted(set(chosen))], "name string")
    found, unknown = wanted(rows, names)
    return found, [r["name"] for r in unknown.collect()]  # of names that the caller gave


def write_frames(rows: DataFrame, path: str) -> None:
    """Frames by dataset, in the order of episode and frame; datasets that ``rows`` lacks stay as they are."""
    split = rows.withColumn("user", F.substring_index("name", "/", 1)).withColumn("dataset", F.substring_index("name", "/", -1)).drop("name")
    ordered = split.repartitionByRange("user", "dataset", "episode_index").sortWithinPartitions("user", "dataset", "episode_index", "frame_index")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("user", "dataset").parquet(path)


def append_manifest(rows: DataFrame, path: str, **columns: str | int) -> None:
    """Outcomes as JSON lines with the time (UTC) and a position by which later lines win: the instant of the batch, then the row's place in it."""
    stamped = rows.withColumn("time", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")).withColumns({c: F.lit(v) for c, v in columns.items()})
    place = F.struct(F.unix_micros(F.current_timestamp()).alias("batch"), F.monotonically_increasing_id().alias("row"))
    stamped.withColumn("position", place).write.mode("append").json(path)

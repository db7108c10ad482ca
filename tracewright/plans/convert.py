"""Conversion of v2.0 and v2.1 collections to v3.0, all datasets in one set of plans.

Declared episodes are held against the rows of their files, kept ones are numbered anew,
statistics are repaired, pruned and, where they lack, taken from the frames, and every
aggregate is reckoned from what is kept. Each camera's episodes stay files of their own
(file number = episode), which the target layout allows, so no video is cut or joined; without
a codec, packets cannot be counted, so an episode of a dataset with cameras whose rows differ
from its declared length is dropped, never repaired. Data columns must have one type in all
datasets of a run; ``collection.schemas`` tells where they have not.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.functions import vectors
from tracewright.operators import reconcile, report, schema, sequence, stats
from tracewright.plans.jobs import Staging, aggregated, chosen, lay_out, linked, rebuilt_frames, stats_documents
from tracewright.sources import collection, sinks

#: Fixed values of the format.
DATA_PATH = "data/chunk-{chunk_index:03d}/file-{file_index:03d}.parquet"
VIDEO_PATH = "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4"
SKIPPED_FILES = "[.]bak$"
MOMENTS = ("min", "max", "mean", "std", "count")
CONVERTED = "dataset string, status string, source_version string, episodes bigint, frames bigint, dropped_features array<string>, corrections struct<aggregates:map<string,struct<`from`:string,`to`:string>>,dropped_corrupt_episodes:array<bigint>,repaired_episode_lengths:bigint>, error string, time string, run string, position struct<batch:bigint,row:bigint>"


def revise_info(text: str, changes: str, dropped: list[str] | None) -> str:
    """An info document with members replaced and features taken out."""
    info = json.loads(text) | json.loads(changes)
    info["features"] = {k: f for k, f in info["features"].items() if k not in set(dropped or [])}
    return json.dumps(info, indent=4) + "\n"


def converted(spark: SparkSession, output: str) -> DataFrame:
    """Names and versions at the target, which need not exist; a document that cannot be read counts as none."""
    try:
        return collection.info(spark, [output]).select("name", F.col("codebase_version").alias("version"))
    except AnalysisException:
        return spark.createDataFrame([], "name string, version string")


def stored_stats(spark: SparkSession, source: str, features: DataFrame) -> DataFrame:
    """name, episode_index, feature, stat, values of the statistics that datasets have, keys repaired, undeclared ones pruned, oversized ones shrunk."""
    try:
        found = collection.episode_stats(spark, source)
    except AnalysisException:  # no dataset has any
        found = spark.createDataFrame([], "name string, episode_index bigint, v string").select("name", "episode_index", F.parse_json("v").alias("stats"))
    cells = found.select("name", "episode_index", F.explode(F.from_json(F.to_json("stats"), "map<string,map<string,string>>")).alias("feature", "cells"))
    images = schema.flat_keys(features, ["name"]).select("name", F.col("old").alias("feature"), "new")
    known = features.select("name", F.col("key").alias("feature"), F.lit(True).alias("known"))
    cells = cells.join(known, ["name", "feature"], "left")
    cameras = features.filter(F.col("key").startswith(schema.IMAGES)).select("name", "key")
    unmet = cameras.join(cells.select("name", F.col("feature").alias("key")).distinct(), ["name", "key"], "left_anti")
    strange = cells.filter(F.col("known").isNull() & F.col("feature").startswith("observation.")).select("name", F.col("feature").alias("key")).distinct()
    flat = strange.join(images.select("name", F.col("feature").alias("key")), ["name", "key"], "left_anti")
    by_place = schema.positional_keys(flat, unmet, ["name"]).select("name", F.col("old").alias("feature"), "new")
    repairs = images.join(by_place.select("name", "feature"), ["name", "feature"], "left_anti").unionByName(by_place)  # matched ghosts override
    fixed = cells.join(F.broadcast(repairs), ["name", "feature"], "left").withColumn("feature", F.coalesce("new", "feature")).join(features.select("name", F.col("key").alias("feature")), ["name", "feature"], "left_semi")
    parsed = lambda k: stats.normalised(F.parse_json(F.try_element_at("cells", F.lit(k))))
    wide = fixed.select("name", "episode_index", "feature", *[parsed(k).alias(k) for k in MOMENTS])
    small = stats.shrunk(*[F.col(k) for k in MOMENTS[:4]]) | {"count": stats.shrunk_count(F.col("count").cast("array<bigint>")).cast("array<double>")}
    long = F.inline(F.array(*[F.struct(F.lit(k).alias("stat"), c.alias("values")) for k, c in small.items()]))
    return wide.select("name", "episode_index", "feature", long).filter("values IS NOT NULL")


def frame_stats(frames: DataFrame, columns: list[str]) -> DataFrame:
    """The same from the frames: min, max, mean, population std and count of every dimension of each numeric column."""
    kinds = {f.name: f.dataType for f in frames.schema.fields}
    out = None
    for c in columns:
        vector = F.col(f"`{c}`") if isinstance(kinds[c], T.ArrayType) else F.when(F.col(f"`{c}`").isNotNull(), F.array(f"`{c}`"))
        if isinstance(kinds[c], T.StringType | T.StructType | T.BinaryType):
            continue
        rows = frames.select("name", "episode_index", F.lit(c).alias("feature"), F.posexplode(vector).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
        out = rows if out is None else out.unionAll(rows)
    found = stats.moments(out, ["name", "episode_index", "feature", "dim"])
    long = found.unpivot(["name", "episode_index", "feature", "dim"], [F.col(k).cast("double").alias(k) for k in MOMENTS], "stat", "value")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda s: s["value"])  # an entry a dimension
    cells = long.groupBy("name", "episode_index", "feature", "stat").agg(in_order.alias("values"))
    return cells.withColumn("values", F.when(F.col("stat") == "count", F.slice("values", 1, 1)).otherwise(F.col("values")))


def sanitised(frames: DataFrame, features: DataFrame) -> DataFrame:
    """Frames with the columns that their datasets declare (others null, and gone if none does); lists of one where the shape is [1] unwrapped."""
    per = features.filter("dtype <> 'video'").groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("key", "shape"))).alias("_shapes"))  # a dataset's features
    declared = {r["key"] for r in features.select("key").distinct().collect()}  # names of columns
    joined = frames.join(F.broadcast(per), "name")
    always = ("name", "path", "episode_index", "frame_index", "index")
    single = {r["key"] for r in features.filter(F.size("shape") == 1).filter(F.col("shape")[0] == 1).select("key").distinct().collect()}

    def column(f: T.StructField) -> Column:
        cell = F.col(f"`{f.name}`")
        cell = vectors.unwrapped(cell) if f.name in single and isinstance(f.dataType, T.ArrayType) else cell
        return F.when(F.map_contains_key("_shapes", F.lit(f.name)), cell).alias(f.name)

    return joined.select(*[F.col(f.name) if f.name in always else column(f) for f in frames.schema.fields if f.name in always or f.name in declared])


def convert_collection(spark: SparkSession, source: str, output: str, names: list[str] | None = None, force: bool = False) -> DataFrame:
    """Datasets of ``source`` in the target format under ``output``: CONVERTED, a row a dataset that was tried or is unsupported.

    What ``output`` has in the target version is skipped unless ``force``. Outcomes are appended to conversion_manifest.jsonl.
    """
    work = Staging(spark, output)
    run, ready = work.root.rsplit("/", 1)[1], f"{work.root}/ready"
    try:
        info = chosen(collection.discover(spark, [source]), names)
        routed = work.store(report.routed(info.withColumnRenamed("codebase_version", "version"), converted(spark, output), force), "routed")
        todo = routed.filter("route = 'todo'")
        features = schema.exploded(todo, ["name"])
        files = work.store(collection.episode_files(spark, source).join(F.broadcast(todo.select("name")), "name", "left_semi"), "files")
        videos = files.filter("kind <> 'data'").select("name", F.col("kind").alias("key"))
        hollow = schema.hollow_cameras(features, videos, todo.select("name", "total_episodes"), ["name"]).select("name", "key")
        odd = features.filter(F.col("dtype").isin(*schema.UNSUPPORTED)).select("name", "key")
        gone = work.store(hollow.union(odd), "gone")
        features = work.store(features.join(gone, ["name", "key"], "left_anti"), "features")
        cameras = features.filter("dtype = 'video'").select("name", "key")
        bare = cameras.join(videos.select("name").distinct(), "name", "left_anti").groupBy("name").agg(F.concat(F.lit("declares video features but has no videos: "), F.array_join(F.sort_array(F.collect_set("key")), ", ")).alias("error"))

        declared = work.store(collection.episodes(spark, source).select("name", "episode_index", "length").join(F.broadcast(todo.select("name", "chunks_size", "fps")), "name"), "declared")
        asked = declared.select("name", F.expr("episode_index div chunks_size").alias("chunk"), F.col("episode_index").alias("episode"))
        kinds = cameras.select("name", F.col("key").alias("kind")).union(todo.select("name", F.lit("data")))
        paths = work.store(collection.resolved(asked.join(kinds, "name"), files).filter("path IS NOT NULL"), "paths")
        data = paths.filter("kind = 'data'").select("name", F.col("episode").alias("episode_index"), "path")
        counted = collection.footer_counts(spark, source).select("path", "n").join(data, "path")
        rows = counted.select("name", "episode_index", "n")
        uncounted = declared.join(cameras, "name").select("name", "episode_index", "key", F.lit(-1).cast("long").alias("packets"))
        outcome = work.store(reconcile.reconciled(declared.select("name", "episode_index", "length"), rows, uncounted, ["name", "episode_index"]), "outcome")
        kept = outcome.filter("outcome <> 'drop'").join(bare, "name", "left_anti").select("name", "episode_index", F.col("new_length").alias("length"))
        mapping = work.store(sequence.offsets(sequence.densified(kept, ["name"], "episode_index"), ["name"], "episode_index").join(declared.select("name", "episode_index", "fps"), ["name", "episode_index"]), "mapping")

        frames = collection.frames(spark, source).join(data.select("path"), "path", "left_semi")
        frames = sanitised(frames, features)
        built = work.store(rebuilt_frames(frames, mapping), "built")
        lay_out(built, work, "frames", ready, "data/chunk-000", ["episode_index", "frame_index"])

        old = stored_stats(spark, source, features).join(mapping.select("name", "episode_index", "new_index"), ["name", "episode_index"])
        old = work.store(old.select("name", F.col("new_index").alias("episode_index"), "feature", "stat", "values"), "old-stats")
        lacking = built.select("name", "episode_index").distinct().join(old.select("name", "episode_index").distinct(), ["name", "episode_index"], "left_anti")
        numeric = [c for c in built.columns if c not in ("name", "path")]
        fresh = frame_stats(built.join(lacking, ["name", "episode_index"], "left_semi"), numeric).join(features.select("name", F.col("key").alias("feature")), ["name", "feature"], "left_semi")
        cells = work.store(old.unionByName(fresh), "stats")
        table = episode_rows(cells, mapping, cameras)
        table = work.store(table, "episodes")
        lay_out(table, work, "table", ready, "meta/episodes/chunk-000", ["episode_index"])
        aggregate = aggregated(table)
        entries = aggregate.select("name", "feature", "stat", stats.shaped(F.col("feature"), F.col("stat"), F.col("values")).alias("json"))
        texts = stats_documents(entries).select(F.concat(F.lit(f"{ready}/"), "name", F.lit("/meta/stats.json")).alias("path"), "text")
        number = F.lpad(F.col("new_index").cast("string"), 3, "0")
        films = paths.filter("kind <> 'data'").join(mapping.select("name", F.col("episode_index").alias("episode"), "new_index"), ["name", "episode"])
        sinks.copy_files(films.select(F.col("path").alias("source"), F.concat(F.lit(f"{ready}/"), "name", F.lit("/videos/"), "kind", F.lit("/chunk-000/file-"), number, F.lit(".mp4")).alias("target")), link=True)
        linked(spark, [source], mapping.select("name").distinct(), ready, f"^meta/tasks(?!.*{SKIPPED_FILES})")

        lists = gone.groupBy("name").agg(F.sort_array(F.collect_list("key")).alias("dropped_features"))
        seen = cameras.groupBy("name").agg(F.count(F.lit(1)).alias("cameras"))
        totals = mapping.groupBy("name").agg(F.count(F.lit(1)).alias("total_episodes"), F.sum("length").alias("total_frames")).join(seen, "name", "left")
        totals = totals.withColumn("total_videos", F.col("total_episodes") * F.coalesce("cameras", F.lit(0))).withColumn("splits", F.create_map(F.lit("train"), F.concat(F.lit("0:"), "total_episodes"))).drop("cameras")
        totals = work.store(totals, "totals")
        changes = F.to_json(F.struct(F.lit(report.TARGET).alias("codebase_version"), "total_episodes", "total_frames", "total_videos", "splits", F.lit(DATA_PATH).alias("data_path"), F.lit(VIDEO_PATH).alias("video_path")))
        info_texts = collection.documents(spark, [source], "meta/info.json").join(totals, "name").join(lists, "name", "left")
        # One short document a dataset.
        infos = info_texts.select(F.concat(F.lit(f"{ready}/"), "name", F.lit("/meta/info.json")).alias("path"), F.udf(revise_info, T.StringType(), useArrow=False)("text", changes, "dropped_features").alias("text"))
        sinks.write_texts(texts.union(infos))

        fields = ["total_episodes", "total_frames", "total_videos", "splits"]
        was = todo.select("name", *fields[:3], F.to_json("splits").alias("splits"))
        fixes = reconcile.corrections(was, totals.withColumn("splits", F.to_json("splits")), ["name"], fields)
        aggregates = fixes.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct(F.col("was").alias("from"), F.col("now").alias("to"))))).alias("aggregates"))  # four fields
        episodes_of = outcome.groupBy("name").agg(F.sort_array(F.collect_list(F.when(F.col("outcome") == "drop", F.col("episode_index")))).alias("dropped_corrupt_episodes"), F.sum((F.col("outcome") == "repair").cast("long")).alias("repaired_episode_lengths"))
        found = collection.frames(spark, ready, ["episode_index"]).groupBy("name").agg(F.count(F.lit(1)).alias("rows")) if not mapping.isEmpty() else spark.createDataFrame([], "name string, rows bigint")
        checked = todo.select("name", "version").join(totals.select("name", "total_episodes", "total_frames"), "name", "left").join(found, "name", "left").join(bare, "name", "left").join(lists, "name", "left").join(aggregates, "name", "left").join(episodes_of, "name", "left")
        error = F.coalesce("error", F.when(F.col("total_episodes").isNull(), "no internally consistent episodes left").when(~F.coalesce(F.col("rows") == F.col("total_frames"), F.lit(False)), F.format_string("%d rows, %d frames", "rows", "total_frames")))
        result = checked.select(F.col("name").alias("dataset"), F.when(error.isNull(), "converted").otherwise("failed").alias("status"), F.col("version").alias("source_version"), F.col("total_episodes").alias("episodes"), F.col("total_frames").alias("frames"), "dropped_features", F.struct("aggregates", "dropped_corrupt_episodes", "repaired_episode_lengths").alias("corrections"), error.alias("error"))
        result = work.store(result, "result")
        fine = result.filter("status = 'converted'")
        sinks.move_trees(fine.select(F.concat(F.lit(f"{ready}/"), "dataset").alias("source"), F.concat(F.lit(f"{output}/"), "dataset").alias("target")))
        left = routed.filter("route = 'unsupported'").select(F.col("name").alias("dataset"), F.lit("unsupported").alias("status"), F.col("version").alias("source_version"))
        collection.append_manifest(result.unionByName(left, allowMissingColumns=True), f"{output}/conversion_manifest.jsonl", run=run)
        return spark.read.schema(CONVERTED).json(f"{output}/conversion_manifest.jsonl").filter(F.col("run") == run)
    finally:
        work.drop()


def episode_rows(cells: DataFrame, mapping: DataFrame, cameras: DataFrame) -> DataFrame:
    """The target's episode table: a row an episode, a column for each statistic and each camera's place."""
    zero = F.lit(0).cast("long")
    base = mapping.select("name", F.col("new_index").alias("episode_index"), "length", F.col("from_index").alias("dataset_from_index"), F.col("to_index").alias("dataset_to_index"), "fps")
    base = base.withColumns(dict.fromkeys(("data/chunk_index", "data/file_index", "meta/episodes/chunk_index", "meta/episodes/file_index"), zero))
    keys = sorted(r["key"] for r in cameras.select("key").distinct().collect())  # names of cameras
    has = cameras.groupBy("name").agg(F.collect_set("key").alias("_cameras"))
    base = base.join(F.broadcast(has), "name", "left")
    for key in keys:
        own = lambda value, key=key: F.when(F.array_contains("_cameras", F.lit(key)), value)
        base = base.withColumns({f"videos/{key}/chunk_index": own(zero), f"videos/{key}/file_index": own(F.col("episode_index")), f"videos/{key}/from_timestamp": own(F.lit(0.0)), f"videos/{key}/to_timestamp": own(F.col("length") / F.col("fps"))})
    analytic = {"episode_index": stats.constant_stats(F.col("new_index")), "index": stats.index_stats(F.col("from_index"), F.col("length"))}
    numbers = [F.struct(F.lit(f).alias("feature"), F.lit(k).alias("stat"), F.array(v.cast("double")).alias("values")) for f, of in analytic.items() for k, v in of.items() if k in MOMENTS]
    known = cells.filter(F.col("feature").isin(*analytic)).select("name", "feature").distinct()
    renumbered = mapping.select("name", F.col("new_index").alias("episode_index"), F.inline(F.array(*numbers))).join(known, ["name", "feature"], "left_semi")
    rest = cells.filter(~(F.col("feature").isin(*analytic) & (F.col("stat") != "count")))
    long = rest.unionByName(renumbered).withColumn("column", F.concat_ws("/", F.lit("stats"), "feature", "stat"))
    columns = sorted(r["column"] for r in long.select("column").distinct().collect())  # names of statistics
    wide = long.groupBy("name", "episode_index").pivot("column", columns).agg(F.first("values"))
    return base.drop("_cameras", "fps").join(wide, ["name", "episode_index"], "left")

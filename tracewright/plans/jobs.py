"""Whole-collection jobs: exact quantiles into stats.json, and episodes filtered into one curated collection.

A job is a few plans over all datasets at once. A dataset that cannot be worked on gets a row
with status failed and its reason, and the others go on. What a job writes stands under
``.staging`` of its target first, is counted there, and takes its place dataset by dataset by a
rename; the staging folder goes at the end. Videos are files like others: they are linked or
copied, never cut, as there is no codec here, so a dataset with cameras whose episodes are to
be dropped fails with that reason.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.operators import episodes, sequence, stats
from tracewright.operators.episodes import Thresholds
from tracewright.sources import collection, sinks

#: Fixed values of the format.
FEATURES = ("action", "observation.state")
QUANTILE_KEYS = tuple(stats.QUANTILES)
DIMENSIONS, FPS = 6, 30.0
RESULT = "dataset string, status string, mode string, episodes bigint, kept bigint, drops map<string,string>, reason string, error string, time string, run string, position struct<batch:bigint,row:bigint>"


class Staging:
    """Tables of one job under its target's staging folder; each is read back where it is written, so lineage ends there."""

    def __init__(self, spark: SparkSession, target: str) -> None:
        self.spark, self.root = spark, f"{target}/.staging/{uuid.uuid4().hex}"

    def store(self, df: DataFrame, tag: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{tag}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{tag}")

    def drop(self) -> None:
        sinks.drop_tree(self.root)
        parent = self.root.rsplit("/", 1)[0]
        system, at = sinks.filesystem(parent)
        if not system.get_file_info(sinks.fs.FileSelector(at)):
            system.delete_dir(at)


def exit_code(results: DataFrame) -> int:
    """1 if a dataset failed."""
    return int(not results.filter("status = 'failed'").isEmpty())


def chosen(rows: DataFrame, names: list[str] | None) -> DataFrame:
    """``collection.subset``, which must know all names."""
    found, unknown = collection.subset(rows, names)
    if unknown:
        raise ValueError(f"unknown datasets: {unknown}")
    return found


def present(spark: SparkSession, root: str) -> DataFrame:
    """Names of the datasets under ``root``, which need not exist."""
    try:
        return collection.documents(spark, [root], "meta/info.json").select("name").distinct()
    except AnalysisException:
        return spark.createDataFrame([], "name string")


def quoted(text: Column) -> Column:
    """A JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def stats_documents(entries: DataFrame) -> DataFrame:
    """entries (name, feature, stat, json) to name and text, one JSON document a dataset."""
    cell = F.concat(quoted(F.col("stat")), F.lit(": "), F.col("json"))
    per = entries.groupBy("name", "feature").agg(F.array_join(F.array_sort(F.collect_list(cell)), ", ").alias("cells"))  # ten statistics a feature
    whole = F.concat(quoted(F.col("feature")), F.lit(": {"), F.col("cells"), F.lit("}"))
    return per.groupBy("name").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(whole)), ",\n "), F.lit("}\n")).alias("text"))


def frame_quantiles(frames: DataFrame) -> DataFrame:
    """frames (name and FEATURES): name, feature, stat and values (a double a dimension) over all frames of each dataset."""
    each = [frames.select("name", F.lit(f).alias("feature"), F.posexplode(f"`{f}`").alias("dim", "x")).withColumn("x", F.col("x").cast("double")) for f in FEATURES]
    keys = ["name", "feature", "dim"]
    found = stats.exact_quantiles(reduce(DataFrame.unionAll, each), keys)
    long = found.unpivot(keys, list(QUANTILE_KEYS), "stat", "value")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda s: s["value"])  # an entry a dimension
    return long.groupBy("name", "feature", "stat").agg(in_order.alias("values"))


def backfill(spark: SparkSession, root: str, names: list[str] | None = None, force: bool = False, dry_run: bool = False) -> DataFrame:
    """Exact quantiles of FEATURES over every frame into meta/stats.json of each dataset under ``root``: name, status, detail.

    Datasets that have all of them are skipped unless ``force``; ``dry_run`` compares and writes nothing.
    """
    found = chosen(collection.stats(spark, [root]), names)
    if found.isEmpty():
        raise ValueError(f"no datasets with meta/stats.json under {root}")
    has = lambda f, k: F.coalesce(F.map_contains_key(F.try_element_at(F.col("stats"), F.lit(f)), F.lit(k)), F.lit(False))
    missing = F.filter(F.array(*map(F.lit, FEATURES)), lambda f: ~F.map_contains_key(F.col("stats"), f))
    complete = reduce(lambda a, b: a & b, [has(f, k) for f in FEATURES for k in QUANTILE_KEYS])
    work = Staging(spark, root)
    try:
        status = F.when(F.size("missing") > 0, "failed").when(complete & F.lit(not force), "skipped").otherwise("todo")
        routed = work.store(found.withColumn("missing", missing).withColumn("status", status), "routed")
        todo = routed.filter("status = 'todo'").select("name")
        frames = collection.frames(spark, root, list(FEATURES)).join(F.broadcast(todo), "name", "left_semi")
        new = work.store(frame_quantiles(frames), "quantiles")
        old = routed.filter("status = 'todo'").select("name", "path", F.explode("stats").alias("feature", "cells")).select("name", "path", "feature", F.explode("cells").alias("stat", "json"))
        both = old.withColumn("old", F.from_json("json", "array<double>")).join(new, ["name", "feature", "stat"])
        apart = F.array_max(F.zip_with("old", "values", lambda a, b: F.abs(a - b)))
        compared = both.groupBy("name").agg(F.max(apart).alias("most"), F.count(F.lit(1)).alias("n"))
        counts = routed.select("name", F.try_element_at(F.try_element_at("stats", F.lit("action")), F.lit("count")).alias("count"))
        has_frames = new.select("name").distinct().withColumn("read", F.lit(True))
        done = routed.join(compared, "name", "left").join(counts, "name").join(has_frames, "name", "left")
        frames_of = F.coalesce(F.get(F.from_json("count", "array<bigint>"), F.lit(0)), F.lit(0))
        none = (F.col("status") == "todo") & F.col("read").isNull()
        detail = F.when(F.col("status") == "failed", F.concat(F.lit("features missing from stats.json: "), F.array_join("missing", ", "))).when(F.col("status") == "skipped", "quantiles already present").when(none, "no parquet files under data/")
        if dry_run:
            detail = detail.when(F.col("n").isNull(), "no existing quantiles").otherwise(F.format_string("max |computed - existing| = %.4f over %d entries", "most", "n"))
        else:
            detail = detail.otherwise(F.concat(frames_of.cast("string"), F.lit(" frames")))
        state = F.when(none, "failed").when(F.col("status") == "todo", "dry-run" if dry_run else "backfilled").otherwise(F.col("status"))
        result = work.store(done.select("name", state.alias("status"), detail.alias("detail")), "result")
        if not dry_run:
            fresh = new.select("name", "feature", "stat", F.to_json("values").alias("json"))
            kept = old.join(fresh, ["name", "feature", "stat"], "left_anti").select("name", "feature", "stat", "json")
            written = stats_documents(kept.union(fresh)).join(result.filter("status = 'backfilled'"), "name").join(routed.select("name", "path"), "name")
            sinks.write_texts(written.select("path", "text"))
        return spark.createDataFrame(result.orderBy("name").collect(), result.schema)  # a short row a dataset; the staging folder goes
    finally:
        work.drop()


def drop_reason() -> Column:
    """The reason of a row of ``quality_plan`` with its figures; needs max_frames and fps."""
    n = F.col("length").cast("long")
    long = F.format_string("marathon (%d frames > %d)", n, F.col("max_frames"))
    return (
        F.when(F.col("reason") == "short", F.format_string("short (%d frames)", n))
        .when(F.col("reason") == "brief", F.format_string("brief (%.2fs)", n / F.col("fps")))
        .when(F.col("reason") == "marathon", long)
        .when(F.col("reason") == "zero_travel", F.format_string("zero_travel (path %.4f)", F.col("metric")))
        .when(F.col("reason") == "idle", F.format_string("idle (%.0f%%)", F.col("metric") * 100))
        .otherwise(F.col("reason"))
    )


def scope_error(expected: int = DIMENSIONS, fps: float = FPS) -> Column:
    """Why a dataset (features, fps, stats) cannot be filtered; null if it can."""
    size = lambda f: F.try_element_at(F.col("features"), F.lit(f))["shape"][0]
    sizes = [size(f) for f in FEATURES]
    inside = F.coalesce((sizes[0] == expected) & (sizes[1] == expected) & (F.col("fps") == fps), F.lit(False))
    action = F.try_element_at(F.col("stats"), F.lit("action"))
    exact = F.coalesce(F.map_contains_key(action, F.lit("q01")) & F.map_contains_key(action, F.lit("q99")), F.lit(False))
    said = F.concat(F.lit("out of scope: dims "), *[x for f in sizes for x in (F.coalesce(f.cast("string"), F.lit("none")), F.lit(" "))], F.lit("fps "), F.coalesce(F.col("fps").cast("string"), F.lit("none")))
    return F.when(~inside, said).when(~exact, "stats.json lacks exact q01/q99: backfill before filtering")


def revise(text: str, changes: str) -> str:
    """A JSON document with the given members replaced."""
    return json.dumps(json.loads(text) | json.loads(changes), indent=1) + "\n"


def long_stats(table: DataFrame) -> DataFrame:
    """name, episode_index, feature, stat and values (doubles) of the columns stats/<feature>/<stat> of an episode table, of any nesting."""

    def flat(field: T.StructField) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if not isinstance(kind, T.ArrayType):
            return F.when(column.isNotNull(), F.array(column.cast("double")))
        while isinstance(kind.elementType, T.ArrayType):
            column, kind = F.flatten(column), kind.elementType
        return F.transform(column, lambda x: x.cast("double"))

    fields = [f for f in table.schema.fields if f.name.startswith("stats/")]
    cells = [F.struct(F.lit(f.name.split("/", 2)[1]).alias("feature"), F.lit(f.name.split("/", 2)[2]).alias("stat"), flat(f).alias("values")) for f in fields]
    kind = "array<struct<feature:string,stat:string,values:array<double>>>"
    return table.select("name", "episode_index", F.inline(F.array(*cells).cast(kind) if cells else F.array().cast(kind))).filter("values IS NOT NULL")


def aggregated(table: DataFrame) -> DataFrame:
    """name, feature, stat, values: the statistics of all episodes of each dataset in one."""
    cells = long_stats(table).filter(F.col("stat").isin("min", "max", "mean", "std", "count"))
    count = cells.filter("stat = 'count'").select("name", "episode_index", "feature", F.col("values")[0].cast("long").alias("count"))
    dims = cells.filter("stat <> 'count'").select("name", "episode_index", "feature", "stat", F.posexplode("values").alias("dim", "x"))
    wide = dims.groupBy("name", "episode_index", "feature", "dim").pivot("stat", ["min", "max", "mean", "std"]).agg(F.first("x"))
    keys = ["name", "feature", "dim"]
    whole = stats.combined(wide.join(count, ["name", "episode_index", "feature"]), keys)
    long = whole.unpivot(keys, [F.col(c).cast("double").alias(c) for c in ("min", "max", "mean", "std", "count")], "stat", "value")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda s: s["value"])
    return long.groupBy("name", "feature", "stat").agg(in_order.alias("values")).withColumn("values", F.when(F.col("stat") == "count", F.slice("values", 1, 1)).otherwise(F.col("values")))


def rebuilt_episodes(table: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows of an episode table that ``mapping`` (name, episode_index, new_index, from_index, to_index) keeps, renumbered, with the statistics that follow from numbers alone."""
    rows = table.join(mapping, ["name", "episode_index"])
    analytic = {"episode_index": stats.constant_stats(F.col("new_index")), "index": stats.index_stats(F.col("from_index"), F.col("length"))}
    fixed = {"episode_index": F.col("new_index"), "dataset_from_index": F.col("from_index"), "dataset_to_index": F.col("to_index")}
    fixed |= dict.fromkeys(("data/chunk_index", "data/file_index", "meta/episodes/chunk_index", "meta/episodes/file_index"), F.lit(0).cast("long"))
    kinds = {f.name: f.dataType for f in table.schema.fields}
    for feature, cells in analytic.items():
        for stat, value in cells.items():
            if (column := f"stats/{feature}/{stat}") in kinds:
                fixed[column] = F.array(value).cast(kinds[column])
    stay = lambda c: F.col(f"`{c}`")
    out = [fixed.get(c, stay(c)).alias(c) for c in table.columns]
    added = [fixed[c].alias(c) for c in fixed if c not in table.columns and not c.startswith("stats/")]
    return rows.select(*out, *added)


def rebuilt_frames(frames: DataFrame, mapping: DataFrame) -> DataFrame:
    """Frames that ``mapping`` keeps, with the new episode_index and an index that counts the dataset's rows."""
    rows = frames.drop("index").join(mapping.select("name", "episode_index", "new_index"), ["name", "episode_index"])
    placed = sequence.global_index(rows.drop("episode_index").withColumnRenamed("new_index", "episode_index"), ["name"], "episode_index", "frame_index")
    return placed.select("name", *[f"`{c}`" for c in frames.columns if c not in ("name", "path")])


def lay_out(rows: DataFrame, work: Staging, tag: str, target: str, below: str, order: list[str]) -> None:
    """Write rows (name, ...) as <target>/<name>/<below>/file-NNN.parquet, each dataset's in order."""
    split = rows.withColumn("_user", F.substring_index("name", "/", 1)).withColumn("_dataset", F.substring_index("name", "/", -1)).drop("name")
    keys = ["_user", "_dataset", *order]
    split.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy("_user", "_dataset").parquet(f"{work.root}/{tag}")
    listed = work.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{work.root}/{tag}").select("path")
    named = listed.withColumn("name", F.concat_ws("/", *[F.url_decode(F.regexp_extract("path", f"/{k}=([^/]+)/", 1)) for k in ("_user", "_dataset")]))
    placed = sequence.densified(named, ["name"], "path")
    goal = F.concat(F.lit(f"{target}/"), F.col("name"), F.lit(f"/{below}/file-"), F.lpad(F.col("new_index").cast("string"), 3, "0"), F.lit(".parquet"))
    sinks.move_trees(placed.select(F.col("path").alias("source"), goal.alias("target")))


def linked(spark: SparkSession, roots: list[str], names: DataFrame, target: str, only: str = "") -> None:
    """Link or copy the files of the named datasets (those whose path below the dataset matches ``only``) to <target>/<name>."""
    files = reduce(DataFrame.unionAll, [collection.files(spark, r) for r in roots]).join(F.broadcast(names.select("name")), "name", "left_semi")
    below = F.regexp_extract("path", "[^/]+/[^/]+/((?:meta|data|videos)/.*)$", 1)
    wanted = files.withColumn("below", below).filter(F.col("below").rlike(only or "."))
    sinks.copy_files(wanted.select(F.col("path").alias("source"), F.concat(F.lit(f"{target}/"), "name", F.lit("/"), "below").alias("target")), link=True)


def filter_collections(spark: SparkSession, sources: list[str], output: str, t: Thresholds | None = None, names: list[str] | None = None, force: bool = False, dry_run: bool = False) -> DataFrame:
    """Episodes of the v3 datasets under ``sources`` that pass all rules, as one collection under ``output``: RESULT, a row a dataset.

    The marathon cut comes from all sources, before ``names`` choose. Datasets that ``output`` has
    are left out unless ``force``. Datasets that lose nothing are linked, others rebuilt; outcomes
    are appended to filter_manifest.jsonl. ``dry_run`` writes neither.
    """
    t = t or Thresholds()
    work, run = Staging(spark, output), uuid.uuid4().hex
    try:
        info = collection.discover(spark, sources)
        table = work.store(collection.episode_table(spark, sources), "episodes")
        cutoff = work.store(episodes.length_cutoff(table, t.length_quantile), "cutoff")
        wanted = chosen(info, names)
        if not force and not dry_run:
            wanted = wanted.join(present(spark, output), "name", "left_anti")
        judged = wanted.join(collection.stats(spark, sources).select("name", "stats"), "name", "left").withColumn("error", scope_error())
        judged = work.store(judged.select("name", "fps", "error", F.exists(F.map_values("features"), lambda f: f["dtype"] == "video").alias("cameras")), "judged")
        inside = F.broadcast(judged.filter("error IS NULL").select("name", "fps"))  # a short row a dataset
        lengths = table.select("name", "episode_index", "length").join(inside, "name")
        frames = collection.frames(spark, sources, ["episode_index", "frame_index", *FEATURES]).drop("path")
        plan = episodes.quality_plan(lengths, frames.join(inside, "name", "left_semi").drop("fps"), ["name", "episode_index"], "frame_index", None, t, cutoff, FEATURES[0], FEATURES[1:])
        plan = work.store(plan, "plan")
        told = plan.join(inside, "name").join(F.broadcast(cutoff)).withColumn("told", drop_reason())
        dropped = F.collect_list(F.when(~F.col("keep"), F.struct(F.col("episode_index").cast("string"), F.col("told"))))  # an entry a dropped episode of one dataset
        per = told.groupBy("name").agg(F.count(F.lit(1)).alias("episodes"), F.sum(F.col("keep").cast("long")).alias("kept"), F.map_from_entries(dropped).alias("drops"))
        both = judged.join(per, "name", "left")
        few = F.coalesce("kept", F.lit(0)) < t.min_episodes
        mode = F.when(F.size("drops") == 0, "hardlink").otherwise("rebuild")
        cut = (mode == "rebuild") & F.col("cameras")
        error = F.coalesce("error", F.when(~few & cut & F.lit(not dry_run), "videos cannot be cut here: dropping episodes needs a codec"))
        status = F.when(F.col("error").isNotNull(), "failed").when(few, "dataset_dropped").when(F.lit(dry_run), "dry_run").otherwise("ok")
        reason = F.when(F.col("status") == "dataset_dropped", F.format_string("%d surviving episode(s) < %d", F.coalesce("kept", F.lit(0)), F.lit(t.min_episodes)))
        result = both.withColumn("error", error).withColumn("status", status).withColumn("reason", reason).withColumn("mode", F.when(F.col("status") == "ok", mode))
        result = work.store(result.select(F.col("name").alias("dataset"), "status", "mode", "episodes", "kept", "drops", "reason", "error"), "result")
        if not dry_run:
            result = written(spark, sources, output, work, table, plan, result)
            collection.append_manifest(result, f"{output}/filter_manifest.jsonl", run=run)
            return spark.read.schema(RESULT).json(f"{output}/filter_manifest.jsonl").filter(F.col("run") == run)
        return spark.createDataFrame(result.collect(), result.schema)  # what the caller prints: a row a dataset
    finally:
        work.drop()


def written(spark: SparkSession, sources: list[str], output: str, work: Staging, table: DataFrame, plan: DataFrame, result: DataFrame) -> DataFrame:
    """Lay out the datasets whose status is ok, count them, move those that agree to ``output``; ``result`` with what failed."""
    ready = f"{work.root}/ready"
    by_mode = lambda m: result.filter((F.col("status") == "ok") & (F.col("mode") == m)).select(F.col("dataset").alias("name"))
    linked(spark, sources, by_mode("hardlink"), ready)
    again = work.store(by_mode("rebuild"), "again")
    if not again.isEmpty():
        kept = plan.filter("keep").join(F.broadcast(again), "name", "left_semi").select("name", "episode_index", "length")
        mapping = sequence.offsets(sequence.densified(kept, ["name"], "episode_index"), ["name"], "episode_index")
        mapping = work.store(mapping.select("name", "episode_index", "new_index", "from_index", "to_index"), "mapping")
        rows = work.store(rebuilt_episodes(table, mapping), "kept-episodes")
        frames = rebuilt_frames(collection.frames(spark, sources).drop("path"), mapping)
        lay_out(frames, work, "frames", ready, "data/chunk-000", ["episode_index", "frame_index"])
        lay_out(rows, work, "table", ready, "meta/episodes/chunk-000", ["episode_index"])
        linked(spark, sources, again, ready, "^meta/tasks")
        exact = frame_quantiles(collection.frames(spark, ready, list(FEATURES)).join(F.broadcast(again), "name", "left_semi"))
        cells = aggregated(rows).unionByName(exact.select("name", "feature", "stat", "values"))
        entries = cells.select("name", "feature", "stat", stats.shaped(F.col("feature"), F.col("stat"), F.col("values")).alias("json"))
        texts = stats_documents(entries).select(F.concat(F.lit(f"{ready}/"), "name", F.lit("/meta/stats.json")).alias("path"), "text")
        totals = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("frames"))
        changes = F.to_json(F.struct(F.col("n").alias("total_episodes"), F.col("frames").alias("total_frames"), F.struct(F.concat(F.lit("0:"), "n").alias("train")).alias("splits")))
        info = collection.documents(spark, sources, "meta/info.json").join(totals, "name")
        # One short document a dataset.
        infos = info.select(F.concat(F.lit(f"{ready}/"), "name", F.lit("/meta/info.json")).alias("path"), F.udf(revise, T.StringType(), useArrow=False)("text", changes).alias("text"))
        sinks.write_texts(texts.union(infos))
    if result.filter("status = 'ok'").isEmpty():
        return result
    found = collection.episode_table(spark, [ready], "length bigint").groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("length"))
    rows = collection.frames(spark, ready, ["episode_index"]).groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
    checked = result.join(found.join(rows, "name").withColumnRenamed("name", "dataset"), "dataset", "left")
    wrong = (F.col("status") == "ok") & ~F.coalesce((F.col("n") == F.col("kept")) & (F.col("length") == F.col("rows")), F.lit(False))
    said = F.format_string("%d episodes, %d frames and %d rows, expected %d episodes", "n", "length", "rows", "kept")
    checked = checked.withColumn("error", F.when(wrong, said).otherwise(F.col("error"))).withColumn("status", F.when(wrong, "failed").otherwise(F.col("status")))
    checked = work.store(checked.select(*result.columns), "checked")
    fine = checked.filter("status = 'ok'")
    sinks.move_trees(fine.select(F.concat(F.lit(f"{ready}/"), "dataset").alias("source"), F.concat(F.lit(f"{output}/"), "dataset").alias("target")))
    return checked

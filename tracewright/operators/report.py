"""Census, routing and the parts of the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUPPORTED, TARGET = ("v2.0", "v2.1"), "v3.0"


def by_version(datasets: DataFrame, supported: tuple[str, ...] = SUPPORTED) -> DataFrame:
    """datasets (version, episodes, frames, size_bytes) per version, and whether it can be converted."""
    sums = datasets.groupBy("version").agg(F.count(F.lit(1)).alias("datasets"), *[F.sum(c).cast("long").alias(c) for c in ("episodes", "frames", "size_bytes")])
    return sums.withColumn("supported", F.col("version").isin(*supported))


def census(datasets: DataFrame) -> DataFrame:
    """One row: totals, and versions as 'n x version' in order."""
    counts = datasets.groupBy("version").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("episodes", "frames", "size_bytes")])
    listed = F.transform(F.array_sort(F.collect_list(F.struct("version", "n"))), lambda s: F.concat(s["n"], F.lit("x "), s["version"]))  # one entry a version
    return counts.agg(F.sum("n").cast("long").alias("datasets"), *[F.sum(c).cast("long").alias(c) for c in ("episodes", "frames", "size_bytes")], F.array_join(listed, ", ").alias("versions"))


def routed(datasets: DataFrame, converted: DataFrame, force: bool = False, supported: tuple[str, ...] = SUPPORTED) -> DataFrame:
    """datasets (name, version) with route: skipped, unsupported or todo. converted: names and versions found at the target."""
    done = converted.filter(F.col("version") == TARGET).select("name", F.lit(True).alias("done")).distinct()
    skip = F.lit(not force) & F.coalesce("done", F.lit(False))
    return datasets.join(done, "name", "left").withColumn("route", F.when(skip, "skipped").when(~F.col("version").isin(*supported), "unsupported").otherwise("todo")).drop("done")


def cell(text: Column, most: int = 160) -> Column:
    """Text for a table's cell: bars escaped first, then cut."""
    return F.left(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit(most))


def exclusions(manifest: DataFrame) -> DataFrame:
    """Failed and unsupported datasets with version and reason."""
    out = manifest.filter(F.col("status").isin("failed", "unsupported"))
    return out.select("dataset", F.coalesce("source_version", F.lit("?")).alias("version"), cell(F.coalesce("error", "status")).alias("reason"))


def gigabytes(size: Column) -> Column:
    return F.format_string("%.1f GB", size / F.lit(1e9))


def grouped_number(n: Column) -> Column:
    """A whole number with commas between thousands."""
    return F.format_number(n.cast("long"), 0)


def correction_notes(rows: DataFrame) -> DataFrame:
    """rows (dataset, place, field, was, now) to one note a dataset, in the order of place."""
    note = F.when(F.col("field") == "splits", "splits recomputed").otherwise(F.concat(F.lit("`"), "field", F.lit("` "), F.coalesce("was", F.lit("none")), F.lit(" -> "), F.coalesce("now", F.lit("none"))))
    listed = F.array_sort(F.collect_list(F.struct("place", note.alias("note"))))  # a few fields a dataset
    return rows.groupBy("dataset").agg(F.array_join(F.transform(listed, lambda s: s["note"]), "; ").alias("notes"))


def manifest_notes(manifest: DataFrame) -> DataFrame:
    """manifest (dataset, status, corrections, dropped_features, note): one note for each dataset that has something to say, in order."""
    changes = F.array_sort(F.map_entries(F.coalesce("corrections.aggregates", F.create_map().cast("map<string,struct<`from`:string,`to`:string>>"))))
    told = F.transform(changes, lambda e: F.when(e["key"] == "splits", "stale `splits` recomputed").otherwise(F.concat(F.lit("`"), e["key"], F.lit("` "), F.coalesce(e["value"]["from"], F.lit("None")), F.lit(" \u2192 "), F.coalesce(e["value"]["to"], F.lit("None")))))
    gone, mended, left = F.col("corrections.dropped_corrupt_episodes"), F.col("corrections.repaired_episode_lengths"), F.col("dropped_features")
    listed = lambda x, quote="": F.concat(F.lit("["), F.array_join(F.transform(x, lambda v: F.concat(F.lit(quote), v.cast("string"), F.lit(quote))), ", "), F.lit("]"))
    more = [
        F.when(F.size(gone) > 0, F.concat(F.lit("dropped "), F.size(gone).cast("string"), F.lit(" corrupt episode(s) "), listed(gone))),
        F.when(mended > 0, F.concat(F.lit("repaired "), mended.cast("string"), F.lit(" declared episode length(s)"))),
        F.when(F.size(left) > 0, F.concat(F.lit("dropped v3-incompatible features "), listed(left, "'"))),
        F.when(F.col("status") == "patched", F.col("note")),
    ]
    notes = F.array_join(F.concat(told, F.array_compact(F.array(*more))), "; ")
    return manifest.select("dataset", notes.alias("notes")).filter("notes <> ''")


def card(title: str, source: DataFrame, target: DataFrame, excluded: DataFrame, notes: DataFrame, example: str = "<user>/<dataset>") -> str:
    """A report in Markdown with front matter. source, target: ``census``; excluded: ``exclusions``; notes: ``manifest_notes``."""
    cells = lambda df: df.select(F.col("datasets").cast("string").alias("datasets"), "versions", grouped_number(F.col("episodes")).alias("episodes"), grouped_number(F.col("frames")).alias("frames"), gigabytes(F.col("size_bytes")).alias("size"), "size_bytes").first()
    old, new = cells(source), cells(target)
    out = ["---", "viewer: false", "task_categories:", "- robotics", "---", "", f"# {title}", "", f"Every `<user>/<dataset>` is a dataset of its own, for example `{example}`.", "", "## Statistics", "", "| | source | converted |", "|---|---|---|"]
    out.append(f"| datasets | {old['datasets']} ({old['versions']}) | {new['datasets']} ({new['versions']}) |")
    out += [f"| {c} | {old[c]} | {new[c]} |" for c in ("episodes", "frames", "size")]
    if (old["size_bytes"] or 0) > 1.2 * (new["size_bytes"] or 0):
        out += ["", "The converted tree is smaller because stray copies of videos stay behind; no video is encoded anew."]
    rows = excluded.orderBy("dataset").collect()  # a line of the report each
    if rows:
        out += ["", "## Datasets not included", "", "| dataset | source version | reason |", "|---|---|---|"] + [f"| `{r['dataset']}` | {r['version']} | {r['reason']} |" for r in rows]
    rows = notes.orderBy("dataset").collect()
    out += ["", "## Corrections", ""] + (["| dataset | correction |", "|---|---|"] + [f"| `{r['dataset']}` | {r['notes']} |" for r in rows] if rows else ["None were needed."])
    return "\n".join(out) + "\n"

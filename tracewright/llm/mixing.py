"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets an exponential key -ln(u) / w: u follows from its id, w is its
quality weight. Within a source, documents are taken in the order of their keys until
the source's word budget is spent. A budget of more than the source's size first takes
complete epochs, and the fraction that remains by key.

Only the point where a source's prefix sum meets its budget matters, so no source is
sorted as a whole: sizes are summed by (source, slice of key), the slice that holds the
crossing is found from those sums, and only the rows of that slice are ordered. Every
exchange carries sums or one slice, whatever share of the rows a source holds.

Null and empty texts have size 0 and take 0 words. A null source is a source of its own,
last in order. Rows of one id, size and source are interchangeable: where the budget ends
among them, each takes the same share. An empty table gives no rows. Extra columns are
ignored by ``mix`` and kept by ``mixed_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.llm._shared import WORD, store, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
#: Sources up to this number are broadcast (one short row each); more are joined by shuffle.
BROADCAST_SOURCES = 20_000
#: Rows of one slice of keys that a single task orders.
SLICE_ROWS = 100_000
#: ASCII digits and marks: texts full of them count as of low quality.
NOISE = "0123456789!\"#$%&()*+/:;<=>@[]^_`{|}~"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.1 to 1: falls with the square of the share of digits and marks; 1 for null and empty texts."""
    share = F.length(F.translate(text, NOISE, "")).cast("double") / F.length(text)
    return F.when(F.length(text) > 0, F.lit(0.1) + F.lit(0.9) * share * share).otherwise(F.lit(1.0))


def uniform(doc_id: Column) -> Column:
    """Between 0 and 1, the same in every run: 52 bits of the id's MD5."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def keyed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` with size and key."""
    return docs.select(*keep, word_count(F.col("text")).alias("size"), (-F.log(uniform(F.col("doc_id"))) / quality_weight(F.col("text"))).alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """sizes (source, source_size, n): one row per source. Adds target, epochs (complete) and rest (words beyond them).

    Water level: in the order of cap / weight, a source is full if its cap lies under the
    level that the remaining budget and weights give; the first that is not sets the level
    for itself and all after it. The windows see one row per source.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    rising = Window.orderBy("ratio", "place")
    everything = Window.partitionBy()
    cap = F.col("cap")
    df = (
        sizes.withColumn("place", F.row_number().over(place) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("ratio", cap / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("before", F.sum("cap").over(rising) - cap)
        .withColumn("heavy", F.sum("weight").over(everything) - F.sum("weight").over(rising) + F.col("weight"))
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("heavy"))
        .withColumn("full", F.col("ratio") <= F.col("level"))
        .withColumn("water", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
        .withColumn("target", F.when(F.col("full"), cap.cast("double")).otherwise(F.least(F.col("water") * F.col("weight"), cap.cast("double"))))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.round("target").cast("long") - F.col("epochs") * F.col("source_size"))
    )
    return df.select("source", "source_size", "n", "place", "target", "epochs", "rest")


def plan_mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """One row per source of ``rows`` (doc_id, source, size, key): target, epochs, and where the fraction ends.

    A row is taken once more than ``epochs`` if (key, doc_id, size) sorts before
    (cut_key, cut_id, cut_size); rows equal to it take cut_words instead.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    goal = store(targets(sizes, weights, share, most).coalesce(1), "mix-targets")
    spread = lambda df: F.broadcast(df) if goal.count() <= BROADCAST_SOURCES else df
    # Slices of equal width in ln(key), finer for larger sources, hold at most about SLICE_ROWS rows each.
    fine = F.greatest(F.lit(16.0), F.col("n") * F.lit(0.4 / SLICE_ROWS))
    sliced = rows.withColumnRenamed("source", "of").join(spread(goal), F.col("of").eqNullSafe(F.col("source"))).withColumn("slice", F.floor(F.log("key") * fine))
    sums = sliced.groupBy("place", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    up = Window.partitionBy("place").orderBy("slice")
    crossing = sums.withColumn("before", F.sum("words").over(up) - F.col("words")).filter("before <= rest AND rest < before + words").select("place", "slice", "before")
    crossing = store(crossing.coalesce(1), "mix-crossing")
    # Of each source one slice is left; rows that are alike are counted first.
    near = sliced.join(spread(crossing), ["place", "slice"]).groupBy("place", "key", "doc_id", "size").agg(F.count(F.lit(1)).alias("alike"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    order = Window.partitionBy("place").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
    reach = near.withColumn("at", F.col("before") + F.sum(F.col("size") * F.col("alike")).over(order) - F.col("size") * F.col("alike"))
    cut = reach.filter("at <= rest AND rest < at + size * alike").select("place", F.col("key").alias("cut_key"), F.col("doc_id").alias("cut_id"), F.col("size").alias("cut_size"), F.expr("(rest - at) div alike").alias("cut_words"))
    return store(goal.join(cut, "place", "left").coalesce(1), "mix-plan")


def taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``plan`` and extra: words of the fractional epoch that the row gives."""
    plan = plan.withColumnRenamed("source", "plan_source")
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    far = F.lit(2**63 - 1)
    mine = F.struct(F.col("key"), F.coalesce(F.col("doc_id").cast("long"), far), F.col("size"))
    cut = F.struct(F.col("cut_key"), F.coalesce(F.col("cut_id").cast("long"), far), F.col("cut_size"))
    extra = F.when(F.col("cut_key").isNull(), F.lit(0)).when(mine < cut, F.col("size")).when(mine == cut, F.col("cut_words")).otherwise(0)
    return rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("extra", extra.cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row of ``docs`` (doc_id, source, text)."""
    rows = store(keyed(docs, ["doc_id", "source"]), "mix-keys")
    out = taken(rows, plan_mix(rows, weights, share, most))
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, in whole texts.

    The row at which a source's budget ends is taken if over half of it fits.
    """
    names = {c: f"_doc_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    rows = store(keyed(docs, ["doc_id", "source"]), "mix-keys")
    plan = plan_mix(rows, weights, share, most)
    full = inner.withColumns({"doc_id": F.col(names["doc_id"]), "source": F.col(names["source"]), "text": F.col(names["text"])})
    full = taken(keyed(full, [*names.values(), "doc_id", "source"]), plan)
    times = F.col("epochs") + (F.col("extra") * 2 > F.col("size")).cast("long")
    many = full.withColumn("_times", times.cast("int")).filter("_times > 0")
    return many.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*[F.col(n).alias(c) for c, n in names.items()])


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = """
WITH base AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / CASE WHEN length(text) > 0 THEN 0.1::DOUBLE + 0.9::DOUBLE * (length(regexp_replace(text, '[0-9!"#$%&()*+/:;<=>@\\[\\]^_`{|}~]', '', 'g'))::DOUBLE / length(text)) * (length(regexp_replace(text, '[0-9!"#$%&()*+/:;<=>@\\[\\]^_`{|}~]', '', 'g'))::DOUBLE / length(text)) ELSE 1.0::DOUBLE END AS key
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM per),
weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 2 AS cap FROM placed),
levels AS (
  SELECT *, cap::DOUBLE / weight AS ratio,
    ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed),
watered AS (
  SELECT *, max(CASE WHEN ratio > level THEN level END) OVER () AS water FROM levels),
goals AS (
  SELECT source, source_size,
    CASE WHEN ratio <= level THEN cap::DOUBLE ELSE least(water * weight, cap::DOUBLE) END AS target FROM watered),
split AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM goals),
ordered AS (
  SELECT b.doc_id, b.size, s.source_size, s.target, s.epochs,
    round(s.target)::BIGINT - s.epochs * s.source_size AS rest,
    sum(b.size) OVER (PARTITION BY s.source ORDER BY b.key, b.doc_id NULLS LAST, b.size ROWS UNBOUNDED PRECEDING) - b.size AS before
  FROM base b JOIN split s ON b.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  (epochs * size + least(greatest(rest - before, 0), size))::BIGINT AS taken
FROM ordered
"""

"""Named queries over the driver tables, which stand in for a collection, each with its SQL.

events are frames (user_id the episode, ts the order, value the action); embeddings frames
with vectors (label the episode, vec_id the order); orders and lineitem episodes as declared
and as found; conversations spans of a video; customer, supplier, nation and region datasets
of a collection; part and documents schemas and logs.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import vectors
from tracewright.operators import episodes, reconcile, report, schema, sequence, stats
from tracewright.operators.episodes import Thresholds
from tracewright.sources import collection, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str):
    def register(f):
        SQL[f.__name__] = sql
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        return f

    return register


def r6(x: Column | str) -> Column:
    return F.round(x, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


T = Thresholds(min_frames=55, min_seconds=1.9, fps=30.0, length_quantile=0.95, min_travel=2200.0, idle_max=0.08)
FRAMES = "frames AS (SELECT user_id AS episode, ts, value FROM events)"
EPISODES = "episodes AS (SELECT user_id AS episode, count(*) AS length FROM events GROUP BY user_id)"


def frames(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").alias("episode"), "ts", F.array("value").alias("action"))


def lengths(t: Tables) -> DataFrame:
    return t.events.groupBy(F.col("user_id").alias("episode")).agg(F.count(F.lit(1)).alias("length"))


# Episode quality ------------------------------------------------------------------------


@query(f"WITH {EPISODES} SELECT floor(quantile_cont(length, 0.95))::BIGINT AS max_frames FROM episodes")
def marathon_cutoff(t):
    return episodes.length_cutoff(lengths(t), T.length_quantile)


RULES = "CASE WHEN length < 55 THEN 'short' WHEN length < 1.9 * 30 THEN 'brief' WHEN length > (SELECT floor(quantile_cont(length, 0.95)) FROM episodes) THEN 'marathon' END"


@query(f"WITH {EPISODES} SELECT episode, length, {RULES} AS reason FROM episodes")
def episode_length_rules(t):
    return episodes.length_rules(lengths(t), T)


@query("SELECT user_id AS episode, bool_or(CASE WHEN event_id % 97 = 0 THEN 'nan'::DOUBLE WHEN event_id % 89 = 0 THEN 'inf'::DOUBLE ELSE value END IN ('nan'::DOUBLE, 'inf'::DOUBLE)) AS nonfinite FROM events GROUP BY user_id")
def nonfinite_episodes(t):
    odd = F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).when(F.col("event_id") % 89 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    return t.events.select(F.col("user_id").alias("episode"), F.array(odd).alias("action")).groupBy("episode").agg(F.bool_or(~vectors.all_finite(F.col("action"))).alias("nonfinite"))


MOVED = f"{FRAMES}, moved AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY episode ORDER BY ts)) AS delta, greatest(0.01 * (max(value) OVER (PARTITION BY episode) - min(value) OVER (PARTITION BY episode)), 1e-6) AS still FROM frames)"
TRAVEL = f"{MOVED}, found AS (SELECT episode, coalesce(sum(delta), 0) AS travel, avg(CASE WHEN delta < still THEN 1.0::DOUBLE WHEN delta IS NOT NULL THEN 0.0::DOUBLE END) AS idle FROM moved GROUP BY episode)"


@query(f"WITH {MOVED} SELECT episode, ts::VARCHAR AS at, round(delta, 6) AS delta FROM moved WHERE delta IS NOT NULL")
def action_deltas(t):
    moved = episodes.deltas(frames(t), ["episode"], "ts").filter("delta IS NOT NULL")
    return moved.select("episode", F.col("ts").cast("string").alias("at"), r6(F.col("delta")[0]).alias("delta"))


def tracks(t: Tables) -> DataFrame:
    return episodes.trajectories(frames(t), ["episode"], "ts", T)


@query(f"WITH {TRAVEL} SELECT episode, round(travel, 6) AS travel FROM found")
def episode_travel(t):
    return tracks(t).select("episode", r6("travel").alias("travel"))


@query(f"WITH {TRAVEL} SELECT episode, round(idle, 6) AS idle FROM found")
def episode_idle_fraction(t):
    return tracks(t).select("episode", r6("idle").alias("idle"))


PLAN = f"{TRAVEL}, {EPISODES}, judged AS (SELECT episode, length, travel, idle, {RULES} AS early FROM episodes LEFT JOIN found USING (episode)), plan AS (SELECT episode, length, coalesce(early, CASE WHEN travel < 2200 THEN 'zero_travel' WHEN idle >= 0.08 THEN 'idle' END) AS reason, early, travel, idle FROM judged)"


def plan(t: Tables) -> DataFrame:
    return episodes.quality_plan(lengths(t), frames(t), ["episode"], "ts", 1, T)


@query(f"WITH {PLAN} SELECT episode, length, reason IS NULL AS keep, reason, round(CASE WHEN early IS NOT NULL THEN length::DOUBLE WHEN reason = 'zero_travel' THEN travel WHEN reason = 'idle' THEN idle END, 6) AS metric FROM plan")
def episode_quality_plan(t):
    return rounded(plan(t), "metric")


@query(f"WITH {PLAN}, kept AS (SELECT episode % 10 AS dataset, count(*) AS episodes, sum(CASE WHEN reason IS NULL THEN 1 ELSE 0 END)::BIGINT AS kept FROM plan GROUP BY 1) SELECT *, CASE WHEN kept < 5 THEN 'dataset_dropped' ELSE 'ok' END AS status FROM kept")
def dataset_survivors(t):
    return episodes.survivors(plan(t).withColumn("dataset", F.col("episode") % 10), "dataset", 5)


@query(f"WITH {PLAN} SELECT coalesce(reason, 'kept') AS outcome, count(*) AS n FROM plan GROUP BY 1")
def drop_totals(t):
    return plan(t).groupBy(F.coalesce("reason", F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


VECTORS = """flat AS (SELECT label, vec_id, i AS dim, embedding[i + 1]::DOUBLE AS x FROM embeddings, unnest(range(64)) AS u(i)),
moved AS (SELECT *, abs(x - lag(x) OVER (PARTITION BY label, dim ORDER BY vec_id)) AS delta, greatest({part} * (max(x) OVER (PARTITION BY label, dim) - min(x) OVER (PARTITION BY label, dim)), 1e-6) AS still FROM flat),
steps AS (SELECT label, vec_id, sum(delta) AS way, bool_and(delta < still) AS rests FROM moved WHERE delta IS NOT NULL GROUP BY label, vec_id)"""


def vector_tracks(t: Tables, part: float) -> DataFrame:
    return episodes.trajectories(t.embeddings.select("label", "vec_id", "embedding"), ["label"], "vec_id", Thresholds(still_part=part), "embedding")


@query(f"WITH {VECTORS.format(part=0.01)} SELECT label, round(sum(way), 6) AS travel FROM steps GROUP BY label")
def episode_travel_vector(t):
    return vector_tracks(t, 0.01).select("label", r6("travel").alias("travel"))


@query(f"WITH {VECTORS.format(part=0.8)} SELECT label, round(avg(CASE WHEN rests THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS idle FROM steps GROUP BY label")
def episode_idle_vector(t):
    return vector_tracks(t, 0.8).select("label", r6("idle").alias("idle"))


# Statistics -----------------------------------------------------------------------------

Q_SQL = ", ".join(f"round(quantile_cont({{x}}, {q}), 6) AS {n}" for n, q in stats.QUANTILES.items())


@query(f"SELECT event_type AS feature, {Q_SQL.format(x='value')} FROM events GROUP BY event_type")
def exact_quantiles(t):
    return rounded(stats.exact_quantiles(t.events.select(F.col("event_type").alias("feature"), F.col("value").alias("x")), ["feature"]), *stats.QUANTILES)


@query(f"WITH flat AS (SELECT i AS dim, embedding[i + 1]::DOUBLE AS x FROM embeddings, unnest(range(64)) AS u(i)) SELECT dim::INTEGER AS dim, {Q_SQL.format(x='x')} FROM flat GROUP BY dim")
def exact_quantiles_vector(t):
    return rounded(stats.exact_quantiles(stats.dimensions(t.embeddings, [], "embedding"), ["dim"]), *stats.QUANTILES)


MOMENTS = "min({x}) AS min, max({x}) AS max, round(avg({x}), 6) AS mean, round(stddev_pop({x}), 6) AS std, count({x}) AS count"


def user_moments(t: Tables) -> DataFrame:
    return stats.moments(t.events.select(F.col("user_id").alias("episode"), "event_type", "value"), ["episode", "event_type"], "value")


@query(f"SELECT user_id AS episode, event_type, {MOMENTS.format(x='value')} FROM events GROUP BY ALL")
def episode_feature_stats(t):
    return rounded(user_moments(t), "mean", "std")


@query(f"SELECT event_type, {MOMENTS.format(x='value')} FROM events GROUP BY event_type")
def parallel_variance(t):
    return rounded(stats.combined(user_moments(t), ["event_type"]), "mean", "std")


@query("""WITH per AS (SELECT user_id, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99, count(*) AS n FROM events GROUP BY user_id)
SELECT round(sum(q01 * n) / sum(n), 6) AS mean_q01, round(sum(q99 * n) / sum(n), 6) AS mean_q99, (SELECT round(quantile_cont(value, 0.01), 6) FROM events) AS q01, (SELECT round(quantile_cont(value, 0.99), 6) FROM events) AS q99 FROM per""")
def quantile_mean_bias(t):
    values = t.events.select("user_id", F.col("value").alias("x"))
    per = stats.exact_quantiles(values, ["user_id"]).join(values.groupBy("user_id").agg(F.count(F.lit(1)).alias("count")), "user_id")
    mean = stats.mean_of_quantiles(per, [], ["q01", "q99"]).select(r6("q01").alias("mean_q01"), r6("q99").alias("mean_q99"))
    return mean.join(F.broadcast(rounded(stats.exact_quantiles(values, []).select("q01", "q99"), "q01", "q99")))


@query("""WITH s AS (SELECT vec_id, embedding AS lo, list_transform(embedding, lambda x: x + 1) AS hi, embedding AS mean, list_transform(embedding, lambda x: abs(x)) AS std FROM embeddings)
SELECT vec_id, round(list_min(lo), 6) AS min, round(list_max(hi), 6) AS max, round(list_avg(list_transform(mean, lambda x: x::DOUBLE)), 6) AS mean,
round(sqrt(greatest(list_avg(list_transform(mean, lambda x: 2 * x::DOUBLE * x::DOUBLE)) - list_avg(list_transform(mean, lambda x: x::DOUBLE)) ** 2, 0)), 6) AS std, 1::INTEGER AS size FROM s""")
def shrink_stats(t):
    v = vectors.doubled(F.col("embedding"))
    one = stats.shrunk(F.col("embedding"), F.transform("embedding", lambda x: x + F.lit(1.0).cast("float")), v, F.transform(v, F.abs), most=63)
    found = t.embeddings.select("vec_id", *[c.alias(n) for n, c in one.items()])
    return found.select("vec_id", *[r6(F.col(n)[0].cast("float" if n in ("min", "max") else "double")).alias(n) for n in one], F.size("mean").alias("size"))


PLACED = f"{EPISODES}, placed AS (SELECT episode, length, sum(length) OVER (ORDER BY episode) AS to_index, sum(length) OVER (ORDER BY episode) - length AS from_index FROM episodes)"


def placed(t: Tables) -> DataFrame:
    return sequence.offsets(lengths(t).withColumn("dataset", F.lit(0)), ["dataset"], "episode")


@query(f"WITH {PLACED} SELECT episode, from_index::DOUBLE AS min, (to_index - 1)::DOUBLE AS max, (from_index + to_index - 1) / 2.0::DOUBLE AS mean, round(sqrt((length * length - 1) / 12.0::DOUBLE), 6) AS std, " + ", ".join(f"round(from_index::DOUBLE + {q}::DOUBLE * (length - 1), 6) AS {n}" for n, q in stats.QUANTILES.items()) + " FROM placed")
def analytic_index_stats(t):
    found = placed(t).select("episode", *[c.alias(n) for n, c in stats.index_stats(F.col("from_index"), F.col("length")).items()])
    return rounded(found, "std", *stats.QUANTILES)


@query("SELECT vec_id, len(embedding)::INTEGER AS size, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total FROM embeddings")
def deep_flatten(t):
    half = F.floor(F.size("embedding") / 2).cast("int")
    nested = F.array(F.array(F.slice("embedding", F.lit(1), half)), F.array(F.slice("embedding", half + 1, F.size("embedding") - half)))
    flat = t.embeddings.select("vec_id", vectors.flattened(nested, 3).alias("v"))
    return flat.select("vec_id", F.size("v").alias("size"), r6(vectors.total(F.col("v"))).alias("total"))


@query("""WITH s AS (SELECT p_partkey, 'size' AS feature, 'min' AS stat, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size::DOUBLE END AS value FROM part
UNION ALL SELECT p_partkey, 'size', 'max', p_size + 1.0 FROM part UNION ALL SELECT p_partkey, 'retail/price', 'mean', p_retailprice FROM part)
SELECT p_partkey, CASE WHEN feature = 'retail/price' THEN 'retail' ELSE feature END AS feature, CASE WHEN feature = 'retail/price' THEN 'price/mean' ELSE stat END AS stat, value FROM s WHERE value IS NOT NULL""")
def unflatten_stats(t):
    low = F.when(F.col("p_size") % 5 != 0, F.col("p_size").cast("double"))
    wide = t.part.select("p_partkey", low.alias("stats/size/min"), (F.col("p_size") + 1.0).cast("double").alias("stats/size/max"), F.col("p_retailprice").alias("stats/retail/price/mean"))
    return stats.unflattened(wide, ["p_partkey"])


@query("SELECT p_partkey, p_size::DOUBLE AS mean, p_size::BIGINT AS count FROM part")
def normalize_stats_types(t):
    parsed = t.part.select("p_partkey", F.parse_json(F.concat(F.lit('{"mean": '), "p_size", F.lit(', "count": '), "p_size", F.lit("}"))).alias("v"))
    return parsed.select("p_partkey", F.variant_get("v", "$.mean", "double").alias("mean"), F.variant_get("v", "$.count", "bigint").alias("count"))


OLD = "old AS (SELECT p_brand AS feature, quantile_cont(p_retailprice, 0.5) AS value FROM part WHERE p_partkey % 2 = 0 GROUP BY 1), new AS (SELECT p_brand AS feature, quantile_cont(p_retailprice, 0.5) AS value FROM part GROUP BY 1)"


@query(f"WITH {OLD} SELECT count(*) AS compared, round(max(abs(old.value - new.value)), 6) AS max_delta FROM old JOIN new USING (feature)")
def quantile_delta(t):
    median = F.percentile("p_retailprice", F.lit(0.5)).alias("value")
    new = t.part.groupBy(F.col("p_brand").alias("feature")).agg(median)
    old = t.part.filter("p_partkey % 2 = 0").groupBy(F.col("p_brand").alias("feature")).agg(median)
    return rounded(stats.largest_delta(old, new, ["feature"]), "max_delta")


HAS = "list_contains(list(DISTINCT p_size), 1) AND list_contains(list(DISTINCT p_size), 2) AND list_contains(list(DISTINCT p_size), 50)"


@query(f"SELECT p_brand, ({HAS}) AS present FROM part GROUP BY p_brand")
def quantiles_present(t):
    sizes = t.part.select("p_brand", "p_size").distinct().groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct(F.col("p_size"), F.lit(1)))).alias("m"))
    need = [F.map_contains_key("m", F.lit(k)) for k in (1, 2, 50)]
    return sizes.select("p_brand", (need[0] & need[1] & need[2]).alias("present"))


@query("WITH b AS (SELECT p_type, list(DISTINCT p_brand) AS has FROM part GROUP BY p_type) SELECT p_type, len(list_filter(['Brand#11', 'Brand#12', 'none'], lambda x: NOT list_contains(has, x)))::INTEGER AS missing FROM b")
def required_keys(t):
    has = t.part.groupBy("p_type").agg(F.collect_set("p_brand").alias("has"))
    return has.select("p_type", F.size(F.array_except(F.array(*map(F.lit, ("Brand#11", "Brand#12", "none"))), "has")).alias("missing"))


@query("SELECT p_partkey, 1.0::DOUBLE AS q50, p_retailprice AS mean, 3::INTEGER AS entries FROM part")
def merge_quantiles(t):
    old = F.create_map(F.lit("mean"), "p_retailprice", F.lit("q50"), F.col("p_size").cast("double"))
    new = F.create_map(F.lit("q50"), F.lit(1.0), F.lit("q99"), F.lit(2.0))
    m = t.part.select("p_partkey", stats.merged(old, new).alias("m"))
    return m.select("p_partkey", F.col("m")["q50"].alias("q50"), F.col("m")["mean"].alias("mean"), F.size("m").alias("entries"))


# Sequence -------------------------------------------------------------------------------


@query("SELECT o_custkey AS dataset, o_orderkey AS episode, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS new_index FROM orders")
def densify_episodes(t):
    return sequence.densified(t.orders.select(F.col("o_custkey").alias("dataset"), F.col("o_orderkey").alias("episode")), ["dataset"], "episode")


@query(f"WITH {PLACED} SELECT episode, length, from_index::BIGINT AS from_index, to_index::BIGINT AS to_index FROM placed")
def episode_offsets(t):
    return placed(t).select("episode", "length", "from_index", "to_index")


def indexed(t: Tables) -> DataFrame:
    turns = t.conversations.select(F.col("conv_id").alias("episode"), F.col("turn").alias("frame"), F.lit(0).alias("dataset"))
    return sequence.global_index(turns, ["dataset"], "episode", "frame")


INDEXED = 'indexed AS (SELECT conv_id AS episode, turn AS frame, row_number() OVER (ORDER BY conv_id, turn) - 1 AS "index" FROM conversations)'


@query(f'WITH {INDEXED} SELECT episode, frame, "index" FROM indexed')
def global_frame_index(t):
    return indexed(t).select("episode", "frame", "index")


@query(f'WITH {INDEXED}, off AS (SELECT episode, frame, "index" + CASE WHEN episode % 7 = 3 THEN 1 ELSE 0 END AS i FROM indexed), seen AS (SELECT episode, min(i) AS low, max(i) AS high, count(*) AS n FROM off GROUP BY episode), starts AS (SELECT *, sum(n) OVER (ORDER BY episode) - n AS start FROM seen) SELECT episode, (low <> start OR high <> start + n - 1) AS broken FROM starts')
def index_broken(t):
    odd = indexed(t).withColumn("index", F.col("index") + F.when(F.col("episode") % 7 == 3, 1).otherwise(0))
    return sequence.index_ranges(odd, ["dataset"], "episode", "index").select("episode", "broken")


@query(f'WITH {INDEXED}, ends AS (SELECT episode, min("index") AS low, max("index") AS high FROM indexed GROUP BY episode) SELECT episode, frame, "index" FROM indexed JOIN ends USING (episode) WHERE episode IN ((SELECT min(episode) FROM ends), (SELECT max(episode) FROM ends)) AND ("index" = low OR "index" = high)')
def boundary_frames(t):
    found = indexed(t)
    rows = sequence.offsets(found.groupBy("dataset", "episode").agg(F.count(F.lit(1)).alias("length")), ["dataset"], "episode")
    return sequence.boundary(found, rows, ["dataset"], "episode", "index").select("episode", "frame", "index")


SPANS = "spans AS (SELECT conv_id // 10 AS dataset, conv_id % 3 AS file, conv_id * 100 + turn AS episode, turn::DOUBLE AS from_ts, turn + length(text) / 8.0::DOUBLE AS to_ts FROM conversations)"


def spans(t: Tables) -> DataFrame:
    return t.conversations.select(F.expr("conv_id div 10").alias("dataset"), (F.col("conv_id") % 3).alias("file"), (F.col("conv_id") * 100 + F.col("turn")).alias("episode"), F.col("turn").cast("double").alias("from_ts"), (F.col("turn") + F.length("text") / F.lit(8.0)).alias("to_ts"))


@query(f"WITH {SPANS} SELECT dataset, episode, dense_rank() OVER (PARTITION BY dataset ORDER BY file) - 1 AS out_file, round(sum(to_ts - from_ts) OVER (PARTITION BY dataset, file ORDER BY from_ts, to_ts, episode) - (to_ts - from_ts), 6) AS out_from, round(sum(to_ts - from_ts) OVER (PARTITION BY dataset, file ORDER BY from_ts, to_ts, episode), 6) AS out_to FROM spans")
def video_placement(t):
    return rounded(sequence.placements(spans(t), ["dataset"], ["file"]).select("dataset", "episode", "out_file", "out_from", "out_to"), "out_from", "out_to")


@query("SELECT conv_id AS episode, count(*) AS frames, round((max(turn) - min(turn) + 1) / 30.0::DOUBLE, 6) AS span, abs((max(turn) - min(turn) + 1) - count(*)) < 0.5 AS consistent FROM conversations GROUP BY conv_id")
def span_consistency(t):
    seconds = (F.max("turn") - F.min("turn") + 1) / F.lit(30.0)
    found = t.conversations.groupBy(F.col("conv_id").alias("episode")).agg(F.count(F.lit(1)).alias("frames"), seconds.alias("span"))
    return found.select("episode", "frames", r6("span").alias("span"), (F.abs(F.col("span") * 30.0 - F.col("frames")) < 0.5).alias("consistent"))


@query(f"WITH {PLAN} SELECT e.event_id FROM events e JOIN plan p ON e.user_id = p.episode WHERE p.reason IS NULL")
def keep_semi(t):
    return t.events.withColumnRenamed("user_id", "episode").join(plan(t).filter("keep"), "episode", "left_semi").select("event_id")


@query("WITH k AS (SELECT user_id, epoch_us(ts) / 1000000.0::DOUBLE AS at FROM events WHERE event_id % 3 <> 0) SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.user_id = e.user_id AND abs(epoch_us(e.ts) / 1000000.0::DOUBLE - k.at) < 3600)")
def keyframe_violations(t):
    second = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    starts = t.events.select("event_id", "user_id", second.alias("start"))
    keys = t.events.filter("event_id % 3 <> 0").select("user_id", second.alias("at"))
    return sequence.within_band(starts, keys, ["user_id"], "start", "at", 3600.0, "left_anti").select("event_id")


# Reconciliation -------------------------------------------------------------------------

FOUND = "found AS (SELECT l_orderkey AS episode, count(*) AS n FROM lineitem GROUP BY 1), declared AS (SELECT o_orderkey AS episode, 1 + o_orderkey % 7 AS length FROM orders)"


def found_rows(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_orderkey").alias("episode")).agg(F.count(F.lit(1)).alias("n"))


def declared_rows(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("episode"), (F.col("o_orderkey") % 7 + 1).alias("length"))


@query(f"""WITH {FOUND}, v AS (SELECT episode, bool_and(n + CASE WHEN episode % 5 = 0 THEN 1 ELSE 0 END = n) AS agree FROM found WHERE episode % 4 <> 0 GROUP BY episode),
j AS (SELECT d.episode, d.length, coalesce(f.n, -1) AS n, v.agree FROM declared d LEFT JOIN found f USING (episode) LEFT JOIN v USING (episode)), o AS (SELECT *, CASE WHEN n = length THEN 'keep' WHEN n > 0 AND coalesce(agree, true) THEN 'repair' ELSE 'drop' END AS outcome FROM j)
SELECT episode, length, outcome, CASE WHEN outcome <> 'drop' THEN n END AS new_length FROM o""")
def reconcile_episodes(t):
    rows = found_rows(t)
    videos = rows.filter("episode % 4 <> 0").select("episode", F.lit("cam").alias("key"), (F.col("n") + F.when(F.col("episode") % 5 == 0, 1).otherwise(0)).alias("packets"))
    return reconcile.reconciled(declared_rows(t), rows, videos, ["episode"])


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orphan_files(t):
    return reconcile.orphans(t.orders.select("o_orderkey"), t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query(f"WITH {FOUND} SELECT episode FROM declared WHERE episode NOT IN (SELECT episode FROM found WHERE n > 2)")
def stats_gaps(t):
    return declared_rows(t).join(found_rows(t).filter("n > 2"), "episode", "left_anti").select("episode")


@query(f"WITH {FOUND} SELECT episode, coalesce(CASE WHEN f.n > 2 THEN f.n END, d.length) AS value FROM declared d FULL JOIN found f USING (episode)")
def stats_upsert(t):
    old = found_rows(t).filter("n > 2").withColumnRenamed("n", "value")
    return reconcile.upserted(old, declared_rows(t).withColumnRenamed("length", "value"), ["episode"], "value")


@query("WITH m AS (SELECT o_orderkey AS old, row_number() OVER (ORDER BY o_orderkey) - 1 AS new FROM orders WHERE o_orderkey % 3 <> 0) SELECT m.new AS episode, count(*) AS n, round(sum(l_quantity), 6) AS total FROM lineitem JOIN m ON l_orderkey = m.old GROUP BY m.new")
def renumber_stats(t):
    valid = sequence.densified(t.orders.filter("o_orderkey % 3 <> 0").select(F.lit(0).alias("dataset"), F.col("o_orderkey").alias("l_orderkey")), ["dataset"], "l_orderkey")
    return t.lineitem.join(valid, "l_orderkey").groupBy(F.col("new_index").alias("episode")).agg(F.count(F.lit(1)).alias("n"), r6(F.sum("l_quantity")).alias("total"))


@query("SELECT 'orders' AS file, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def footer_row_counts(t):
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("file"), "n")
    return count(t.orders, "orders").union(count(t.lineitem, "lineitem"))


@query("""WITH a AS (SELECT l_suppkey AS k, count(*) AS frames, sum(CASE WHEN l_quantity IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS present, count(DISTINCT l_orderkey) AS episodes FROM lineitem GROUP BY 1)
SELECT k, frames, present, episodes, frames = present AND present = episodes AS valid FROM a""")
def validate_counts(t):
    a = t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("frames"), F.count("l_quantity").alias("present"), F.countDistinct("l_orderkey").alias("episodes"))
    return a.withColumn("valid", reconcile.agree(F.col("frames"), F.col("present"), F.col("episodes")))


TOTALS = "d AS (SELECT o_custkey AS dataset, count(*) AS total_episodes, sum(1 + o_orderkey % 7)::BIGINT AS total_frames FROM orders GROUP BY 1), a AS (SELECT o_custkey AS dataset, count(DISTINCT o_orderkey) AS total_episodes, count(l_orderkey) AS total_frames FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)"


def totals(t: Tables) -> tuple[DataFrame, DataFrame]:
    declared = t.orders.groupBy(F.col("o_custkey").alias("dataset")).agg(F.count(F.lit(1)).alias("total_episodes"), F.sum(F.col("o_orderkey") % 7 + 1).alias("total_frames"))
    rows = t.orders.select(F.col("o_custkey").alias("dataset"), F.col("o_orderkey").alias("episode")).join(found_rows(t), "episode", "left")
    actual = rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("total_episodes"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_frames"))
    return declared, actual


FIXES = f"{TOTALS}, fixes AS (SELECT dataset, 'total_frames' AS field, d.total_frames::VARCHAR AS was, a.total_frames::VARCHAR AS now FROM d JOIN a USING (dataset) WHERE d.total_frames IS DISTINCT FROM a.total_frames)"


@query(f"WITH {FIXES} SELECT * FROM fixes")
def aggregate_corrections(t):
    return reconcile.corrections(*totals(t), ["dataset"], ["total_episodes", "total_frames"])


@query(f"WITH {FIXES} SELECT dataset, '`' || field || '` ' || was || ' -> ' || now AS notes FROM fixes")
def card_corrections(t):
    rows = reconcile.corrections(*totals(t), ["dataset"], ["total_episodes", "total_frames"])
    return report.correction_notes(rows.withColumn("place", F.lit(1)))


@query(f"WITH {TOTALS} SELECT dataset, total_episodes, total_frames, total_episodes * 2 AS total_videos, '0:' || total_episodes AS train FROM a")
def recompute_totals(t):
    return totals(t)[1].withColumn("total_videos", F.col("total_episodes") * 2).withColumn("train", F.concat(F.lit("0:"), "total_episodes"))


# Schemas --------------------------------------------------------------------------------


@query("SELECT p_brand AS dataset, p_type AS key, count(*) AS n FROM part WHERE CASE p_size % 4 WHEN 0 THEN 'string' WHEN 1 THEN 'float32' WHEN 2 THEN 'list' ELSE 'video' END IN ('string', 'list', 'dict') GROUP BY ALL")
def unsupported_features(t):
    kind = F.element_at(F.array(*map(F.lit, ("string", "float32", "list", "video"))), F.col("p_size") % 4 + 1)
    return t.part.select(F.col("p_brand").alias("dataset"), F.col("p_type").alias("key"), kind.alias("dtype")).filter(F.col("dtype").isin(*schema.UNSUPPORTED)).groupBy("dataset", "key").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, s_acctbal FROM supplier")
def declared_projection(t):
    return schema.declared(t.supplier, {"s_suppkey": "int64", "s_acctbal": "float64", "s_name": "video"})


@query("SELECT s_suppkey, s_acctbal AS value FROM supplier")
def unwrap_singletons(t):
    return t.supplier.select("s_suppkey", F.array("s_acctbal").alias("v")).select("s_suppkey", vectors.unwrapped(F.col("v")).alias("value"))


@query("SELECT user_id AS dataset, event_type AS key, count(*) AS n_files FROM events GROUP BY ALL HAVING count(*) < 12")
def hollow_cameras(t):
    files = t.events.select(F.col("user_id").alias("dataset"), F.col("event_type").alias("key"))
    return schema.hollow_cameras(files.distinct().withColumn("dtype", F.lit("video")), files, files.select("dataset").distinct().withColumn("total_episodes", F.lit(12)), ["dataset"])


PART_MAP = "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL"


def stats_maps(t: Tables) -> DataFrame:
    per = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("p_brand").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("p_type", "n")))).alias("stats"))


@query(f"SELECT p_brand, p_type AS key, n FROM ({PART_MAP}) WHERE p_type < 'M'")
def prune_stats(t):
    keys = t.part.filter("p_type < 'M'").agg(F.collect_set("p_type").alias("keys"))
    kept = stats_maps(t).join(F.broadcast(keys)).withColumn("stats", schema.pruned(F.col("stats"), F.col("keys")))
    return kept.select("p_brand", F.explode("stats").alias("key", "n"))


@query("WITH keys AS (SELECT DISTINCT s_nationkey AS dataset, 'observation.images.' || (s_suppkey % 4) AS key FROM supplier UNION SELECT DISTINCT s_nationkey, 'observation.' || (s_suppkey % 2) FROM supplier) SELECT dataset, replace(key, 'images.', '') AS old, key AS new FROM keys k WHERE key LIKE 'observation.images.%' AND NOT EXISTS (SELECT 1 FROM keys f WHERE f.dataset = k.dataset AND f.key = replace(k.key, 'images.', ''))")
def flat_key_repairs(t):
    s = t.supplier
    images = s.select(F.col("s_nationkey").alias("dataset"), F.concat(F.lit(schema.IMAGES), F.col("s_suppkey") % 4).alias("key"))
    flat = s.select(F.col("s_nationkey").alias("dataset"), F.concat(F.lit("observation."), F.col("s_suppkey") % 2).alias("key"))
    return schema.flat_keys(images.union(flat).distinct(), ["dataset"])


@query(f"SELECT p_brand, CASE WHEN p_type = (SELECT min(p_type) FROM part) THEN 'first' ELSE p_type END AS key, n FROM ({PART_MAP})")
def rekey_stats(t):
    repairs = t.part.agg(F.create_map(F.min("p_type"), F.lit("first")).alias("repairs"))
    return stats_maps(t).join(F.broadcast(repairs)).select("p_brand", F.explode(schema.rekeyed(F.col("stats"), F.col("repairs"))).alias("key", "n"))


@query("WITH a AS (SELECT r_name AS old, row_number() OVER (ORDER BY r_name) AS i FROM region), b AS (SELECT event_type AS new, row_number() OVER (ORDER BY event_type) AS i FROM (SELECT DISTINCT event_type FROM events)) SELECT old, new FROM a JOIN b USING (i) WHERE (SELECT count(*) FROM a) = (SELECT count(*) FROM b)")
def positional_rekey(t):
    one = F.lit(0).alias("dataset")
    return schema.positional_keys(t.region.select(one, F.col("r_name").alias("key")), t.events.select(one, F.col("event_type").alias("key")).distinct(), ["dataset"]).drop("dataset")


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def promote_union(t):
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), allowMissingColumns=True)


# Collection and report ------------------------------------------------------------------

DATASETS = "datasets AS (SELECT n_name || '/' || c_name AS name, CASE c_mktsegment WHEN 'BUILDING' THEN 'v2.0' WHEN 'MACHINERY' THEN 'v2.1' WHEN 'AUTOMOBILE' THEN 'v3.0' ELSE '?' END AS version, c_custkey % 50 AS episodes, c_custkey % 1000 AS frames, c_custkey * 1000 AS size_bytes FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def datasets(t: Tables) -> DataFrame:
    version = F.when(F.col("c_mktsegment") == "BUILDING", "v2.0").when(F.col("c_mktsegment") == "MACHINERY", "v2.1").when(F.col("c_mktsegment") == "AUTOMOBILE", "v3.0").otherwise("?")
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(F.concat_ws("/", "n_name", "c_name").alias("name"), version.alias("version"), (F.col("c_custkey") % 50).alias("episodes"), (F.col("c_custkey") % 1000).alias("frames"), (F.col("c_custkey") * 1000).alias("size_bytes"))


@query(f"WITH {DATASETS} SELECT * FROM datasets")
def collection_scan(t):
    return datasets(t)


SUMS = "sum(episodes)::BIGINT AS episodes, sum(frames)::BIGINT AS frames, sum(size_bytes)::BIGINT AS size_bytes"


@query(f"WITH {DATASETS} SELECT version, count(*) AS datasets, {SUMS}, version IN ('v2.0', 'v2.1') AS supported FROM datasets GROUP BY version")
def census_by_version(t):
    return report.by_version(datasets(t))


@query(f"WITH {DATASETS}, v AS (SELECT version, count(*) AS n FROM datasets GROUP BY version) SELECT count(*) AS datasets, {SUMS}, (SELECT string_agg(n || 'x ' || version, ', ' ORDER BY version) FROM v) AS versions FROM datasets")
def tree_census(t):
    return report.census(datasets(t))


@query("SELECT c_nationkey AS name, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1")
def duplicate_dataset_check(t):
    return collection.duplicates(t.customer.select(F.col("c_nationkey").alias("name"), F.col("c_custkey").alias("root"))).withColumnRenamed("roots", "n")


@query("SELECT source AS name, sum(octet_length(encode(text)))::BIGINT AS size_bytes FROM documents GROUP BY source")
def census_size(t):
    return collection.total_sizes(t.documents.select(F.col("source").alias("name"), F.octet_length("text").alias("length")))


@query(f"WITH {DATASETS}, done AS (SELECT name FROM datasets WHERE version = 'v3.0' AND episodes % 2 = 0) SELECT name, version, CASE WHEN name IN (SELECT name FROM done) THEN 'skipped' WHEN version NOT IN ('v2.0', 'v2.1') THEN 'unsupported' ELSE 'todo' END AS route FROM datasets")
def route_datasets(t):
    d = datasets(t)
    return report.routed(d.select("name", "version"), d.filter("episodes % 2 = 0"))


@query(f"WITH {DATASETS} SELECT CASE WHEN version IN ('v2.0', 'v2.1') THEN 'converted' ELSE 'unsupported' END AS status, count(*) AS n FROM datasets GROUP BY 1")
def outcomes_by_status(t):
    return datasets(t).groupBy(F.when(F.col("version").isin(*report.SUPPORTED), "converted").otherwise("unsupported").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT s_suppkey FROM supplier)")
def subset_semi(t):
    return collection.wanted(t.customer, t.supplier.select(F.col("s_suppkey").alias("c_custkey")), "c_custkey")[0].select("c_custkey", "c_name")


@query("SELECT o_orderkey AS wanted FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)")
def subset_unknown_anti(t):
    return collection.wanted(t.customer.select(F.col("c_custkey").alias("wanted")), t.orders.select(F.col("o_orderkey").alias("wanted")), "wanted")[1]


@query("SELECT user_id AS dataset, max(event_id) AS position, arg_max(event_type, event_id) AS status, arg_max(round(value, 6), event_id) AS seconds FROM events GROUP BY user_id")
def manifest_last_wins(t):
    log = t.events.select(F.col("user_id").alias("dataset"), F.col("event_id").alias("position"), F.col("event_type").alias("status"), r6("value").alias("seconds"))
    return reconcile.last_wins(log, ["dataset"], "position")


@query(f"WITH {DATASETS} SELECT version, min(name) AS example FROM datasets GROUP BY version")
def example_name(t):
    return datasets(t).groupBy("version").agg(F.min("name").alias("example"))


@query("SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey % 5 = 0")
def set_except(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).subtract(t.supplier.filter("s_suppkey % 5 = 0").select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).intersect(t.supplier.select("s_nationkey"))


@query("SELECT o_orderkey AS episode, o_orderkey // 1000 AS chunk, printf('data/chunk-%03d/episode_%06d.parquet', o_orderkey // 1000, o_orderkey) AS path FROM orders")
def episode_chunking(t):
    chunk = F.expr("o_orderkey div 1000")
    return t.orders.select(F.col("o_orderkey").alias("episode"), chunk.alias("chunk"), F.format_string("data/chunk-%03d/episode_%06d.parquet", chunk, F.col("o_orderkey")).alias("path"))


@query("WITH files AS (SELECT l_orderkey AS episode, l_linenumber % 3 AS chunk, min(l_partkey) AS path FROM lineitem GROUP BY ALL) SELECT o_orderkey AS episode, coalesce(min(CASE WHEN chunk = o_orderkey % 3 THEN path END), min(path)) AS path FROM orders LEFT JOIN files ON o_orderkey = episode GROUP BY o_orderkey")
def resolve_chunk_fallback(t):
    one = (F.lit("x").alias("name"), F.lit("data").alias("kind"))
    files = t.lineitem.groupBy(F.col("l_orderkey").alias("episode"), (F.col("l_linenumber") % 3).alias("chunk")).agg(F.min("l_partkey").alias("path")).select(*one, "episode", "chunk", "path")
    wanted = t.orders.select(*one, F.col("o_orderkey").alias("episode"), (F.col("o_orderkey") % 3).alias("chunk")).distinct()
    return collection.resolved(wanted, files).select("episode", "path")


@query("SELECT event_id FROM events WHERE event_type IN (SELECT event_type FROM events WHERE event_id % 100 = 0)")
def stage_allowlist(t):
    return t.events.join(t.events.filter("event_id % 100 = 0").select("event_type"), "event_type", "left_semi").select("event_id")


MANIFEST = "manifest AS (SELECT doc_id AS dataset, CASE doc_id % 4 WHEN 0 THEN 'failed' WHEN 1 THEN 'unsupported' ELSE 'converted' END AS status, CASE WHEN doc_id % 3 > 0 THEN lang END AS source_version, CASE WHEN doc_id % 8 = 0 THEN text END AS error FROM documents)"


def manifest(t: Tables) -> DataFrame:
    status = F.when(F.col("doc_id") % 4 == 0, "failed").when(F.col("doc_id") % 4 == 1, "unsupported").otherwise("converted")
    return t.documents.select(F.col("doc_id").alias("dataset"), status.alias("status"), F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("source_version"), F.when(F.col("doc_id") % 8 == 0, F.col("text")).alias("error"))


@query(f"WITH {MANIFEST} SELECT dataset, coalesce(source_version, '?') AS version, substr(replace(coalesce(error, status), '|', '\\|'), 1, 160) AS reason FROM manifest WHERE status IN ('failed', 'unsupported')")
def card_exclusions(t):
    return report.exclusions(manifest(t))


@query("SELECT doc_id, substr(replace(text, '|', '\\|'), 1, 160) AS cell FROM documents")
def escape_truncate(t):
    return t.documents.select("doc_id", report.cell(F.col("text")).alias("cell"))


@query("SELECT doc_id AS dataset, CASE WHEN doc_id % 2 = 0 THEN 'converted' ELSE 'failed' END AS status FROM documents")
def manifest_append(t):
    """Two runs append to one log, of which the last line of each dataset holds."""
    path = f"{t.spark.conf.get('spark.sql.warehouse.dir')}/tracewright-manifest-{uuid.uuid4().hex}"
    atexit.register(sinks.drop_tree, path)
    log = t.documents.select(F.col("doc_id").alias("dataset"))
    collection.append_manifest(log.withColumn("status", F.lit("failed")), path)
    collection.append_manifest(log.filter("dataset % 2 = 0").withColumn("status", F.lit("converted")), path)
    lines = t.spark.read.schema("dataset bigint, status string, position struct<batch:bigint,row:bigint>").json(path)
    return reconcile.last_wins(lines, ["dataset"], "position").select("dataset", "status")


@query("SELECT user_id AS episode, bool_or(event_id % 97 = 0) AS nonfinite FROM events GROUP BY user_id")
def nonfinite_state(t):
    """Actions are finite; NaN stands in the state alone."""
    state = F.array(F.lit(0.0), F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    rows = t.events.select(F.col("user_id").alias("episode"), "ts", F.array("value").alias("action"), state.alias("state"))
    return episodes.trajectories(rows, ["episode"], "ts", T, also=("state",)).select("episode", (~F.col("finite")).alias("nonfinite"))


@query("SELECT event_type, round(stddev_pop(value), 4) AS std, count(value) AS count FROM events GROUP BY event_type")
def parallel_variance_large_mean(t):
    """Values far from zero keep their spread."""
    rows = t.events.select(F.col("user_id").alias("episode"), "event_type", (F.col("value") + 1e9).alias("value"))
    found = stats.combined(stats.moments(rows, ["episode", "event_type"], "value"), ["event_type"])
    return found.select("event_type", F.round("std", 4).alias("std"), "count")


@query("SELECT user_id AS dataset, '`total_frames` ' || user_id || ' → ' || count(*) || CASE WHEN user_id % 2 = 0 THEN '; repaired 2 declared episode length(s)' ELSE '' END AS notes FROM events GROUP BY user_id")
def manifest_notes(t):
    n = t.events.groupBy(F.col("user_id").alias("dataset")).agg(F.count(F.lit(1)).cast("string").alias("n"))
    change = F.struct(F.col("dataset").cast("string").alias("from"), F.col("n").alias("to"))
    fixes = F.struct(F.create_map(F.lit("total_frames"), change).alias("aggregates"), F.array().cast("array<bigint>").alias("dropped_corrupt_episodes"), F.when(F.col("dataset") % 2 == 0, 2).otherwise(0).cast("long").alias("repaired_episode_lengths"))
    log = n.select("dataset", F.lit("converted").alias("status"), fixes.alias("corrections"), F.lit(None).cast("array<string>").alias("dropped_features"), F.lit(None).cast("string").alias("note"))
    return report.manifest_notes(log)


@query("SELECT o_orderkey AS episode, printf('%.1f GB', o_orderkey * 12345678 / 1e9::DOUBLE) AS size, format('{:,}', o_orderkey * 12345) AS frames FROM orders")
def card_numbers(t):
    return t.orders.select(F.col("o_orderkey").alias("episode"), report.gigabytes(F.col("o_orderkey") * 12345678).alias("size"), report.grouped_number(F.col("o_orderkey") * 12345).alias("frames"))


@query(f"WITH {DATASETS}, s AS (SELECT count(*) AS datasets, {SUMS} FROM datasets), c AS (SELECT count(*) AS datasets, {SUMS} FROM datasets WHERE version = 'v3.0') SELECT s.datasets AS source_datasets, c.datasets AS target_datasets, s.frames AS source_frames, c.frames AS target_frames, s.size_bytes > 1.2 * c.size_bytes AS shrank FROM s, c")
def card_statistics(t):
    d = datasets(t)
    a, b = report.census(d), report.census(d.filter("version = 'v3.0'"))
    both = a.select(*[F.col(c).alias(f"source_{c}") for c in a.columns]).join(b.select(*[F.col(c).alias(f"target_{c}") for c in b.columns]))
    return both.select("source_datasets", "target_datasets", "source_frames", "target_frames", (F.col("source_size_bytes") > F.lit(1.2) * F.col("target_size_bytes")).alias("shrank"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '([0-9]+)[^0-9/]*[^/]*/?$', 1) AS number FROM pages")
def path_parse(t):
    return t.pages.select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.regexp_extract("url", "([0-9]+)[^0-9/]*[^/]*/?$", 1).alias("number"))


@query("SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS bare FROM pages")
def strip_prefix(t):
    return t.pages.select("page_id", F.regexp_replace("url", "^https://", "").alias("bare"))


@query("SELECT doc_id, round(n_chars / 1000.0::DOUBLE, 6) AS kilobytes FROM documents")
def human_sizes(t):
    return t.documents.select("doc_id", r6(F.col("n_chars") / F.lit(1000.0)).alias("kilobytes"))

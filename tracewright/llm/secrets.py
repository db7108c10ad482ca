"""Secret scans: three fixed patterns, and a battery of randomness tests for the rest.

The fixed patterns (assign, access, hex) give the base spans. Beyond them, every run of
20 or more key-like characters that is not one of these spans is read as decimal, hex (also
in groups between dashes), base32, base36 (of either case), base62 or base64, whichever is
the narrowest alphabet that holds it, and tested for symbols that are independent and
uniform: chi-squared over equal cells of the alphabet, Wald-Wolfowitz runs about its middle,
and lag-1 serial correlation. Fisher's method joins the three p-values.

The hypothesis that a report rejects is the opposite one, that a run is an ordinary name or
run of words. How random such runs look is known from a background of ordinary names, which
goes through the same battery. Of each stratum, a class of lengths with letters alone kept
apart (short strings and words can hardly be told from random ones, long ones easily), a
run's p-value is the share of the background that looks at least as random, and Benjamini
and Hochberg's procedure over the table's runs of that stratum reports the most random ones
as spans of kind ``random``, as many as keep the expected share of ordinary runs among those
reported within ``rate``; the number of ordinary runs is estimated from the p-values over one
half (Storey). No fixed threshold decides, and length alone neither reports nor
rejects. The rate holds as far as ordinary runs resemble the background.

All of it is column expressions. Positions follow from the lengths of the pieces between
matches, and are summed in blocks of about the square root of their number, so a text of very
many matches costs the power 1.5 of them. The only statistic of the whole table is a
histogram of p-values with a fixed number of bins, from which one number a stratum comes back.

Null text counts as empty. Very long texts are read as a whole. Repeated rows give equal rows,
an empty table none. Extra columns, also those named like something in here, are ignored by
``find_secrets`` and kept by ``masked``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.llm._shared import store, table

KINDS = ("assign", "access", "hex", "random")
#: Fixed values of the contract.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
# Letters are spelt out in both cases, so that no other characters fold into them.
ASSIGN = "(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k) for k in KEYWORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the same as runs of AKIA[A-Z0-9]+ of 18 or more
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12

RUN = "A-Za-z0-9+/_-"
#: Runs of key-like characters; an assignment is consumed with its value, which then is no run of its own.
CANDIDATE = ASSIGN.removesuffix("+)") + f"{{{LEAST_VALUE},}})|[{RUN}]{{20,}}"
#: What one of the fixed patterns takes as a whole: an assignment, an access key, lower-case hex.
TAKEN = rf"[^{RUN}]|^{ACCESS}$|^[0-9a-f]+$"
#: Letters from the rarest to the commonest: in this order, cells and halves of an alphabet tell words with digits from random strings.
BY_USE = "zqxjkvbpygfwmucldrhsnioate"
#: Alphabet, cells of the chi-squared test: cells divide the alphabet evenly.
ENCODINGS = {
    "decimal": ("0123456789", 5, r"^[0-9]+$"),
    "hex": ("0123456789abcdef", 8, r"^([0-9a-f]+|[0-9A-F]+)$"),
    "dashed hex": ("0123456789abcdef", 8, r"^(?=.*[A-Fa-f])([0-9a-f]+(-[0-9a-f]+)+|[0-9A-F]+(-[0-9A-F]+)+)$"),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 8, r"^[A-Z2-7]+$"),
    "lower base32": ("234567" + BY_USE, 8, r"^[a-z2-7]+$"),
    "base36": ("0123456789" + BY_USE, 6, r"^([0-9a-z]+|[0-9A-Z]+)$"),
    "base62": (BY_USE[::-1] + BY_USE.upper() + "0123456789", 31, r"^[A-Za-z0-9]+$"),
    "base64": ("+/" + BY_USE[::-1] + BY_USE.upper() + "0123456789", 8, r"^.*$"),
}
#: Letters alone, with a small letter among them, are set apart; capitals alone are base32.
WORDS = r"^(?=.*[a-z])[A-Za-z]+$"
FALSE_DISCOVERIES = 0.05
#: Where classes of length begin; a stratum is a class, and as many again for letters alone.
CLASSES = (20, 24, 32, 48, 96)
STRATA = 2 * len(CLASSES)
BINS_PER_DECADE, BINS = 50, 300
#: Ordinary names in the background of each stratum, and what they are made of.
BACKGROUND = 500
ORDINARY = "the section report chapter user final version image photo data model train step node server build release page index result value account order price street number group local public music market paper point river winter table light company country history question problem service member family school student teacher morning".split()
#: The rational Chebyshev fit to the complementary error function, error below 1.2e-7 everywhere.
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed, and stands in the plan, once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(items: Column, measure, combine, zero: Column) -> Column:
    """array<struct<before, x>>: each item with what ``combine`` makes of the measures of all items before it.

    Two levels of blocks, as an array that grows item by item would be copied as often.
    """

    def whole(all_: Column, size: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / size).cast("int")), lambda i: F.slice(all_, i * size + 1, size))
        return let(blocks, lambda bs: F.flatten(F.zip_with(bs, totals(bs), inside)))

    def grown(begin: Column, members: Column, taken, none: Column) -> Column:
        start = F.struct(begin.alias("at"), none.alias("out"))
        return F.aggregate(members, start, lambda acc, x: F.struct(combine(acc["at"], measure(x)).alias("at"), F.concat(acc["out"], F.array(taken(acc["at"], x))).alias("out")), lambda acc: acc["out"])

    def totals(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda acc, x: combine(acc, measure(x))))
        start = F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out"))
        return F.aggregate(sums, start, lambda acc, x: F.struct(combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def inside(block: Column, begin: Column) -> Column:
        pair = lambda at, x: F.struct(at.alias("before"), x.alias("x"))
        return grown(begin, block, pair, F.slice(F.transform(block, lambda x: pair(zero, x)), 1, 0))

    return let(items, lambda all_: let(F.greatest(F.ceil(F.sqrt(F.size(all_).cast("double"))), F.lit(1)).cast("int"), lambda size: whole(all_, size)))


def located(text: Column, hits: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of the matches ``hits`` of ``pattern``: code points, end exclusive."""
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    both = F.zip_with(pieces, hits, lambda p, h: F.struct(F.length(p).alias("skip"), F.length(h).alias("size"), h.alias("hit")))
    placed = running(both, lambda x: x["skip"] + x["size"], lambda a, b: a + b, F.lit(0))
    found = F.transform(placed, lambda s: F.struct((s["before"] + s["x"]["skip"]).alias("start"), (s["before"] + s["x"]["skip"] + s["x"]["size"]).alias("end"), s["x"]["hit"].alias("hit")))
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast("array<struct<start:int,end:int,hit:string>>"))


def upper_tail(z: Column) -> Column:
    """P(normal > z)."""

    def half(v: Column, t: Column) -> Column:
        poly = reduce(lambda acc, c: acc * t + F.lit(c), reversed(ERFC[:-1]), F.lit(ERFC[-1]))
        tail = t * F.exp(-v * v / 2 + poly) / 2
        return let(tail, lambda x: F.when(v >= 0, x).otherwise(F.lit(1.0) - x))

    return let(z, lambda v: let(F.lit(1.0) / (F.lit(1.0) + F.abs(v) / F.lit(8**0.5)), lambda t: half(v, t)))


def log_tail(z: Column, sides: int) -> Column:
    return F.log(F.greatest(upper_tail(z) * sides, F.lit(1e-300)))


def uniformity(places: Column, k: Column, cells: Column, n: Column) -> Column:
    """z of chi-squared over equal cells: the cube root of chi-squared over its degrees of freedom is nearly normal (Wilson and Hilferty)."""
    counts = F.transform(F.sequence(F.lit(0), cells - 1), lambda c: F.size(F.filter(places, lambda v: F.floor(v * cells / k) == c)).cast("double"))
    chi = F.aggregate(counts, F.lit(0.0), lambda acc, o: acc + o * o) * cells / n - n
    df = cells - F.lit(1.0)
    part = F.lit(2.0) / (F.lit(9.0) * df)
    return (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1.0 / 3)) - (F.lit(1.0) - part)) / F.sqrt(part)


def runs(places: Column, k: Column, n: Column) -> Column:
    """abs(z) of the number of runs above and below the alphabet's middle."""
    turns = F.size(F.filter(F.arrays_zip(F.slice(places, 1, F.size(places) - 1).alias("a"), F.slice(places, 2, F.size(places) - 1).alias("b")), lambda s: (s["a"] * 2 >= k) != (s["b"] * 2 >= k)))
    high = F.size(F.filter(places, lambda v: v * 2 >= k)).cast("double")

    def score(usual: Column) -> Column:
        return let((usual - 1) * (usual - 2) / (n - 1), lambda spread: F.when(spread > 0, F.abs(turns + F.lit(1.0) - usual) / F.sqrt(spread)).otherwise(F.lit(40.0)))

    return let(high, lambda h: let(F.lit(2.0) * h * (n - h) / n + 1, score))


def serial(places: Column, n: Column) -> Column:
    """abs(z) of the lag-1 serial correlation."""
    start = F.struct(F.lit(0.0).alias("whole"), F.lit(0.0).alias("lagged"), F.lit(0.0).alias("last"))

    def around(mean: Column) -> Column:
        def step(acc: Column, v: Column) -> Column:
            return let(v - mean, lambda d: F.struct((acc["whole"] + d * d).alias("whole"), (acc["lagged"] + acc["last"] * d).alias("lagged"), d.alias("last")))

        return let(F.aggregate(places, start, step), lambda s: F.when(s["whole"] > 0, F.abs(s["lagged"] / s["whole"] + F.lit(1.0) / n) * F.sqrt(n)).otherwise(F.lit(40.0)))

    return let(F.aggregate(places, F.lit(0.0), lambda acc, v: acc + v) / n, around)


def joint_p(places: Column, k: Column, cells: Column) -> Column:
    """Fisher's joint p-value of the three tests on ``places``, the symbols' numbers from 0 to k - 1."""
    n = F.size(places).cast("double")
    logs = let(n, lambda m: log_tail(uniformity(places, k, cells, m), 1) + log_tail(runs(places, k, m), 2) + log_tail(serial(places, m), 2))
    return let(-logs, lambda h: F.exp(-h) * (F.lit(1.0) + h + h * h / 2))


def randomness(hit: Column) -> Column:
    """The joint p-value of a candidate under the narrowest encoding that holds it."""

    def chosen(of) -> Column:
        out = None
        for name, (_, _, shape) in ENCODINGS.items():
            out = F.when(hit.rlike(shape), of(name)) if out is None else out.when(hit.rlike(shape), of(name)) if name != "base64" else out.otherwise(of(name))
        return out

    def read(name: str) -> Column:
        alphabet, cells, _ = ENCODINGS[name]
        source = F.lower(hit) if name in ("hex", "base36") else F.lower(F.translate(hit, "-", "")) if name == "dashed hex" else F.translate(hit, "-_", "+/") if name == "base64" else hit
        return F.struct(source.alias("source"), F.lit(alphabet).alias("alphabet"), F.lit(len(alphabet)).alias("k"), F.lit(cells).alias("cells"))

    def tested(e: Column) -> Column:
        places = F.transform(F.filter(F.split(e["source"], ""), lambda c: c != ""), lambda c: F.instr(e["alphabet"], c) - 1)
        return let(places, lambda v: joint_p(v, e["k"], e["cells"]))

    return let(chosen(read), tested)


def stratum(hit: Column) -> Column:
    size = F.length(hit)
    longer = sum((F.when(size >= n, 1).otherwise(0) for n in CLASSES[1:]), F.lit(0))
    return (longer + F.when(hit.rlike(WORDS), len(CLASSES)).otherwise(0)).cast("int")


def p_bin(p: Column) -> Column:
    """The bin of a joint p-value: 0 holds the largest, BINS all under 10 ** (-BINS / BINS_PER_DECADE)."""
    return F.least(F.floor(-F.log10(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-300))) * BINS_PER_DECADE), F.lit(BINS)).cast("int")


def scan(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """_0, _1 ... (``keep``), base (array of struct start, kind, end) and candidates (array of struct start, end, stratum, bin) of each text."""
    kept = [f"_{i}" for i in range(len(keep))]
    found = docs.select(*[c.alias(k) for c, k in zip(keep, kept, strict=True)], F.coalesce(docs["text"], F.lit("")).alias("text"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("candidate", CANDIDATE)):
        found = found.withColumn(name, F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(0)))
    span = lambda kind: lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"))
    assign = F.filter(located(F.col("text"), F.col("assign"), ASSIGN), lambda x: F.length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= LEAST_VALUE)
    base = F.array_sort(F.concat(F.transform(assign, span("assign")), F.transform(located(F.col("text"), F.col("access"), ACCESS), span("access")), F.transform(located(F.col("text"), F.col("hex"), HEX), span("hex"))))
    runs_ = F.filter(located(F.col("text"), F.col("candidate"), CANDIDATE), lambda x: ~x["hit"].rlike(TAKEN))
    tested = F.transform(runs_, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), stratum(x["hit"]).alias("stratum"), p_bin(randomness(x["hit"])).alias("bin")))
    return found.select(*kept, base.alias("base"), tested.alias("candidates"))


def background(spark: SparkSession, size: int = BACKGROUND) -> DataFrame:
    """Ordinary names, ``size`` of each stratum: words, most joined by a mark, some capitalised or bare, and numbers between them; hit and stratum."""
    words, parts_ = F.array(*map(F.lit, ORDINARY)), 60
    # Spark deals a range evenly whatever the session's default; a few thousand short strings are one task's work.
    rows = spark.range(0, STRATA * size, 1, 8).withColumn("stratum", (F.col("id") % STRATA).cast("int"))
    draw = lambda *salt: F.abs(F.xxhash64("id", *map(F.lit, salt)) % 1_000_003)
    drawn = lambda i, what: F.abs(F.xxhash64(F.col("id"), i, F.lit(what)) % 1_000_003)
    style, alone = draw("style") % 10, F.col("stratum") >= len(CLASSES)

    def part(i: Column) -> Column:
        word = F.element_at(words, (drawn(i, "word") % len(ORDINARY) + 1).cast("int"))
        cased = F.when(style.isin(1, 2), F.initcap(word)).otherwise(word)
        mark = F.when(alone | (i == 0), "").otherwise(F.element_at(F.array(*map(F.lit, ("", "", "", "-", "_", "/", "-", "_", "/", "/"))), (style + 1).cast("int")))
        number = F.when(~alone & (drawn(i, "has") % 2 == 0), (drawn(i, "number") % F.when(drawn(i, "wide") % 4 == 0, 2030).otherwise(100)).cast("string")).otherwise("")
        return F.concat(mark, cased, number)

    begins = F.array(*map(F.lit, CLASSES))
    begin = F.element_at(begins, F.col("stratum") % len(CLASSES) + 1)
    end = F.coalesce(F.try_element_at(begins, F.col("stratum") % len(CLASSES) + 2), F.lit(128))
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(parts_)), part), "")
    cut = rows.select("stratum", F.substring(text, F.lit(1), (begin + draw("size") % (end - begin)).cast("int")).alias("hit"))
    # A name without a number or mark so far ends in one, as it would be letters alone.
    bare = (F.col("stratum") < len(CLASSES)) & F.col("hit").rlike(WORDS)
    return cut.withColumn("hit", F.when(bare, F.concat(F.expr("left(hit, length(hit) - 1)"), F.lit("7"))).otherwise(F.col("hit")))


def reported_bins(found: DataFrame, rate: float) -> list[int]:
    """Of each stratum, the last bin whose candidates Benjamini and Hochberg's procedure reports; -1 if there is none."""
    ordinary = background(found.sparkSession).select("stratum", p_bin(randomness(F.col("hit"))).alias("bin"), F.lit(0).alias("seen"))
    seen = found.select(F.explode("candidates").alias("c")).select("c.stratum", "c.bin", F.lit(1).alias("seen"))
    counts = seen.union(ordinary).groupBy("stratum", "bin").agg(F.sum("seen").alias("n"), F.sum(1 - F.col("seen")).alias("b"))
    up, all_ = Window.partitionBy("stratum").orderBy("bin"), Window.partitionBy("stratum")  # STRATA * BINS rows at most
    counts = counts.select("stratum", "bin", "n", F.sum("n").over(up).alias("upto"), ((F.sum("b").over(up) + 1) / (F.sum("b").over(all_) + 1)).alias("p"))
    # Of ordinary runs, as many have a p-value over one half as under it.
    likely = 2 * (F.sum(F.when(F.col("p") > 0.5, F.col("n")).otherwise(0)).over(all_) + 1)
    counts = counts.withColumn("ordinary", F.least(F.sum("n").over(all_), likely))
    last = counts.filter((F.col("upto") > 0) & (F.col("p") * F.col("ordinary") <= F.lit(rate) * F.col("upto"))).groupBy("stratum").agg(F.max("bin").alias("last"))
    out = [-1] * STRATA
    for row in last.collect():  # STRATA rows at most
        out[row["stratum"]] = row["last"]
    return out


def spans_of(bins: list[int]) -> Column:
    """All spans of a row of ``scan``, in order."""
    last = F.array(*map(F.lit, bins))
    random = F.transform(F.filter("candidates", lambda x: x["bin"] <= F.element_at(last, x["stratum"] + 1)), lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), x["end"].alias("end")))
    return F.array_sort(F.concat("base", random))


def find_secrets(docs: DataFrame, keep: list[str], rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``keep`` and base and spans, arrays of struct(start, kind number in KINDS, end), of every row of ``docs`` (text)."""
    found = store(scan(docs, [docs[f"`{c}`"] for c in keep]), "secrets-found")
    return found.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "base", spans_of(reported_bins(found, rate)).alias("spans"))


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def without(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with ``mask`` for each run of overlapping ``spans``, which come by start."""
    reach = running(spans, lambda s: s["end"], lambda a, b: F.greatest(a, b), F.lit(0))

    def block(members: Column) -> Column:
        first = F.element_at(members, 1)["before"]

        def piece(part: Column) -> Column:
            cut = lambda s: F.concat(F.substring(part, s["before"] - first + 1, s["x"]["start"] - s["before"]), F.lit(mask))
            return F.array_join(F.transform(members, lambda s: F.when(s["x"]["start"] >= s["before"], cut(s)).otherwise("")), "")

        # A block's spans are cut from the block's own text, as each cut counts characters from the start of what it is given.
        return let(F.substring(text, first + 1, F.greatest(F.element_at(members, -1)["x"]["start"] - first, F.lit(0))), piece)

    def whole(all_: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(all_).cast("double"))).cast("int")
        blocks = let(size, lambda n: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / n).cast("int")), lambda i: block(F.slice(all_, i * n + 1, n))))
        last = F.element_at(all_, -1)
        return F.concat(F.array_join(blocks, ""), let(F.greatest(last["before"], last["x"]["end"]), lambda at: F.substring(text, at + 1, F.length(text))))

    return F.when(F.size(spans) > 0, let(reach, whole)).otherwise(text)


def masked(docs: DataFrame, mask: str = "[secret]", rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``docs`` with every span of every text replaced by ``mask``; overlapping spans are replaced as one.

    The texts are scanned twice, for the p-values of the whole table and to mask them, and not
    stored in between. A column n_chars is brought up to date where the text changes. Null
    texts stay null; all other columns stay as they are, whatever their names.
    """
    columns = docs.columns
    bins = reported_bins(scan(docs, []), rate)
    found = scan(docs, [docs[f"`{c}`"] for c in columns]).withColumn("spans", spans_of(bins))
    at = {c: F.col(f"_{i}") for i, c in enumerate(columns)}
    found = found.withColumn("text", F.when(F.size("spans") > 0, without(at["text"], F.col("spans"), mask)).otherwise(at["text"]))
    changed = {"text": F.col("text")}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("text")).otherwise(at["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return found.select(*[changed.get(c, at[c]).alias(c) for c in columns])


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(table(spark, sf_dir, "documents"), ["doc_id"]))

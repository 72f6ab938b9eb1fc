"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Each document gets a vector of transformed statistics.  Per (language, source) a
minimum-covariance-determinant estimate is found by concentration steps: from a start of
medians and absolute deviations, the estimate is refitted on the share of rows with the
smallest Mahalanobis distances, until the group's determinant falls no more.  Documents
beyond a distance limit are rejected.  Small groups are judged by a pool of their language's
small groups, and a pool that is small itself by all documents.

All work is done by DataFrame expressions.  Groups are only ever counted and summed, so one
that owns a third of all rows costs no more than any other, and estimates come back to the
rows by a join dealt over ``SALTS`` slices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letterloom.llm import common as c

MIN_WORDS = 20
REPEAT_WINDOW = 8
CORE_SHARE = 0.75  # share of a group's rows that an estimate is fitted on
STEPS, REST = 100, 1e-3  # concentration steps of a group go on until its log determinant falls by less than REST; STEPS only ends a loop that never rests
MIN_GROUP = 60  # smaller groups are pooled per language, smaller pools are judged by all documents
MIN_ROWS = 12  # fewer documents altogether have no shape in five dimensions
ALL = "\0all"
LIMIT = 20.515  # squared distance: 99.9 % of chi-square of 5 degrees of freedom
CHI2_MEDIAN = 4.3515  # of 5 degrees of freedom
SALTS = 16
DIMS = ["x_len", "x_word", "x_symbol", "x_lines", "x_repeat"]
# What the covariance of a normal core falls short by, if 0 to 5 statistics vary in it.
SHORTFALL = (1.0, 2.7135, 1.8591, 1.6092, 1.4864, 1.4121)
_SPACE = r"[\x20\x09-\x0D]+"


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the five counts of each document.

    A null text is empty and has no words.  Null languages and sources form a group of their
    own.  Windows are compared by a 64-bit hash of their words within one text.
    """
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("\0")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("source"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    words = F.filter(F.split("text", _SPACE), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = base.select(
        "doc_id", "lang", "source", words.alias("words"), lines.alias("lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
    )
    last = F.size("words") - REPEAT_WINDOW
    window_hash = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(REPEAT_WINDOW)])
    )
    cut = cut.select(
        "doc_id", "lang", "source", "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(last >= 0, window_hash).otherwise(F.array().cast("array<bigint>")).alias("hashes"),
    )
    placed = F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    cut = cut.withColumn(
        "placed", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed)
    ).drop("hashes")
    hit = F.filter(
        F.transform(
            "placed",
            lambda x, k: F.when(
                (x["h"] == F.get("placed", k - 1)["h"]) | (x["h"] == F.get("placed", k + 1)["h"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    cut = cut.withColumn("hit", F.array_sort(hit)).drop("placed")
    steps = F.transform(
        "hit", lambda p, k: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get("hit", k + 1) - p, F.lit(REPEAT_WINDOW)))
    )
    repeated = F.aggregate(steps, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return cut.withColumn("n_repeat_words", F.coalesce(repeated, F.lit(0).cast("bigint"))).drop("hit")


def _vector() -> dict[str, Column]:
    """Transformed statistics: logarithms of sizes, square roots of shares."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {
        "x_len": F.log1p("n_words"),
        "x_word": F.log(chars / words),
        "x_symbol": F.sqrt(F.col("n_symbols") / chars),
        "x_lines": F.sqrt(F.col("n_dup_lines") / (F.col("n_dup_lines") + F.sqrt(words))),
        "x_repeat": F.sqrt(F.col("n_repeat_words") / words),
    }


def _floors() -> dict[str, Column]:
    """Standard deviation that counting alone gives each statistic in a text of a group's median size.

    A count n has the error sqrt(n), so its logarithm has 1 / sqrt(n) and the root of a share of n
    units 1 / (2 sqrt(n)).  Most groups have no symbols or repeats at all in their core, and one
    repeated line would be infinitely far without it.
    """
    words = F.greatest(F.expm1("m_x_len"), F.lit(1.0))
    chars = words * F.exp("m_x_word")
    return {
        "x_len": 1 / F.sqrt(words),
        "x_word": 1 / F.sqrt(chars),
        "x_symbol": 0.5 / F.sqrt(chars),
        "x_lines": 0.5 / F.sqrt(F.sqrt(words)),
        "x_repeat": 0.5 / F.sqrt(words / REPEAT_WINDOW),
    }


def _with_groups(rows: DataFrame, estimates: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows joined with their group's estimates; the rows of a hot group go to ``SALTS`` slices."""
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    repeated = estimates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")


def _quantiles(rows: DataFrame, keys: list[str], value: Column, width: float, share: float) -> DataFrame:
    """Exact upper bin edge, on a grid of ``width``, of the ``share`` quantile per group."""
    counts = rows.select(*keys, F.floor(value / width).alias("_bin")).groupBy(*keys, "_bin").count()
    group = Window.partitionBy(*keys)  # bins of a grid, not rows
    upto = F.sum("count").over(group.orderBy("_bin"))
    marked = counts.withColumn("_upto", upto).withColumn("_all", F.sum("count").over(group))
    hit = marked.where(F.col("_upto") >= share * F.col("_all"))
    return hit.groupBy(*keys).agg(((F.min("_bin") + 1) * width).alias("cut"))


def _distances(rows: DataFrame) -> DataFrame:
    """``rows`` with ``d2``; one z at a time, so no expression is written out twice."""
    names = []
    for i, d in enumerate(DIMS):
        rest = F.col(d) - F.col(f"m_{d}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}{j}") * F.col(f"_z{j}")
        rows = rows.withColumn(f"_z{i}", rest / F.col(f"l_{i}{i}"))
        names.append(f"_z{i}")
    return rows.withColumn("d2", reduce(lambda a, b: a + b, [F.col(n) * F.col(n) for n in names])).drop(*names)


def _cholesky(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Means and lower factor columns from sums and floors ``f_*``, which are kept.

    The covariance of the core is made that of all rows, then variances get the square of their floor added.
    """
    n = F.col("n")
    for d in DIMS:
        moments = moments.withColumn(f"m_{d}", F.col(f"s_{d}") / n)
    varied = [F.when(F.col(f"q_{d}_{d}") / n - F.col(f"m_{d}") ** 2 > F.col(f"f_{d}") ** 2, 1).otherwise(0) for d in DIMS]
    short = F.get(F.array(*[F.lit(x) for x in SHORTFALL]), reduce(lambda a, b: a + b, varied))
    moments = moments.withColumn("_short", short)
    for i, a in enumerate(DIMS):
        for j in range(i + 1):
            b = DIMS[j]
            cov = (F.col(f"q_{b}_{a}") / n - F.col(f"m_{a}") * F.col(f"m_{b}")) * F.col("_short")
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) + F.col(f"f_{a}") ** 2
            for k in range(j):
                cov = cov - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}")
            value = F.sqrt(F.greatest(cov, F.lit(1e-9))) if i == j else cov / F.col(f"l_{j}{j}")
            moments = moments.withColumn(f"l_{i}{j}", value)
    return moments.select(*keys, *[f"f_{d}" for d in DIMS], *[f"m_{d}" for d in DIMS], *[f"l_{i}{j}" for i in range(len(DIMS)) for j in range(i + 1)])


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    sums = [F.sum(d).alias(f"s_{d}") for d in DIMS]
    products = [F.sum(F.col(a) * F.col(b)).alias(f"q_{a}_{b}") for i, a in enumerate(DIMS) for b in DIMS[i:]]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums, *products)


def _start(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Median and absolute deviation per statistic, as a diagonal estimate."""
    long = rows.select(
        *keys, "doc_id", F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("x")) for d in DIMS])).alias("v")
    ).select(*keys, "doc_id", "v.dim", "v.x")
    centre = c.stage(_quantiles(long, [*keys, "dim"], F.col("x"), 0.01, 0.5), "outlier-centre")
    off = _with_groups(long, centre.withColumnRenamed("cut", "mid"), [*keys, "dim"])
    spread = _quantiles(off, [*keys, "dim"], F.abs(F.col("x") - F.col("mid")), 0.01, 0.5)
    both = centre.withColumnRenamed("cut", "mid").join(spread, [*keys, "dim"])
    wide = both.groupBy(*keys).agg(
        *[F.max(F.when(F.col("dim") == d, F.col("mid"))).alias(f"m_{d}") for d in DIMS],
        *[F.max(F.when(F.col("dim") == d, 1.4826 * F.col("cut"))).alias(f"_mad_{d}") for d in DIMS],
    ).withColumns({f"f_{d}": floor for d, floor in _floors().items()})
    wide = wide.withColumns(
        {f"l_{i}{i}": F.sqrt(F.col(f"_mad_{d}") ** 2 + F.col(f"f_{d}") ** 2) for i, d in enumerate(DIMS)}
    ).drop(*[f"_mad_{d}" for d in DIMS])
    zero = {f"l_{i}{j}": F.lit(0.0) for i in range(len(DIMS)) for j in range(i)}
    start = c.stage(wide.withColumns(zero), "outlier-start")
    c.drop_stage(centre)
    return start


def _log_determinant() -> Column:
    return reduce(lambda x, y: x + y, [F.log(F.col(f"l_{i}{i}")) for i in range(len(DIMS))])


def robust_estimates(rows: DataFrame, keys: list[str], core: float = CORE_SHARE, steps: int = STEPS) -> DataFrame:
    """Centre, Cholesky factor and scale per group of at least ``MIN_ROWS`` rows.

    ``rows`` is a staged table, since every step reads it.  Ties at the quantile stay in.
    """
    big = rows.groupBy(*keys).count().where(F.col("count") >= MIN_ROWS).drop("count")
    rows = _with_groups(rows, big, keys)
    estimate = _start(rows, keys)
    log_d2 = F.log(F.greatest("d2", F.lit(1e-6)))
    rested: list[DataFrame] = []
    for step in range(steps):
        far = _distances(_with_groups(rows, estimate, keys)).select(*keys, "doc_id", *DIMS, "d2")
        cut = c.stage(_quantiles(far, keys, log_d2, 0.01, core), "outlier-cut")
        near = _with_groups(far, cut, keys).where(log_d2 <= F.col("cut"))
        floors = estimate.select(*keys, *[f"f_{d}" for d in DIMS], _log_determinant().alias("_before"))
        following = _cholesky(_moments(near, keys).join(floors.drop("_before"), keys), keys).join(floors.select(*keys, "_before"), keys)
        # the start is no fit, so its determinant says nothing
        falls = F.lit(True) if step == 0 else _log_determinant() < F.col("_before") - REST
        following = c.stage(following.withColumn("_falls", falls).drop("_before"), "outlier-estimate")
        c.drop_stage(cut)
        rested.append(following.where("not _falls").drop("_falls"))
        estimate = following.where("_falls").drop("_falls")
        if estimate.isEmpty():
            break
    estimate = reduce(DataFrame.unionByName, [*rested, estimate])
    far = _distances(_with_groups(rows, estimate, keys)).select(*keys, "d2")
    middle = _quantiles(far, keys, log_d2, 0.01, 0.5)
    # a spread below the floors must not shrink the scale, or rows inside them would be outliers
    scale = F.greatest(F.exp("cut") / CHI2_MEDIAN, F.lit(1.0)).alias("scale")
    return estimate.join(middle.select(*keys, scale), keys)


def _groups(counted: DataFrame) -> DataFrame:
    """``lang, source, _lang, _group``: each source by itself, in its language's pool, or among all documents."""
    sizes = counted.groupBy("lang", "source").agg(F.count(F.when(~F.col("base_failed"), 1)).alias("_rows"))
    small = F.col("_rows") < MIN_GROUP
    pool = F.sum(F.when(small, F.col("_rows")).otherwise(0)).over(Window.partitionBy("lang"))  # sources, not rows
    lonely = small & (pool < MIN_GROUP)
    return sizes.select(
        "lang", "source", F.when(lonely, F.lit(ALL)).otherwise(F.col("lang")).alias("_lang"),
        F.when(lonely, F.lit(ALL)).when(small, F.lit("\0pool")).otherwise(F.col("source")).alias("_group"),
    )


def judge(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The counts of every document with ``base_failed``, ``distance`` and ``kept``.

    ``distance`` is null where no estimate exists: base rules failed, or there are fewer than ``MIN_ROWS``
    documents to judge a lonely one by, which then stays.  An empty table gives an empty result.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    counted = c.stage(text_statistics(docs).withColumn("base_failed", failed), "outlier-statistics")
    groups = c.stage(_groups(counted), "outlier-group-names")
    pooled = _with_groups(counted, groups, ["lang", "source"]).withColumns(_vector())
    keys = ["_lang", "_group"]
    sound = pooled.where(~F.col("base_failed")).select(*keys, "doc_id", *DIMS)
    if not groups.where(F.col("_lang") == ALL).isEmpty():
        sound = sound.where(F.col("_lang") != ALL).unionByName(sound.withColumns({k: F.lit(ALL) for k in keys}))
    rows = c.stage(sound, "outlier-rows")
    estimates = c.stage(robust_estimates(rows, keys), "outlier-groups")
    c.drop_stage(rows)
    judged = _distances(_with_groups(pooled, estimates, keys, "left"))
    distance = F.when(~F.col("base_failed"), F.col("d2") / F.col("scale"))
    return judged.withColumn("distance", distance).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)
    )


def quality_rules_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts, the base verdict and the final one."""
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )

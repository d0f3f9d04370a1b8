"""Quality rules: text statistics, fixed floors, and robust multivariate outliers.

DataFrame functions only. Each text yields counts (words, symbols, lines seen before, words in repeated
8-word windows, words equal to the one before); five transformed ratios of them form its vector. For each language and source, and for all
rows together, the minimum-covariance-determinant estimate is sought from several starts (the variables'
first, second and third quartiles): a concentration step takes the half of the rows that lie nearest and
their mean and covariance, which never raises the determinant. After FIRST_STEPS steps the start of least
determinant goes on until the determinant stands still. The covariance is scaled so that the median distance is
that of a normal sample in as many dimensions as the half spreads in (it is never made smaller). A variance is
at least its floor's square, so that a statistic which is zero for most texts does not condemn any other value.

A group's estimate is that of its rows and PRIOR_ROWS rows drawn from all: small groups lean on the whole, large
ones on themselves, and no size decides. A text is rejected if it fails a fixed floor or its squared
Mahalanobis distance exceeds the chi-square cutoff.

Order statistics come from histograms (counts by group and bucket), so a group of any size is reduced
before the shuffle and never gathers in one task; of the bucket that holds the middle, all rows count in part, so
that the half is a half.

Null texts have no words and fail the floor; null languages and sources are groups of their own. Equal
rows are judged alike. An empty table gives an empty result; further columns are kept by the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.common import cut, fenced

SPACE, NOT_SPACE, SYMBOLS = "[\\x20\\x09-\\x0D]+", "[^\\x20\\x09-\\x0D]", "[#*$%&|<>]"
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
#: Squared distance: the 0.9999 quantile of chi-square with 5 degrees of freedom; medians of 1 to 5.
CUTOFF, MEDIANS = 25.745, (0.455, 1.386, 2.366, 3.357, 4.351)
VARIABLES = ("v_length", "v_symbols", "v_lines", "v_repeats", "v_adjacent")
D = len(VARIABLES)
#: Least spread of each variable, in its own unit; half of these is the grid of the starts.
FLOORS = (0.06, 0.06, 0.20, 0.18, 0.12)
#: Steps from each start; steps at most, and the change of the determinant's logarithm that is none; buckets a unit of log distance.
FIRST_STEPS, MAX_STEPS, STILL, PER_UNIT = 2, 40, 1e-3, 128
PRIOR_ROWS, BROADCAST_GROUPS = 50, 10_000


def with_counts(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (and n_lines, n_adjacent)."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.withColumn("_text", text)
    rows = rows.withColumn("_words", F.filter(F.split("_text", SPACE), lambda w: w != "")).withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(NOT_SPACE)))
    rows = rows.withColumn("n_words", F.size("_words").cast("long")).withColumn("_windows", F.when(F.size("_words") >= WINDOW, F.expr(f"transform(sequence(1, size(_words) - {WINDOW - 1}), i -> xxhash64(slice(_words, i, {WINDOW})))")))
    # only a text that repeats a window pays for the sort
    rows = rows.withColumn("_sorted", F.expr("case when size(_windows) > size(array_distinct(_windows)) then sort_array(transform(_windows, (h, i) -> struct(h, i))) end"))
    rows = rows.withColumn("_found", F.expr("sort_array(transform(filter(_sorted, (x, k) -> (k > 0 and get(_sorted, k - 1).h = x.h) or get(_sorted, k + 1).h = x.h), x -> x.i))"))
    repeats = F.expr(f"aggregate(_found, struct({-WINDOW} as last, 0L as total), (a, i) -> struct(i as last, a.total + least({WINDOW}, i - a.last) as total), a -> a.total)")
    rows = (
        rows.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_adjacent", F.expr("size(filter(_words, (w, i) -> i > 0 and w = get(_words, i - 1)))").cast("long"))
        .withColumn("n_repeat_words", F.coalesce(repeats, F.lit(0)).cast("long"))
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.drop("_text", "_words", "_lines", "_windows", "_sorted", "_found")
    return fenced(rows, ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_adjacent"]).withColumn("base_failed", failed)


def with_vector(rows: DataFrame) -> DataFrame:
    """rows of with_counts with the transformed variables and the key of their group."""
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    vector = (F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))), F.least(share("n_symbols", "word_chars"), F.lit(1.0)), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"), share("n_adjacent", "n_words"))
    part = lambda c: F.when(rows[c].isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), rows[c].cast("string")))
    return rows.withColumns(dict(zip(VARIABLES, vector))).withColumn("group", F.concat_ws("\u0001", part("lang"), part("source")))


def _from_histogram(rows: DataFrame, keys: list[str], bucket: str, shares: dict[str, float]) -> DataFrame:
    """For each key the least bucket up to which lies each share of its rows, what part of that bucket's rows makes the share whole (name_part), and all its rows (of)."""
    counts = rows.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy(bucket))
    counts = counts.withColumn("upto", upto).withColumn("of", F.sum("n").over(Window.partitionBy(*keys)))
    found = lambda share: F.min(F.when(F.col("upto") >= F.col("of") * share, F.struct(bucket, ((F.col("of") * share - F.col("upto") + F.col("n")) / F.col("n")).alias("part"))))
    got = counts.groupBy(*keys).agg(F.first("of").alias("of"), *[found(share).alias(name) for name, share in shares.items()])
    return got.select(*keys, "of", *[F.col(name)[bucket].alias(name) for name in shares], *[F.col(name)["part"].alias(f"{name}_part") for name in shares])


def _factor(cov: list[list[Column]]) -> dict[str, Column]:
    """Cholesky factor of a symmetric matrix of columns, as nested structs would repeat work: names to columns in order."""
    out: dict[str, Column] = {}
    for i in range(len(cov)):
        for j in range(i + 1):
            rest = cov[i][j]
            for k in range(j):
                rest = rest - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}")
            out[f"l_{i}{j}"] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l_{j}{j}")
    return out


MOMENTS = [*(f"m_{i}" for i in range(D)), *(f"c_{i}{j}" for i in range(D) for j in range(i + 1))]
FACTOR = [f"l_{i}{j}" for i in range(D) for j in range(i + 1)]


def _with_factor(params: DataFrame) -> DataFrame:
    """params (m_i, c_ij) with the factor of the covariance, no variance less than its floor's square, and the logarithm of its determinant."""
    cov = [[F.greatest(F.col(f"c_{i}{i}"), F.lit(FLOORS[i] ** 2)) if i == j else F.col(f"c_{max(i, j)}{min(i, j)}") for j in range(D)] for i in range(D)]
    for name, column in _factor(cov).items():
        params = params.withColumn(name, column)
    return params.withColumn("logdet", sum((2 * F.log(f"l_{i}{i}") for i in range(1, D)), 2 * F.log("l_00")))


def _distance() -> Column:
    z: list[Column] = []
    for i, v in enumerate(VARIABLES):
        rest = F.col(v) - F.col(f"m_{i}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}{k}") * z[k]
        z.append(rest / F.col(f"l_{i}{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _broadcast(params: DataFrame, groups: int) -> DataFrame:
    """params of so many groups: broadcast if they are few."""
    return F.broadcast(params) if groups <= BROADCAST_GROUPS else params


def _beside(params: DataFrame) -> DataFrame:
    """One row a group: broadcast while these are few, so that no group's rows gather; beyond, both sides shuffle."""
    return F.broadcast(params) if params.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS else params


def _small(df: DataFrame, groups: int) -> DataFrame:
    """A few rows a group, in as few tasks as these need."""
    return df.coalesce(max(1, groups // 500))


def _bucketed(used: DataFrame, params: DataFrame, groups: int) -> DataFrame:
    """used with b, the bucket of its distance under each start of its group's params, and the start's last determinant."""
    params = params.select("group", "start", "logdet", *MOMENTS[:D], *FACTOR)
    return used.join(_broadcast(params, groups), "group").withColumn("b", F.floor(F.log1p(_distance()) * PER_UNIT).cast("int"))


def _concentrated(used: DataFrame, params: DataFrame, groups: int) -> DataFrame:
    """params after a concentration step, with the determinant before it."""
    near = _bucketed(used, params, groups)
    bars = _from_histogram(near, ["group", "start"], "b", {"bar": 0.5}).select(F.col("group").alias("_g"), F.col("start").alias("_s"), "bar", "bar_part")
    half = near.join(_broadcast(bars, groups), (F.col("group") == F.col("_g")) & (F.col("start") == F.col("_s"))).where("b <= bar")
    w = F.when(F.col("b") < F.col("bar"), F.lit(1.0)).otherwise(F.col("bar_part"))
    # about the last centre, so that sums of squares do not cancel
    u = [F.col(v) - F.col(f"m_{i}") for i, v in enumerate(VARIABLES)]
    sums = [F.sum(w).alias("w"), F.first("logdet").alias("before"), *[F.first(f"m_{i}").alias(f"o_{i}") for i in range(D)], *[F.sum(w * u[i]).alias(f"s_{i}") for i in range(D)], *[F.sum(w * u[i] * u[j]).alias(f"q_{i}{j}") for i in range(D) for j in range(i + 1)]]
    mean = lambda c: F.col(c) / F.col("w")
    got = _small(half.groupBy("group", "start").agg(*sums), groups)
    got = got.select("group", "start", "before", *[(F.col(f"o_{i}") + mean(f"s_{i}")).alias(f"m_{i}") for i in range(D)], *[(mean(f"q_{i}{j}") - mean(f"s_{i}") * mean(f"s_{j}")).alias(f"c_{i}{j}") for i in range(D) for j in range(i + 1)])
    return cut(_with_factor(got))


def _starts(used: DataFrame) -> DataFrame:
    """For each group three centres with the quartiles' spreads."""
    cells = used.select("group", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(v) * (2 / FLOORS[i])).cast("int").alias("b")) for i, v in enumerate(VARIABLES)])).alias("c")).select("group", "c.i", "c.b")
    marks = _from_histogram(cells, ["group", "i"], "b", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    grid = F.element_at(F.array(*[F.lit(f / 2) for f in FLOORS]), F.col("i") + 1)
    at = lambda i, c: F.max(F.when(F.col("i") == i, c))
    spread = F.pow((F.col("q3") - F.col("q1")) * grid / 1.349, F.lit(2.0))
    marks = marks.groupBy("group").agg(*[at(i, (F.col(q) + 0.5) * grid).alias(f"{q}_{i}") for q in ("q1", "q2", "q3") for i in range(D)], *[at(i, spread).alias(f"c_{i}{i}") for i in range(D)])
    centres = F.explode(F.array(*[F.struct(F.lit(k).alias("start"), *[F.col(f"{q}_{i}").alias(f"m_{i}") for i in range(D)]) for k, q in enumerate(("q2", "q1", "q3"))])).alias("x")
    marks = marks.select("group", centres, *[f"c_{i}{i}" for i in range(D)]).select("group", "x.*", *[f"c_{i}{i}" for i in range(D)])
    return cut(_with_factor(marks.withColumns({f"c_{i}{j}": F.lit(0.0) for i in range(D) for j in range(i)})))


def estimates(rows: DataFrame) -> DataFrame:
    """rows of with_vector -> for each group its mean and factor; the group "" is that of all rows and serves groups that have no row here."""
    own = cut(rows.where(~F.col("base_failed")).select("group", *VARIABLES))
    # vectors are small and read often: in as few tasks as they need
    own = own.coalesce(max(own.sparkSession.sparkContext.defaultParallelism, own.count() // 500_000))
    used = own.select(F.explode(F.array("group", F.lit(""))).alias("group"), *VARIABLES)
    params = _starts(used)
    groups = params.select("group").distinct().count()
    for _ in range(FIRST_STEPS):
        params = _concentrated(used, params, groups)
    best = params.groupBy("group").agg(F.min(F.struct("logdet", "start")).alias("x")).select("group", "x.start")
    params = cut(_small(params.join(_broadcast(best, groups), ["group", "start"]), groups))
    for _ in range(MAX_STEPS):
        params = _concentrated(used, params, groups)
        if params.where(F.col("before") - F.col("logdet") > STILL).isEmpty():
            break
    # scaled for consistency: half of the rows lie within the median of chi-square
    bars = _from_histogram(_bucketed(used, params, groups), ["group"], "b", {"bar": 0.5})
    spreads = sum((F.when(F.col(f"c_{i}{i}") > FLOORS[i] ** 2, 1).otherwise(0) for i in range(D)), F.lit(0))
    median = F.element_at(F.array(*[F.lit(x) for x in MEDIANS]), F.greatest(spreads, F.lit(1)))
    scale = F.greatest(F.expm1((F.col("bar") + F.col("bar_part")) / PER_UNIT) / median, F.lit(1.0))
    params = params.join(bars, "group").withColumn("scale", scale)
    params = cut(_small(params, groups).select("group", "of", *MOMENTS[:D], *[(F.col(c) * F.col("scale")).alias(c) for c in MOMENTS[D:]]))
    whole = params.where("group = ''").first()
    if whole is None:
        return _with_factor(params)
    # the moments of the group's rows and PRIOR_ROWS of all
    share = F.when(F.col("group") == "", 1.0).otherwise(F.col("of") / (F.col("of") + PRIOR_ROWS))
    off = [F.col(f"m_{i}") - whole[f"m_{i}"] for i in range(D)]
    mixed = params.select(
        "group",
        *[(share * F.col(f"m_{i}") + (1 - share) * whole[f"m_{i}"]).alias(f"m_{i}") for i in range(D)],
        *[(share * F.col(f"c_{i}{j}") + (1 - share) * whole[f"c_{i}{j}"] + share * (1 - share) * off[i] * off[j]).alias(f"c_{i}{j}") for i in range(D) for j in range(i + 1)],
    )
    return cut(_with_factor(mixed))


def judged(rows: DataFrame, params: DataFrame) -> DataFrame:
    """rows of with_vector with distance2 and kept."""
    needed = ["group", *[f"m_{i}" for i in range(D)], *[f"l_{i}{j}" for i in range(D) for j in range(i + 1)]]
    params = params.select(*needed)
    own = params.select(F.col("group").alias("_own"))
    rows = rows.join(_beside(own), F.col("group") == F.col("_own"), "left").withColumn("group", F.coalesce("_own", F.lit(""))).drop("_own")
    rows = rows.join(_beside(params), "group", "left").withColumn("distance2", _distance())
    keep = ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= CUTOFF)
    return rows.withColumn("kept", keep).drop(*needed[1:])


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept, distance2 of each row."""
    vectors = cut(with_vector(with_counts(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", "lang", "source"))).drop("text"))
    return judged(vectors, estimates(vectors)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, all columns. Texts are counted twice rather than shuffled."""
    columns = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in columns]).alias("_row"), docs["text"].alias("text"), docs["lang"].alias("lang"), docs["source"].alias("source"))
    params = estimates(cut(with_vector(with_counts(docs.select("text", "lang", "source"))).select("group", "base_failed", *VARIABLES)))
    return judged(with_vector(with_counts(packed)), params).where("kept").select("_row.*")

"""Quality rules: robust multivariate outliers by minimum covariance determinant, in DataFrame functions only.

Method: statistics of each whole text become a vector (log length, log mean word length, arcsine roots of
the shares of symbols, repeated lines and repeated words).  For each language and source the minimum
covariance determinant estimate is found by concentration steps from several deterministic starts: medians with
quartile scales, spatial signs, and hyperbolic tangents, all of standardised rows.  In a step the h = 75 % of
the rows nearest to the present estimate give the next mean and covariance; steps from a start go on as long as the
determinant falls, and of all estimates met in a group the one with the smallest determinant wins (a local minimum: in
tests against all subsets of small groups the least one in most groups with outliers, and within 0.8 of its logarithm in others).  Rows are rejected
by Mahalanobis distance from it, given their length: length alone never rejects.  The cutoff is the 0.999
quantile of the normal law's distances; shares of repeated words have heavier tails in short texts, so more
than 1 in 1000 clean rows lie beyond it (README).

A step is one pass over the written statistics, for all groups and starts: rows are counted and summed by (group,
start, distance bin), 1/32 of a doubling wide, and a running count over the bins of a group yields the sums of the nearest h.  So no
group is sorted or gathered, and results do not depend on the order of rows.  A floor on every variance
keeps constant statistics from making any deviation an outlier.

Defined cases: null and empty texts have no words and fail the base rule; null language or source is a
group of its own; groups with fewer than MIN_GROUP rows are estimated together for their language, and
reject nothing if they are few even so; rows repeat freely; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import exprs
from .shared import dropped, written

DIMENSIONS = 5
#: Standard deviations that are added to each estimate.
FLOOR = (0.1, 0.08, 0.05, 0.1, 0.1)
#: Rows nearest to the estimate that it is made of, and the chi-square value of 5 degrees there.
SHARE, AT_SHARE = 0.75, 6.6257
#: Squared distance beyond which a row is rejected: the chi-square value of 4 degrees, all but the length, at 0.999.
CUTOFF = 18.4668
MIN_GROUP = 60
#: Steps from a start end once the logarithm of the determinant falls by less.
LEAST_FALL = 1e-4
STARTS = ("median", "sign", "tanh")
#: Estimates are broadcast up to so many groups (200 bytes each), else joined with salt.
MOST_GROUPS = 20_000
SALTS = 16


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = text
    for c in exprs.SPACES:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(exprs.SPACES)) != "")
    both = exprs.let(exprs.words(text), lambda w: F.struct(F.size(w).alias("n"), exprs.repeated_words(w, 3).alias("r")))
    parts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        both.alias("w"),
        F.char_length(bare).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        exprs.let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d"))).alias("l"),
    )
    long = lambda c: F.col(c).cast("long")
    return parts.select("doc_id", "lang", "source", long("w.n").alias("n_words"), "word_chars", "n_symbols", long("l.d").alias("n_dup_lines"), long("w.r").alias("n_repeat_words"), long("l.n").alias("n_lines"))


def _vector() -> list[Column]:
    share = lambda a, b: F.asin(F.sqrt(F.least(F.lit(1.0), F.col(a) / F.greatest(F.lit(1), F.col(b)))))
    return [
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / F.greatest(F.lit(1), F.col("n_words"))),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    ]


_PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i + 1)]
_GROUP = ["lang", "grp"]


def _bin(distance: Column) -> Column:
    return F.floor(F.log2(distance + 2.0**-20) * 32).cast("long")


def _joined(rows: DataFrame, estimates: DataFrame, how: str = "left") -> DataFrame:
    """rows with the estimates of their group: a copy of a row for each of several."""
    own = estimates.withColumnsRenamed({"lang": "_lang", "grp": "_grp"})
    match = F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("grp") == F.col("_grp"))
    if estimates.count() <= MOST_GROUPS:
        return rows.join(F.broadcast(own), match, how).drop("_lang", "_grp")
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("x0", "x1", "x2"), F.lit(SALTS)))
    own = own.withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("_to", F.col("_to").cast("long"))
    return rows.join(own, match & (F.col("_salt") == F.col("_to")), how).drop("_lang", "_grp", "_salt", "_to")


def _solved(rows: DataFrame) -> DataFrame:
    """Columns z0..z4: the deviation from the mean in units of the Cholesky factor, by forward substitution."""
    for i in range(DIMENSIONS):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"z{j}")
        rows = rows.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    return rows


_DISTANCE = [f"z{i}" for i in range(DIMENSIONS)]


def _squares(columns: list[str]) -> Column:
    return sum((F.pow(F.col(c), 2) for c in columns), F.lit(0.0))


def _factored(moments: DataFrame, keep: list[str]) -> DataFrame:
    """keep, m0.., l00.., det: mean, Cholesky factor and log determinant of a covariance v00.. and its mean."""
    for i, j in _PAIRS:
        cov = F.col(f"v{i}{j}")
        if i == j:
            cov = F.greatest(cov, F.lit(0.0)) + FLOOR[i] ** 2
        for k in range(j):
            cov = cov - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        moments = moments.withColumn(f"l{i}{j}", F.sqrt(F.greatest(cov, F.lit(FLOOR[i] ** 2 / 4))) if i == j else cov / F.col(f"l{j}{j}"))
    det = 2 * sum((F.log(f"l{i}{i}") for i in range(DIMENSIONS)), F.lit(0.0))
    return moments.select(*keep, *(f"m{i}" for i in range(DIMENSIONS)), *(f"l{i}{j}" for i, j in _PAIRS), det.alias("det"))


def _quartiles(rows: DataFrame) -> DataFrame:
    """(lang, grp, rows, c0..c4, q0..q4): medians, and scales by quartiles, on a grid of 1/128, by counting."""
    each = rows.select(*_GROUP, F.posexplode(F.array(*(F.round(F.col(f"x{i}") * 128).cast("long") for i in range(DIMENSIONS)))).alias("k", "v"))
    counts = each.groupBy(*_GROUP, "k", "v").agg(F.count("*").alias("c"))
    up = Window.partitionBy(*_GROUP, "k").orderBy("v")
    total = Window.partitionBy(*_GROUP, "k")
    counts = counts.withColumns({"below": F.sum("c").over(up), "all": F.sum("c").over(total)})
    at = lambda share: F.min(F.when(F.col("below") >= share * F.col("all"), F.col("v"))) / 128
    found = counts.groupBy(*_GROUP, "k").agg(at(0.5).alias("m"), ((at(0.75) - at(0.25)) / 1.349).alias("s"), F.first("all").alias("n"))
    pick = lambda c, i: F.max(F.when(F.col("k") == i, F.col(c)))
    scales = [F.greatest(pick("s", i), F.lit(FLOOR[i])).alias(f"q{i}") for i in range(DIMENSIONS)]
    return found.groupBy(*_GROUP).agg(F.max("n").alias("rows"), *(pick("m", i).alias(f"c{i}") for i in range(DIMENSIONS)), *scales)


def _starts(rows: DataFrame) -> DataFrame:
    """(lang, grp, start, m.., l.., det): rough robust estimates to begin from, for groups with enough rows."""
    quartiles = written(_quartiles(rows).filter(F.col("rows") >= MIN_GROUP).drop("rows"), "quartiles")
    scaled = _joined(rows, quartiles, "inner")
    scaled = scaled.withColumns({f"u{i}": (F.col(f"x{i}") - F.col(f"c{i}")) / F.col(f"q{i}") for i in range(DIMENSIONS)})
    norm = F.sqrt(_squares([f"u{i}" for i in range(DIMENSIONS)]))
    forms = {"sign": lambda i: F.coalesce(F.try_divide(F.col(f"u{i}"), norm), F.lit(0.0)), "tanh": lambda i: F.tanh(f"u{i}")}
    sums = {f"{name}{i}{j}": F.avg(f(i) * f(j)) for name, f in forms.items() for i, j in _PAIRS}
    spread = scaled.groupBy(*_GROUP).agg(*(c.alias(k) for k, c in sums.items()))
    match = spread.withColumnsRenamed({"lang": "_lang", "grp": "_grp"})
    both = quartiles.join(match, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("grp") == F.col("_grp")))
    found = None
    for name in STARTS:
        # second moments of the form, as correlations, with the scales of the quartiles
        cor = (lambda i, j: F.lit(float(i == j))) if name == "median" else (lambda i, j, n=name: F.col(f"{n}{i}{j}") / F.sqrt(F.greatest(F.col(f"{n}{i}{i}") * F.col(f"{n}{j}{j}"), F.lit(1e-12))))
        values = [F.round(cor(i, j) * F.col(f"q{i}") * F.col(f"q{j}"), 10).alias(f"v{i}{j}") for i, j in _PAIRS]
        one = both.select(*_GROUP, F.lit(name).alias("start"), *(F.col(f"c{i}").alias(f"m{i}") for i in range(DIMENSIONS)), *values)
        found = one if found is None else found.union(one)
    out = written(_factored(found, [*_GROUP, "start"]), "starts")
    dropped(quartiles)
    return out


def _concentrated(rows: DataFrame, now: DataFrame) -> DataFrame:
    """(lang, grp, start, far, m.., l.., det): estimates of the SHARE of each group's rows nearest to the present ones; far: the largest
    distance among these."""
    keys = [*_GROUP, "start"]
    near = _solved(_joined(rows, now.drop("det"), "inner")).withColumn("distance", _squares(_DISTANCE))
    sums = {"n": F.count("*"), **{f"s{i}": F.sum(f"x{i}") for i in range(DIMENSIONS)}, **{f"p{i}{j}": F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in _PAIRS}}
    bins = near.withColumn("bin", _bin(F.col("distance"))).groupBy(*keys, "bin").agg(*(c.alias(k) for k, c in sums.items()))
    up = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*keys)
    inner = bins.withColumns({"before": F.coalesce(F.sum("n").over(up), F.lit(0)), "all": F.sum("n").over(every)}).filter(F.col("before") < SHARE * F.col("all"))
    total = inner.groupBy(*keys).agg(F.pow(F.lit(2.0), (F.max("bin") + 1) / 32.0).alias("far"), *(F.sum(k).alias(k) for k in sums))
    means = total.select(*keys, "far", "n", *(F.round(F.col(f"s{i}") / F.col("n"), 10).alias(f"m{i}") for i in range(DIMENSIONS)), *(f"p{i}{j}" for i, j in _PAIRS))
    moments = means.withColumns({f"v{i}{j}": F.round(F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"), 10) for i, j in _PAIRS})
    return _factored(moments, [*keys, "far"])


def estimates(rows: DataFrame) -> DataFrame:
    """(lang, grp, far, m.., l.., det): the estimate of least determinant of each group that has enough rows."""
    start = _starts(rows)
    now = written(_concentrated(rows, start), "estimate")
    dropped(start)
    met, active = [now], now
    # determinants fall by LEAST_FALL at least, and are bounded from below by the floors: this ends
    while not active.isEmpty():
        # written before it is filtered: a filter on the determinant would be pushed into all that makes it, over and over
        new = written(_concentrated(rows, active.drop("far")), "estimate")
        before = active.select(F.col("lang").alias("_lang"), F.col("grp").alias("_grp"), F.col("start").alias("_start"), F.col("det").alias("_det"))
        match = F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("grp") == F.col("_grp")) & (F.col("start") == F.col("_start"))
        active = written(new.join(before, match).filter(F.col("det") < F.col("_det") - LEAST_FALL).select(*now.columns), "active")
        dropped(new)
        met.append(active)
    every = met[0]
    for more in met[1:]:
        every = every.union(more)
    rest = [c for c in now.columns if c not in _GROUP]
    best = every.groupBy(*_GROUP).agg(F.min_by(F.struct(*rest), F.struct("det", "start")).alias("b")).select(*_GROUP, "b.*").drop("start")
    best = written(best, "estimates")
    dropped(*met)
    return best


def judged(docs: DataFrame, min_words: int = 50, max_repeat: int = 50, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics of every row with base_failed, distance (given the length) and kept."""
    stats = written(statistics(docs), "statistics")
    vectors = stats.withColumns({f"x{k}": c for k, c in enumerate(_vector())}).withColumn("grp", F.concat(F.lit("source:"), F.coalesce("source", F.lit(""))))
    # null is told from the empty source, and small groups share one group of their language
    vectors = vectors.withColumn("grp", F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.col("grp")))
    sizes = written(vectors.filter("n_words > 0").groupBy(*_GROUP).agg(F.count("*").alias("_rows")), "sizes")
    vectors = _joined(vectors, sizes).withColumn("grp", F.when(F.coalesce("_rows", F.lit(0)) < MIN_GROUP, F.lit("few")).otherwise(F.col("grp"))).drop("_rows")
    # every step reads these numbers, and plans them as a scan
    vectors = written(vectors, "vectors")
    dropped(stats, sizes)
    passed = vectors.filter("n_words > 0").select(*_GROUP, *(f"x{i}" for i in range(DIMENSIONS)))
    final = estimates(passed)
    rest = _squares(_DISTANCE[1:])
    out = _solved(_joined(vectors, final)).withColumn("distance", rest * F.least(F.lit(1.0), AT_SHARE / F.col("far")))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return out.withColumn("base_failed", failed).select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"), "distance"
    )

"""Quality rules by robust multivariate outliers, with DataFrame functions only.

Each text becomes a vector of transformed statistics. For every language with source, every language, and all documents
the minimum covariance determinant is estimated: from each of three starts (medians with the spread of the quartiles,
means with covariances, medians with covariances), concentration steps keep the share `SUPPORT` of vectors nearest by
Mahalanobis distance and estimate mean and covariance anew, until its determinant falls by no more than FALLS (STEPS
times at most). Each start of each group ends by its own determinant, so no group depends on another; of the starts, the one with the least determinant counts. To every variance the square of its
value in DIMENSIONS is added, so covariances stay regular. The estimate of a language with source is drawn towards that
of its language, and that towards the one of all documents, as if by PRIOR rows; so a small group follows the larger
one that it is part of, and no number of rows switches anything. A document goes if it fails the base rules or lies
beyond `CUTOFF` from the estimate of its language and source.

Tables of estimates have a row for each group. They are sent to all tasks if there are at most BROADCAST_GROUPS, else
joined by group and one of SALTS random numbers, so no group is one task's.

Edge cases: a null or empty text has no words and fails the base rules. A null language or source is a value like any
other. A group in which all fail has no estimate; then the base rules alone decide. Repeated rows count as often as they
come and get equal results. Other columns of `docs` are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galeframe.llm.staging import staged
from galeframe.llm.statistics import COUNTS, let, statistics

SUPPORT, STEPS, FALLS, PRIOR = 0.75, 20, 0.05, 100e0
BROADCAST_GROUPS, SALTS = 50_000, 64
#: Squared distance. A chi-squared law of 5 degrees goes beyond it with probability 1.5e-8; clean texts have heavier tails.
CUTOFF = 45.0
#: Name and, in its unit, the spread that is added to each dimension: many are 0 for nearly all clean texts.
DIMENSIONS = {"v_length": 0.035, "v_symbols": 0.05, "v_lines": 0.08, "v_repeats": 0.06, "v_upper": 0.03}
NAMES = tuple(DIMENSIONS)
#: What makes the variance of the kept share that of a Gaussian whole: 1 / P(chi2_7 <= q), with P(chi2_5 <= q) = SUPPORT.
CONSISTENCY = 1.64


def vector(s: Column) -> dict[str, Column]:
    """The transformed statistics. Shares of short texts are drawn towards 0, as they vary more."""
    n = F.greatest(s["n_words"], F.lit(1)).cast("double")
    return {
        "v_length": F.log(F.greatest(s["word_chars"] / n, F.lit(0.5))),
        "v_symbols": F.log1p(s["n_symbols"] / n),
        "v_lines": s["n_dup_lines"] / (s["n_lines"] + 5e0),
        "v_repeats": s["n_repeat_words"] / (s["n_words"] + 20e0),
        "v_upper": F.sqrt(F.greatest(s["n_upper"] / F.greatest(s["n_chars"], F.lit(1)) - 0.03e0, F.lit(0e0))),
    }


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def _key(*columns: str) -> Column:
    """A text that differs for different values, null among them, and for different numbers of columns."""
    return F.to_json(F.array(*(F.col(c).cast("string") for c in columns)))


ALL = "[]"
D = range(len(NAMES))
CELLS = [(i, j) for i in D for j in range(i + 1)]


def _with(rows: DataFrame, table: DataFrame, few: bool, *keys: str, how: str = "left") -> DataFrame:
    """`rows` with the columns of `table` that has the same grp (and `keys`)."""
    if few:
        return rows.join(F.broadcast(table), ["grp", *keys], how)
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.floor(F.rand(7) * SALTS).cast("int")).join(salted.hint("merge"), ["grp", *keys, "salt"], how).drop("salt")


def _cholesky(fit: DataFrame) -> DataFrame:
    """`fit` with l_i_j, so that L L^T is the covariance c_i_j, and its determinant det."""
    rest = lambda i, j: " - ".join([f"c_{i}_{j}", *(f"l_{i}_{h} * l_{j}_{h}" for h in range(j))])
    cells = [f"sqrt(greatest({rest(i, j)}, 1e-9)) AS l_{i}_{j}" if i == j else f"({rest(i, j)}) / l_{j}_{j} AS l_{i}_{j}" for i, j in CELLS]
    return fit.selectExpr("*", *cells, " * ".join(f"l_{i}_{i} * l_{i}_{i}" for i in D) + " AS det")


def _regular(i: int, j: int, c: str) -> str:
    return f"{c} + {DIMENSIONS[NAMES[i]] ** 2 if i == j else 0.0!r}D AS c_{i}_{j}"


def _moments() -> list[Column]:
    return [F.avg(v).alias(f"a_{i}") for i, v in enumerate(NAMES)] + [F.covar_pop(NAMES[i], NAMES[j]).alias(f"s_{i}_{j}") for i, j in CELLS]


def _start(inner: DataFrame) -> DataFrame:
    """n and the estimate of each start of every group; was, the determinant before, is null yet."""
    quartiles = [F.percentile_approx(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000).alias(f"q_{i}") for i, v in enumerate(NAMES)]
    q = staged(inner.groupBy("grp").agg(F.count("*").alias("n"), *quartiles, *_moments()), "quality-start")
    spread = lambda i: f"power((q_{i}[2] - q_{i}[0]) / 1.349D, 2)"

    def begin(k: int) -> DataFrame:
        means = [(f"a_{i}" if k == 1 else f"q_{i}[1]") + f" AS m_{i}" for i in D]
        return q.selectExpr("grp", f"{k} AS start", "n", "double(null) AS was", *means, *(_regular(i, j, f"s_{i}_{j}" if k else spread(i) if i == j else "0D") for i, j in CELLS))

    return _cholesky(begin(0).union(begin(1)).union(begin(2)))


def _distance(rows: DataFrame) -> DataFrame:
    """`rows` with d, the squared Mahalanobis distance from the estimate (m_i, l_i_j) beside them."""
    rest = lambda i: " - ".join([f"{NAMES[i]} - m_{i}", *(f"l_{i}_{j} * y_{j}" for j in range(i))])
    return rows.selectExpr("*", *(f"({rest(i)}) / l_{i}_{i} AS y_{i}" for i in D), " + ".join(f"y_{i} * y_{i}" for i in D) + " AS d")


def _settled() -> Column:
    return F.coalesce(1 - F.col("det") / F.col("was") <= FALLS, F.lit(False))


def _concentrated(inner: DataFrame, fit: DataFrame, few: bool) -> DataFrame:
    """`fit` after one more step of the starts that haven't settled; only the rows of their groups are read."""
    active = fit.filter(~_settled())
    far = _distance(_with(inner, active.drop("n", "was", "det", *(f"c_{i}_{j}" for i, j in CELLS)), few, how="inner")).select("grp", "start", *NAMES, "d")
    edges = far.groupBy("grp", "start").agg(F.percentile_approx("d", F.lit(SUPPORT), 10000).alias("edge"))
    near = _with(far, edges, few, "start").filter("d <= edge").groupBy("grp", "start").agg(*_moments())
    new = near.selectExpr("grp", "start", *(f"a_{i} AS m_{i}" for i in D), *(_regular(i, j, f"{CONSISTENCY}D * s_{i}_{j}") for i, j in CELLS))
    moved = _cholesky(_with(new, active.select("grp", "start", "n", F.col("det").alias("was")), few, "start"))
    return moved.unionByName(fit.filter(_settled()))


def _least(fit: DataFrame) -> DataFrame:
    """grp, n, m_i and c_i_j of the start with the least determinant."""
    columns = ["n", *(f"m_{i}" for i in D), *(f"c_{i}_{j}" for i, j in CELLS)]
    return fit.groupBy("grp").agg(F.min(F.struct("det", "start", *columns)).alias("best")).select("grp", *(f"best.{c}" for c in columns))


def _drawn(groups: DataFrame, wider: DataFrame) -> DataFrame:
    """The estimates of `groups` (beside them `up`, the group they are part of) drawn towards those of `wider`.

    It is the mean and covariance of a mixture of both, in which the wider one has the weight of PRIOR rows.
    """
    both = groups.join(wider.selectExpr("grp AS up", *(f"{c} AS w{c}" for c in wider.columns if c[0] in "mc")), "up")
    own, rest = f"(n / (n + {PRIOR}D))", f"({PRIOR}D / (n + {PRIOR}D))"
    means = [f"{own} * m_{i} + {rest} * wm_{i} AS m_{i}" for i in D]
    cells = [f"{own} * c_{i}_{j} + {rest} * wc_{i}_{j} + {own} * {rest} * (m_{i} - wm_{i}) * (m_{j} - wm_{j}) AS c_{i}_{j}" for i, j in CELLS]
    return both.selectExpr("grp", "n", *(x.replace(" AS m_", " AS d_m_") for x in means), *(x.replace(" AS c_", " AS d_c_") for x in cells)).toDF(*groups.drop("up").columns)


def fit(vectors: DataFrame) -> tuple[DataFrame, bool]:
    """The estimates (grp, m_i, l_i_j) of all languages with sources, and whether they are few.

    `vectors` has by_source, by_lang, base_failed and the vector of each row.
    """
    passed = vectors.filter("NOT base_failed")
    inner = staged(passed.select(F.explode(F.array(F.lit(ALL), "by_lang", "by_source")).alias("grp"), *NAMES), "quality-inner")
    now = staged(_start(inner), "quality-fit")
    few = now.count() <= BROADCAST_GROUPS
    for _ in range(STEPS):
        now = staged(_concentrated(inner, now, few), "quality-fit")
        if now.filter(~_settled()).isEmpty():
            break
    best = staged(_least(now), "quality-fit")
    ups = passed.select("by_source", "by_lang").distinct()
    lang = _drawn(best.join(ups.select(F.col("by_lang").alias("grp"), F.lit(ALL).alias("up")).distinct(), "grp"), best)
    source = _drawn(best.join(ups.select(F.col("by_source").alias("grp"), F.col("by_lang").alias("up")), "grp"), lang)
    return staged(_cholesky(source).select("grp", *(f"m_{i}" for i in D), *(f"l_{i}_{j}" for i, j in CELLS)), "quality-fit"), few


def _measured(text: Column) -> Column:
    """A struct of the counts, base_failed and the vector of a text, its statistics worked out once."""
    return let(statistics(text, extra=True), lambda s: F.struct(*(s[c].alias(c) for c in COUNTS), base_failed(s).alias("base_failed"), *(v.alias(k) for k, v in vector(s).items())))


def _keys() -> list[Column]:
    return [_key("lang", "source").alias("by_source"), _key("lang").alias("by_lang")]


def _distances(rows: DataFrame) -> DataFrame:
    """`rows` with d, the squared distance from the estimate of their language and source (null without one)."""
    estimate, few = fit(rows)
    return _distance(_with(rows.withColumn("grp", F.col("by_source")), estimate, few))


def _kept() -> Column:
    return ~F.col("base_failed") & (F.coalesce(F.col("d"), F.lit(0e0)) <= CUTOFF)


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, distance2 (null without an estimate) and kept of each row of `docs`."""
    rows = staged(docs.select("doc_id", *_keys(), _measured(F.col("text")).alias("m")).select("doc_id", "by_source", "by_lang", "m.*"), "quality-vectors")
    return _distances(rows).select("doc_id", *COUNTS, "base_failed", F.col("d").alias("distance2"), _kept().alias("kept"))


def rule_filtered(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns. They are written with their vectors, and not shuffled."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = staged(docs.select(row, *_keys(), _measured(F.col("text")).alias("m")).select("row", "by_source", "by_lang", "m.*"), "quality-rows")
    return _distances(rows).filter(_kept()).select("row.*")

"""Quality rules: base rules, then robust multivariate outliers for each language and source.

Each document has a vector of transformed statistics. For every (language, source) a
minimum-covariance-determinant estimate gives the centre and spread of the half of the
documents that lies closest together: from two robust starts (median and MAD; spatial
signs), concentration steps keep the half with the smallest Mahalanobis distances until
the determinant stays, the start with the smaller determinant wins, and one reweighted
estimate follows. A document beyond the cutoff of the distance is rejected.

A step is one combinable aggregate: counts, sums and products for each group, start and
bin of distance. A group is never gathered, so one may hold any share of the rows; what one
task sees of it is a row for each of ``BINS`` bins. Groups below ``min_rows`` are estimated
together for their language, and languages below it together; where even that is too few
only the base rules hold.
"""

from __future__ import annotations

import re
from collections import Counter
from math import sqrt
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import fresh, give_back, stored
from shelfmark.operators.lookups import lookup_join

#: Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

MIN_ROWS = 60
MAX_STEPS = 8
BINS = 512
#: Chance that a document of a normal group lies beyond the cutoff.
ALPHA = 1e-6
#: Least spread of a transformed statistic, and least variance of what is centred and divided by it, so
#: that a constant one does not reject its first exceptions.
FLOOR = 0.5
RIDGE = 0.25

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_upper")
STATS = f"struct<{', '.join(f'{name}: long' for name in COUNTS)}>"
#: Transformed statistics: logarithms of sizes and of shares. A share of nothing is 0 whatever the length, so
#: that texts without symbols or repeats do not tie these to their length.
VECTOR = (
    "ln(n_words + 1)",
    "4 * ln((word_chars + 1) / (n_words + 1))",
    "ln(1 + 50 * n_symbols / greatest(1, n_chars))",
    "ln(1 + 10 * n_dup_lines / greatest(1, n_lines))",
    "ln(1 + 10 * n_repeat_words / greatest(1, n_words))",
    "ln(1 + 50 * n_upper / greatest(1, n_chars))",
)
P = len(VECTOR)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def statistics_of(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one whole text; all 0 for a null one."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode("utf-8", "surrogatepass").split()
    lines = text.split("\n")
    repeated = 0
    if len(lines) > 1:
        seen: set[str] = set()
        for line in lines:
            if line in seen:
                repeated += 1
            elif line.strip(SPACES):
                seen.add(line)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    covered = 0
    if len(set(windows)) < len(windows):
        times, end = Counter(windows), 0
        for at, window in enumerate(windows):
            if times[window] > 1:
                covered += at + 3 - max(at, end)
                end = at + 3
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        repeated,
        covered,
        len(text),
        len(lines),
        sum(map(str.isupper, text)),
    )


def with_statistics(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` and a column ``name`` with the statistics of the text."""

    def counted(texts: pd.Series) -> pd.DataFrame:
        give_back()
        return pd.DataFrame([statistics_of(text) for text in texts], columns=list(COUNTS), dtype="int64")

    # Else a filter on the statistics is pushed below them and counts every text a second time, in a second Python worker.
    once = F.pandas_udf(counted, STATS).asNondeterministic()
    return docs.withColumn(name, once(F.col("text").cast("string")))


def base_failed(stats: str) -> Column:
    return F.expr(f"{stats}.n_words < {MIN_WORDS} OR 100 * {stats}.n_repeat_words > {MAX_REPEAT_PERCENT} * {stats}.n_words")


def chi_square(quantile: float, degrees: int) -> float:
    """The quantile of chi-square, by the cube-root transformation."""
    spread = 2 / (9 * degrees)
    return degrees * (1 - spread + NormalDist().inv_cdf(quantile) * sqrt(spread)) ** 3


def _group_keys(rows: DataFrame, min_rows: int) -> DataFrame:
    """``lang, source, key``: the estimate that speaks for each group; null where there is none."""
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = sizes.where(F.col("n") < min_rows)
    by_lang = small.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    # One number: whether what is left of all languages is enough together.
    rest = by_lang.where(F.col("n_lang") < min_rows).agg(F.sum("n_lang")).first()[0] or 0
    return (
        sizes.join(by_lang, "lang", "left")
        .select(
            "lang",
            "source",
            F.when(F.col("n") >= min_rows, F.to_json(F.array("lang", "source")))
            .when(F.col("n_lang") >= min_rows, F.to_json(F.array("lang")))
            .when(F.lit(rest >= min_rows), F.lit("[]"))
            .alias("key"),
        )
    )


def _grouped(docs: DataFrame) -> tuple[Column, Column]:
    """Language and source as texts, the null ones apart from any text."""
    lang, source = (F.col(c).cast("string") for c in ("lang", "source"))
    return (
        F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("lang"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("source"),
    )


def _centred(i: int) -> str:
    return f"(x{i} - m{i}) / s{i}"


_DISTANCE = " + ".join(f"a{i}_{j} * (z{i} - c{i}) * (z{j} - c{j})" for i, j in PAIRS)
_BIN = f"least({BINS - 1}, cast(floor(24 * ln(1 + d2)) as int))"
_BIN_TOPS = np.exp((np.arange(BINS) + 1) / 24) - 1
_PARAMS = ", ".join(
    ["key string", "start int", *(f"c{i} double" for i in range(P)), *(f"a{i}_{j} double" for i, j in PAIRS), "logdet double", "d_median double"]
)


def _binned(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Counts, sums and products of the centred statistics for each group, start and bin of distance."""
    measured = (
        lookup_join(rows, params, ["key"], spread_by="x0", how="inner")
        .withColumn("d2", F.expr(_DISTANCE))
        .withColumn("bin", F.expr(_BIN))
    )
    sums = [F.sum(f"z{i}").alias(f"t{i}") for i in range(P)]
    products = [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"t{i}_{j}") for i, j in PAIRS]
    return measured.groupBy("key", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *sums, *products)


def _estimate(bins: pd.DataFrame, upto: int) -> tuple[np.ndarray, np.ndarray]:
    part = bins.iloc[: upto + 1]
    n = part["n"].sum()
    mean = part[[f"t{i}" for i in range(P)]].sum().to_numpy() / n
    cov = np.empty((P, P))
    for i, j in PAIRS:
        cov[i, j] = cov[j, i] = part[f"t{i}_{j}"].sum() / n - mean[i] * mean[j]
    return mean, cov + RIDGE * np.eye(P)


def _row(key: str, start: int, mean: np.ndarray, cov: np.ndarray, middle: float) -> dict:
    inverse = np.linalg.inv(cov)
    row = {"key": key, "start": start, "logdet": float(np.linalg.slogdet(cov)[1]), "d_median": middle}
    row |= {f"c{i}": mean[i] for i in range(P)}
    return row | {f"a{i}_{j}": inverse[i, j] * (1 if i == j else 2) for i, j in PAIRS}


def _step(cut: float | None):
    """A concentration step on the bins of one group; with ``cut`` the reweighted estimate below it."""

    def stepped(bins: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for start, own in bins.groupby("start"):
            own = own.sort_values("bin").reset_index(drop=True)
            upto = own["n"].cumsum().to_numpy()
            middle = float(_BIN_TOPS[own["bin"][int(np.searchsorted(upto, (upto[-1] + 1) // 2))]])
            if cut is None:
                last = int(np.searchsorted(upto, (upto[-1] + P + 1) // 2))
            else:
                # Distances are scaled so that their median is that of chi-square.
                tops = _BIN_TOPS[own["bin"].to_numpy()] * chi_square(0.5, P) / middle
                last = max(int(np.searchsorted(tops, cut, "right")) - 1, int(np.searchsorted(upto, upto[-1] // 2)))
            mean, cov = _estimate(own, min(last, len(own) - 1))
            rows.append(_row(own["key"][0], int(start), mean, cov, middle))
        return pd.DataFrame(rows)

    return stepped


def _signs(bins: pd.DataFrame) -> pd.DataFrame:
    """The two starts: unit spread, and the spread of the spatial signs with each one's own scale."""
    own = bins.iloc[0]
    cov = np.empty((P, P))
    for i, j in PAIRS:
        cov[i, j] = cov[j, i] = own[f"t{i}_{j}"] / own["n"]
    cov = cov * P + 0.05 * np.eye(P)
    rows = [_row(own["key"], k, np.zeros(P), c, 0.0) for k, c in enumerate((np.eye(P), cov))]
    return pd.DataFrame(rows)


def fit(docs: DataFrame, stats: str, min_rows: int = MIN_ROWS, max_steps: int = MAX_STEPS) -> DataFrame:
    """One row for each (lang, source): its medians, spreads, centre, inverse spread and scale of distance."""
    vector = [F.expr(text).alias(f"x{i}") for i, text in enumerate(VECTOR)]
    rows = docs.where(~base_failed(stats)).select(*_grouped(docs), F.col(f"{stats}.*")).select("lang", "source", *vector)
    rows = stored(rows, "vectors")
    keys = stored(_group_keys(rows, min_rows).where("key IS NOT NULL"), "keys")
    keyed = lookup_join(rows, keys, ["lang", "source"], spread_by="x0", how="inner").drop("lang", "source")
    middle = stored(keyed.groupBy("key").agg(*(F.percentile_approx(f"x{i}", 0.5, 2000).alias(f"m{i}") for i in range(P))), "medians")
    away = lookup_join(keyed, middle, ["key"], spread_by="x0", how="inner")
    spread = away.groupBy("key").agg(
        *(F.greatest(F.lit(FLOOR), 1.4826 * F.percentile_approx(F.abs(F.expr(f"x{i} - m{i}")), 0.5, 2000)).alias(f"s{i}") for i in range(P))
    )
    scales = stored(middle.join(spread, "key"), "scales")
    rows = lookup_join(keyed, scales, ["key"], spread_by="x0", how="inner")
    rows = stored(rows.select("key", "x0", *(F.expr(_centred(i)).alias(f"z{i}") for i in range(P))), "centred")

    length = " + ".join(f"z{i} * z{i}" for i in range(P))
    signs = rows.withColumn("length", F.expr(f"greatest({length}, 1e-12)"))
    products = [F.sum(F.expr(f"z{i} * z{j} / length")).alias(f"t{i}_{j}") for i, j in PAIRS]
    starts = signs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *products)
    params = stored(starts.groupBy("key").applyInPandas(_signs, _PARAMS), "starts")
    before = None
    for _ in range(max_steps):
        params = stored(_binned(rows, params).groupBy("key").applyInPandas(_step(None), _PARAMS), "step")
        # One number: the largest change of a determinant.
        now = params.select("key", "start", "logdet")
        if before is not None:
            moved = now.join(before.withColumnRenamed("logdet", "was"), ["key", "start"])
            if (moved.agg(F.max(F.abs(F.expr("logdet - was")))).first()[0] or 0) < 1e-3:
                break
        before = now
    best = params.groupBy("key").agg(F.min(F.struct("logdet", "start")).alias("best")).selectExpr("key", "best.start start")
    params = stored(params.join(best, ["key", "start"]).select(*params.columns), "raw")
    params = stored(_binned(rows, params).groupBy("key").applyInPandas(_step(chi_square(0.975, P)), _PARAMS), "reweighted")
    final = _binned(rows, params).groupBy("key").applyInPandas(_step(None), _PARAMS).select("key", F.col("d_median").alias("scale"))
    return stored(keys.join(scales, "key").join(params.drop("d_median", "start", "logdet"), "key").join(final, "key"), "estimates")


def judged(docs: DataFrame, alpha: float = ALPHA, min_rows: int = MIN_ROWS) -> tuple[DataFrame, str, str, str]:
    """``docs`` with statistics, ``base_failed`` and ``kept``, and the names of these three columns.

    All rows and columns stay. A null text counts as empty, and null languages and sources are
    groups of their own. Repeated rows count as often as they stand there and share their verdict. An
    empty table stays empty.
    """
    stats, failed, kept = (fresh(docs, name) for name in ("stats", "base_failed", "kept"))
    counted = with_statistics(docs, stats)
    estimates = fit(counted, stats, min_rows)
    taken = {name: fresh(docs, f"est_{name}") for name in estimates.columns}
    renamed = estimates.select(*(F.col(a).alias(b) for a, b in taken.items()))
    lang, source = _grouped(docs)
    marks = [fresh(docs, name) for name in ("mark_lang", "mark_source")]
    marked = counted.withColumn(marks[0], lang).withColumn(marks[1], source)
    renamed = renamed.withColumnsRenamed({taken["lang"]: marks[0], taken["source"]: marks[1]})
    joined = lookup_join(marked, renamed, marks, spread_by=stats)
    z = [
        (F.expr(_qualified(text, stats)) - F.col(taken[f"m{i}"])) / F.col(taken[f"s{i}"]) - F.col(taken[f"c{i}"])
        for i, text in enumerate(VECTOR)
    ]
    distance = sum((F.col(taken[f"a{i}_{j}"]) * z[i] * z[j] for i, j in PAIRS), F.lit(0.0))
    cutoff = chi_square(1 - alpha, P) / chi_square(0.5, P)
    # Where statistics are constant distances are short; the scale only ever widens the cutoff.
    within = F.coalesce(distance <= cutoff * F.greatest(F.col(taken["scale"]), F.lit(chi_square(0.5, P))), F.lit(True))
    done = joined.withColumn(failed, base_failed(stats)).withColumn(kept, ~F.col(failed) & within)
    return done.select(*docs.columns, stats, failed, kept), stats, failed, kept


def _qualified(text: str, stats: str) -> str:
    return re.sub(r"\b(n_\w+|word_chars)\b", rf"{stats}.\1", text)

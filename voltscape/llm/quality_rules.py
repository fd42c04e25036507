"""Quality rules: robust multivariate outliers by language and source."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltscape.functions.joins import BROADCAST_ROWS
from voltscape.functions.staging import stage
from voltscape.llm.common import attach, map_rows

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PUNCTUATION = b"!\"'(),-./:;?@[\\]^_`{}~+="
_SPACES = " \t\n\x0b\x0c\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_punctuation", "n_bytes")
#: The transformed statistics, and the least scale each may have: a statistic that hardly varies
#: in a group (often it is 0 for most documents) rejects nothing for a small difference.
STATISTICS = {
    "ln(word_chars / n_words)": 0.15,
    "ln(1 + 100 * n_symbols / n_words)": 0.5,
    "ln(1 + 100 * n_dup_lines / n_words)": 0.5,
    "ln(1 + 100 * n_repeat_words / n_words)": 0.7,
    "ln(1 + 100 * n_upper / n_bytes)": 0.3,
    "ln(1 + 100 * n_punctuation / n_bytes)": 0.3,
}
DIMENSIONS = len(STATISTICS)
#: Share of a group that must agree: the most robust choice.
HALF = 0.5
#: Concentration steps that every start takes before the best of a group goes on alone.
FIRST_STEPS = 2
#: A search ends with a step that takes no more than this from the logarithm of the determinant.
SETTLED = 0.01
#: Places between the numbers of two groups: a group's starts, or its statistics, are numbered from there.
#: One long number as a key keeps a broadcast table at its own size; any other key costs a page of memory.
PLACES = 8
#: Statistics are whole millionths, so that no sum depends on the order of its terms.
UNIT = 1_000_000
#: The group of a unit.
_ID = f"unit - pmod(unit, {PLACES})"
#: Squared Mahalanobis distance above which a document is rejected. It lies far out, as the statistics of
#: clean texts have longer tails than the normal law.
CUTOFF = 40.0


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) > len(words) - 2:
        return 0  # at most one word is used twice; no window can be
    n = len(known)
    if n < 2_000_000:
        windows = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:
        pairs = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)[1]
        windows = pairs * n + ids[2:]
    order = np.argsort(windows, kind="stable")
    equal = windows[order[1:]] == windows[order[:-1]]
    found = np.zeros(len(windows), bool)
    found[order[1:][equal]] = True
    found[order[:-1][equal]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(found)] |= found
    return int(covered.sum())


def counts_of(text: str) -> tuple[int, ...]:
    """COUNTS and MORE of one text."""
    data = text.encode()
    words = data.split()
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    again = 0
    for line in data.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip():
            seen.add(line)
    upper = len(data) - len(data.translate(None, _UPPER))
    punctuation = len(data) - len(data.translate(None, _PUNCTUATION))
    return len(words), chars, symbols, again, repeat_words(words), upper, punctuation, len(data)


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in (*COUNTS, *MORE)]))
def _counted(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([counts_of(text or "") for text in texts], columns=[*COUNTS, *MORE])


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep` and the counts of every row."""
    return docs.select(*keep, _counted("text").alias("_counts")).select(*keep, "_counts.*")


def base_failed() -> str:
    return f"(n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)"


def _vector() -> str:
    """The statistics, in whole millionths."""
    return f"array({', '.join(f'cast(round({s} * {UNIT}) as bigint)' for s in STATISTICS)})"


def _vectors(counted: DataFrame) -> DataFrame:
    """One row per document that passes the base rules: group (lang, source) and its vector `q`."""
    return counted.where(f"not {base_failed()}").selectExpr("struct(lang, source) as grp", f"{_vector()} as q")


def _moments(rows: DataFrame) -> DataFrame:
    """Per unit (group and start): rows, sums and sums of products, exact, partly summed before the shuffle."""
    d = DIMENSIONS
    sums = ", ".join(f"sum(q[{i}])" for i in range(d))
    products = ", ".join(f"sum(cast(q[{i}] * q[{j}] as decimal(18,0)))" for i in range(d) for j in range(i, d))
    return rows.groupBy("unit").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"array({sums}) as s"), F.expr(f"array({products}) as p")
    )


def ranked(
    rows: DataFrame, keys: list[str], value: str, shares: tuple[float, ...], near: Callable[[DataFrame], DataFrame] = F.broadcast
) -> DataFrame:
    """(keys, share, value): for each share of a group's rows the smallest value that so many rows
    don't exceed, exactly. Values are counted in steps of a scale first; then equal values within the
    one step that holds the rank, so no task sees a group's rows. `near` is how a row per group
    and share is joined: broadcast, if that many are known to be few. It is joined by the group alone,
    and the step is compared afterwards, so that one long number can be the key."""
    step = f"cast(floor(asinh({value}) * 1024) as bigint)"
    listed = ", ".join(keys)
    counts = rows.groupBy(*keys, F.expr(f"{step} as _step")).agg(F.count(F.lit(1)).alias("_n"))
    upto = f"sum(_n) over (partition by {listed} order by _step rows unbounded preceding)"
    cumulated = counts.selectExpr("*", f"{upto} as _upto", f"sum(_n) over (partition by {listed}) as _all")
    ranks = f"explode(array({', '.join(f'{share}D' for share in shares)})) as share"
    wanted = cumulated.selectExpr("*", ranks).selectExpr("*", "cast(ceil(_all * share) as bigint) - (_upto - _n) as _rank")
    held = wanted.where("_rank between 1 and _n").selectExpr(*keys, "_step as _at", "share", "_rank")
    inside = rows.selectExpr(*keys, f"{value} as _v", f"{step} as _step").join(near(held), keys).where("_step between _at and _at")
    equal = inside.groupBy(*keys, "share", "_rank", "_v").agg(F.count(F.lit(1)).alias("_n"))
    order = f"sum(_n) over (partition by {listed}, share order by _v rows unbounded preceding)"
    found = equal.selectExpr("*", f"{order} as _upto").where("_upto >= _rank and _upto - _n < _rank")
    return found.selectExpr(*keys, "share", f"_v as {value}")


def _starts(rows: DataFrame, near: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """unit, centre, inverse: where the search starts. The medians, the lower and the upper
    quartiles, each with the least scales; the medians with scales from the quartiles; and the
    medians with the scatter of the directions from there."""
    d = DIMENSIONS
    floors = list(STATISTICS.values())
    each = rows.selectExpr("id", "posexplode(q) as (i, v)").selectExpr("id + i as unit", f"v / {UNIT}D as v")
    marks = ranked(each, ["unit"], "v", (0.25, 0.5, 0.75), near).selectExpr(f"{_ID} as id", f"pmod(unit, {PLACES}) as i", "share", "v")

    def of(share: float) -> str:
        return f"transform(array_sort(collect_list(if(share = {share}D, struct(i, v), null))), c -> c.v)"

    quartiles = stage(marks.groupBy("id").agg(*(F.expr(f"{of(s)} as c{i}") for i, s in enumerate((0.25, 0.5, 0.75)))), "quartiles")
    # the quartiles of a normal law are 1.349 deviations apart
    spread = "zip_with(zip_with(c2, c0, (a, b) -> (a - b) / 1.349D), floors, (a, b) -> greatest(a, b))"
    scaled = f"array({', '.join(f'{f!r}D' for f in floors)})"
    sides = rows.join(near(quartiles), "id").selectExpr(
        "id", f"zip_with(zip_with(q, c1, (a, b) -> a / {UNIT}D - b), {scaled}, (a, f) -> a / f) as u"
    )
    length = "sqrt(aggregate(u, 0D, (s, v) -> s + v * v))"
    signs = sides.selectExpr("id + 4 as unit", f"transform(u, v -> cast(round(v / greatest({length}, 1e-9D) * {UNIT}) as bigint)) as q")
    by_sign = _moments(signs).join(near(quartiles.selectExpr("id + 4 as unit", "c1")), "unit")
    shape = "unit long, centre array<double>, inverse array<double>"

    def turned(batch: dict[str, list]) -> dict[str, list]:
        inverses = []
        for n, products in zip(batch["n"], batch["p"]):
            scatter = np.zeros((d, d))
            scatter[np.triu_indices(d)] = np.array(products, float) / n / UNIT**2
            scatter += np.triu(scatter, 1).T
            # directions have unit scales: back to the statistics' own
            own = scatter * d * np.outer(floors, floors) + np.diag(np.square(floors))
            inverses.append(np.linalg.inv(own).ravel().tolist())
        return {"unit": batch["unit"], "centre": batch["c1"], "inverse": inverses}

    diagonal = f"flatten(transform(sequence(0, {d - 1}), i -> transform(sequence(0, {d - 1}), j -> if(i = j, 1 / pow(w[i], 2), 0D))))"
    plain = quartiles.selectExpr("id", "c0", "c1", "c2", f"{scaled} as floors").selectExpr(
        "id", "inline(array(" + ", ".join(
            f"struct({i} as start, {centre} as centre, {scales} as w)"
            for i, (centre, scales) in enumerate([("c1", "floors"), ("c0", "floors"), ("c2", "floors"), ("c1", spread)])
        ) + "))"
    ).selectExpr("id + start as unit", "centre", f"{diagonal} as inverse")
    return plain.unionByName(map_rows(by_sign, shape, turned))


def _estimate(n: list[int], sums: list[list[float]], products: list[list[float]]) -> tuple[list, list, list]:
    """Centres, inverse scatter matrices (row by row) and log determinants."""
    d = DIMENSIONS
    count = np.array(n, float)[:, None]
    mean = np.array(sums, float).reshape(-1, d) / count / UNIT
    scatter = np.zeros((len(n), d, d))
    upper = np.triu_indices(d)
    scatter[:, upper[0], upper[1]] = np.array(products, float).reshape(-1, len(upper[0])) / count / UNIT**2
    scatter += np.triu(scatter, 1).transpose(0, 2, 1)
    scatter -= mean[:, :, None] * mean[:, None, :]
    # the floor keeps every matrix regular, also that of a group of one document
    scatter += np.diag(np.square(list(STATISTICS.values())))
    return mean.tolist(), np.linalg.inv(scatter).reshape(-1, d * d).tolist(), np.linalg.slogdet(scatter)[1].tolist()


def _shapes(moments: DataFrame) -> DataFrame:
    def kernel(batch: dict[str, list]) -> dict[str, list]:
        if not batch["n"]:
            return {"unit": [], "centre": [], "inverse": [], "logdet": []}
        centre, inverse, logdet = _estimate(batch["n"], batch["s"], batch["p"])
        return {"unit": batch["unit"], "centre": centre, "inverse": inverse, "logdet": logdet}

    return map_rows(moments, "unit long, centre array<double>, inverse array<double>, logdet double", kernel)


def _step(rows: DataFrame, shapes: DataFrame, near: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One concentration step of every group and start of `shapes`: the half of the group nearest to
    the centre gives the next centre and scatter. One job over the rows."""
    measured = _measured(rows.join(near(shapes.selectExpr("*", f"{_ID} as id")), "id")).select("unit", "q", "d2")
    halves = ranked(measured, ["unit"], "d2", (HALF,), near).withColumnRenamed("d2", "_most").drop("share")
    return _shapes(_moments(measured.join(near(halves), "unit").where("d2 <= _most")))


def _measured(rows: DataFrame) -> DataFrame:
    """`d2`: the squared Mahalanobis distance of `q`, from centre and inverse; NULL without q. Written
    out, so that it is compiled."""
    d = DIMENSIONS
    gap = [f"(q[{i}] / {UNIT}D - centre[{i}])" for i in range(d)]
    squares = (f"inverse[{i * d + i}] * {gap[i]} * {gap[i]}" for i in range(d))
    products = (f"2 * inverse[{i * d + j}] * {gap[i]} * {gap[j]}" for i in range(d) for j in range(i + 1, d))
    return rows.withColumn("d2", F.expr(" + ".join((*squares, *products))))


def fit(counted: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimate of every (lang, source) group: grp, centre,
    inverse, logdet, scale, from all documents that pass the base rules.

    From several starts, concentration steps seek the half of the group whose scatter has the least
    determinant: the half nearest to the present centre, by Mahalanobis distance, gives the next
    centre and scatter, whose determinant can't rise. After FIRST_STEPS the start with the least
    determinant goes on alone, until its fall has settled. A step is a few
    grouped aggregations over all rows, partly summed before the shuffle, so a hot group is spread
    over all tasks. Halves and sums are exact: neither partitions nor reruns change the result.
    """
    d = DIMENSIONS
    vectors = _vectors(counted)
    groups = stage(
        vectors.select("grp").distinct().select("grp", (F.monotonically_increasing_id() * PLACES).alias("id")), "groups"
    )
    # a row or so for each group, start and statistic is all that is joined with the rows
    few = groups.count() <= BROADCAST_ROWS // (3 * d)

    def near(small: DataFrame) -> DataFrame:
        return F.broadcast(small) if few else small

    rows = stage(vectors.join(near(groups), "grp").select("id", "q"), "vectors")
    shapes = stage(_starts(rows, near), "starts")
    for _ in range(FIRST_STEPS):
        shapes = stage(_step(rows, shapes, near), "shapes")
    best = "min_by(struct(unit, centre, inverse, logdet), struct(round(logdet, 9), unit)) as _best"
    shapes = stage(shapes.groupBy(F.expr(_ID)).agg(F.expr(best)).select("_best.*"), "best")
    done = []
    while not shapes.isEmpty():
        told = _step(rows, shapes, near).selectExpr("unit", "centre as _centre", "inverse as _inverse", "logdet as _logdet")
        both = stage(shapes.join(told, "unit"), "fallen")
        done.append(both.where(f"_logdet >= logdet - {SETTLED}D").select("unit", "centre", "inverse", "logdet"))
        # only groups whose determinant has fallen go on
        go_on = both.where(f"_logdet < logdet - {SETTLED}D")
        shapes = go_on.selectExpr("unit", "_centre as centre", "_inverse as inverse", "_logdet as logdet")
    shapes = stage(reduce(DataFrame.union, done), "shapes") if done else shapes
    # a half's scatter is too small: scale it so that the median distance is that of the normal law
    median = d * (1 - 2 / (9 * d)) ** 3
    shapes = shapes.selectExpr(f"{_ID} as id", "centre", "inverse", "logdet")
    measured = _measured(rows.join(near(shapes), "id")).select("id", "d2")
    middle = ranked(measured, ["id"], "d2", (0.5,), near)
    scale = middle.selectExpr("id", f"greatest(d2 / {median!r}D, 1D) as scale")
    return stage(groups.join(shapes, "id").join(scale, "id").drop("id"), "shapes")


def judged(counted: DataFrame, shapes: DataFrame) -> DataFrame:
    """`counted` with base_failed, d2 (NULL where the base rules reject) and kept."""
    known = counted.selectExpr("*", "struct(lang, source) as grp", f"{base_failed()} as base_failed")
    # a document with base_failed has no vector, and its group may have no shape
    placed = attach(known, shapes, ["grp"], "left").selectExpr(
        "*", f"if(base_failed, null, {_vector()}) as q"
    )
    far = _measured(placed).withColumn("d2", F.expr("d2 / scale"))
    return far.selectExpr("*", f"not base_failed and coalesce(d2 <= {CUTOFF}, true) as kept").drop(
        "q", "grp", "centre", "inverse", "logdet", "scale"
    )


def quality(docs: DataFrame) -> DataFrame:
    """The counts, base_failed, d2 and kept of every row of `docs` (doc_id, text, lang, source).

    Base rules: at least 50 words, and at most half of the words in 3-word windows that occur
    twice. The others are compared with their (lang, source) group: a document whose transformed
    statistics lie farther than CUTOFF from the group's robust centre is rejected. NULL and empty
    texts have no words and fail the base rules. NULL lang or source is a group of its own. A
    group too small to have a spread has the least scales, and a group of one keeps its document.
    Repeated rows count as rows and come out repeated; an empty table gives an empty result;
    other columns are ignored.
    """
    counted = stage(statistics(docs, "doc_id", "lang", "source"), "statistics")
    return judged(counted, fit(counted))


def good_rows(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with all columns. The statistics are computed once for
    the fit and once to judge, so no text is shuffled."""
    shapes = fit(stage(statistics(docs, "lang", "source"), "statistics"))
    packed = docs.select(F.struct("*").alias("_row"), "text", "lang", "source")
    return judged(statistics(packed, "_row", "lang", "source"), shapes).where("kept").select("_row.*")

"""Filters, joins, aggregations, windows and report shaping over typed tables (DataFrame to DataFrame).

Ratios are doubles. ``nulls`` says where nulls go in a descending order: databases differ, so it is explicit.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marajo.operators.observed import unique_on
from marajo.operators.ordered import over_order


def _cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _desc(name: str, nulls: str) -> Column:
    return F.desc_nulls_first(name) if nulls == "first" else F.desc_nulls_last(name)


def ratio_change(now: Column, then: Column, digits: int = 1) -> Column:
    """Percent change of ``now`` on ``then``, null where ``then`` is null or 0."""
    return F.round((F.try_divide(now.cast("double"), then.cast("double")) - 1) * 100, digits)


# --- filters ------------------------------------------------------------------------------------------------


def require_any(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in which any of the columns has a value."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols]))


def last_quarters(year: str, quarter: str, end_year: int, end_quarter: int, n: int = 4) -> Column:
    """Condition: within the ``n`` quarters that end with the given one."""
    at = F.col(year) * 4 + F.col(quarter)
    end = end_year * 4 + end_quarter
    return at.between(end - n + 1, end)


def quarter_end_months(df: DataFrame, month: str) -> DataFrame:
    return df.where(F.col(month) % 3 == 0)


def credits_absolute(df: DataFrame, flag: str, amounts: Sequence[str], credit=1) -> DataFrame:
    """Rows of the credit type with their signed amounts made absolute."""
    return df.where(F.col(flag) == credit).withColumns({c: F.abs(c) for c in amounts})


def gate_rows(df: DataFrame, col: str, prefix: str = "20") -> DataFrame:
    """Rows whose text starts with the prefix; null and other rows are refused."""
    return df.where(F.col(col).startswith(prefix))


# --- joins --------------------------------------------------------------------------------------------------


def enrich(base: DataFrame, parts: Sequence[tuple[DataFrame, str | Sequence[str]]], checked: bool = True) -> DataFrame:
    """Left equi-joins of a star; each part must be unique on its keys. Small parts are broadcast by their size.

    A part that repeats a key fails the job (null keys match nothing and may repeat). ``checked=False`` leaves that out,
    for parts that are unique by the way they are made.
    """
    unique = (lambda part, keys: unique_on(part, keys)) if checked else (lambda part, keys: part)
    return reduce(lambda df, part: df.join(unique(part[0], _cols(part[1])), _cols(part[1]), "left"), parts, base)


def full_outer_coalesce(a: DataFrame, b: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Full outer join with one column for each key."""
    return a.join(b, _cols(keys), "full")


def join_on_root(a: DataFrame, b: DataFrame, root_a: Column, root_b: Column, how: str = "inner") -> DataFrame:
    """Join on derived keys; both are plain expressions, so it stays a hash or merge join."""
    return a.withColumn("_root", root_a).join(b.withColumn("_root", root_b), "_root", how).drop("_root")


def join_prior(df: DataFrame, keys: Sequence[str], year: str, measures: Sequence[str], lag: int = 1) -> DataFrame:
    """The measures of ``lag`` years before beside each row, as ``<measure>_prior``; null where there is no such row.

    One exchange on the keys: a window with a value range looks the prior year up. Keys with year must be unique.
    """
    w = Window.partitionBy(*keys).orderBy(year).rangeBetween(-lag, -lag)
    return df.withColumns({f"{m}_prior": F.max(m).over(w) for m in measures})


def cross_scalars(*frames: DataFrame) -> DataFrame:
    """One row of the columns of frames that have a single row each; a job that finds another number of rows fails, as they
    would multiply. Nothing runs before."""

    def only(frame: DataFrame) -> DataFrame:
        one = frame.agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*frame.columns)).alias("row"))
        found = F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(F.lit(f"not a single row: {frame.columns}")))
        return one.select(found.alias("row")).select("row.*")

    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), map(only, frames))


def densify(facts: DataFrame, keys: str | Sequence[str], category: str, categories: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A row for each key and listed category with ``position``; missing measures are 0, unlisted categories go."""
    keys = _cols(keys)
    order = F.create_map(*[x for i, c in enumerate(categories, 1) for x in (F.lit(c), F.lit(i))])
    grid = facts.select(*keys).distinct().select(*keys, F.explode(F.array(*[F.lit(c) for c in categories])).alias(category))
    return grid.join(facts.select(*keys, category, *measures), [*keys, category], "left").fillna(0, list(measures)).withColumn(
        "position", order[F.col(category)]
    )


def unlisted(facts: DataFrame, category: str, categories: Sequence[str]) -> int:
    """How many rows :func:`densify` leaves out."""
    return facts.where(~F.coalesce(F.col(category).isin(*categories), F.lit(False))).count()


def compare_at_dates(periods: DataFrame, series: Mapping[str, tuple[DataFrame, str, str]], roles: Sequence[str]) -> DataFrame:
    """Each series' value at each reference date of ``periods``: ``series`` maps a name to (frame, date, value).

    All series are stacked and meet the exploded dates in one join and one aggregation; a series is read once, and only
    at the dates that are asked for.
    """
    ids = [c for c in periods.columns if c not in roles]
    long = periods.select(*ids, F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("at")) for r in roles])).alias("r"))
    stacked = reduce(
        DataFrame.unionByName,
        [f.select(F.lit(n).alias("_name"), F.col(d).alias("_at"), F.col(v).cast("double").alias("_value")) for n, (f, d, v) in series.items()],
    )
    at = long.join(stacked, F.col("r.at") == F.col("_at"), "left")
    pick = lambda n, r: F.max(F.when((F.col("_name") == n) & (F.col("r.role") == r), F.col("_value"))).alias(f"{n}_{r}")
    wide = at.groupBy(*ids).agg(*[pick(n, r) for n in series for r in roles])
    return periods.join(wide, ids, "left")


def unprocessed(files: DataFrame, ledger: DataFrame, key: str = "path") -> DataFrame:
    return files.join(ledger.select(key).distinct(), key, "left_anti")


def order_by_lookup(df: DataFrame, lookup: DataFrame, key: str, order: str) -> DataFrame:
    """``df`` sorted by a lookup's order of its key."""
    return df.join(lookup.select(key, F.col(order).alias("_order")), key, "left").orderBy("_order").drop("_order")


# --- aggregations -------------------------------------------------------------------------------------------


def pivot_codes(df: DataFrame, keys: str | Sequence[str], code: str, value: str, mapping: Mapping[str, str]) -> DataFrame:
    """Long code and value to one column per listed code (the largest value, as codes are unique per key)."""
    return df.groupBy(*_cols(keys)).agg(*[F.max(F.when(F.col(code) == k, F.col(value))).alias(name) for k, name in mapping.items()])


def pivot_periods(df: DataFrame, keys: str | Sequence[str], period: str, value: str, periods: Sequence[str]) -> DataFrame:
    """One column per listed period; the list spares a pass that would look for the periods."""
    return df.groupBy(*_cols(keys)).pivot(period, list(periods)).agg(F.sum(value))


def weighted_avg(value: Column, weight: Column, digits: int = 2) -> Column:
    total = F.sum(weight)
    return F.coalesce(F.when(total > 0, F.round(F.sum(value * weight) / total, digits)), F.lit(0.0))


def ratio_of_sums(n: Column, d: Column, scale: float = 100.0, digits: int = 2) -> Column:
    total = F.sum(d)
    return F.coalesce(F.when(total > 0, F.round(F.sum(n) / total * scale, digits)), F.lit(0.0))


def with_total(df: DataFrame, keys: Sequence[str], group: str, measures: Sequence[str], label: str = "TOTAL") -> DataFrame:
    """Sums by keys and group, and a row ``label`` for each key, from one aggregation (grouping sets)."""
    sets = df.groupingSets([[*keys, group], list(keys)], *keys, group)
    found = sets.agg(*[F.sum(m).alias(m) for m in measures], F.grouping(group).alias("_whole"))
    return found.select(*keys, F.when(F.col("_whole") == 1, label).otherwise(F.col(group)).alias(group), *measures)


def two_level(df: DataFrame, unit: str, region: str, counts: Mapping[str, str], sums: Sequence[str], averages: Sequence[str]) -> DataFrame:
    """Rows by unit, and by region *computed from the unit rows*: distinct counts and sums are added up, averages
    are averages of averages. ``level`` tells them apart."""
    units = df.groupBy(unit, region).agg(
        *[F.count_distinct(c).alias(n) for n, c in counts.items()], *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], *[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in averages]
    )
    regions = units.groupBy(region).agg(*[F.sum(c).alias(c) for c in [*counts, *sums]], *[F.avg(c).alias(c) for c in averages])
    tidy = lambda x, name, level: x.select(name.cast("string").alias("area"), F.col(region).cast("string").alias("region"), F.lit(level).alias("level"), *counts, *sums, *[F.round(c, 1).alias(c) for c in averages])
    return tidy(units, F.col(unit), "unit").unionByName(tidy(regions, F.col(region), "region"))


def share_of_total(df: DataFrame, keys: Sequence[str], group: str, measures: Sequence[str], label: str = "TOTAL", digits: int = 1) -> DataFrame:
    """``<measure>_share``: percent of the keys' total, rows labelled ``label`` left out of the total."""
    w = Window.partitionBy(*keys)
    total = lambda m: F.sum(F.when(F.col(group) != label, F.col(m))).over(w)
    return df.withColumns({f"{m}_share": F.round(F.try_divide(F.col(m), total(m)) * 100, digits) for m in measures})


def band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first edge the value doesn't exceed; the last label beyond, null included."""
    out = F
    for edge, label in zip(edges, labels, strict=False):
        out = out.when(value <= edge, label)
    return out.otherwise(labels[len(edges)])


def band_counts(df: DataFrame, keys: Sequence[str], value: str, edges: Sequence[float], labels: Sequence[str], measure: str | None = None) -> DataFrame:
    """Rows (and a measure's sum) by keys and band, with the band's ``position``."""
    position = F.create_map(*[x for i, b in enumerate(labels, 1) for x in (F.lit(b), F.lit(i))])
    more = [F.coalesce(F.sum(measure), F.lit(0)).alias(measure)] if measure else []
    out = df.groupBy(*keys, band(F.col(value), edges, labels).alias("band")).agg(F.count(F.lit(1)).alias("n"), *more)
    return out.withColumn("position", position[F.col("band")])


def monthly_totals(df: DataFrame, keys: Sequence[str], at: str, amounts: Sequence[str]) -> DataFrame:
    """Sums by keys and month (its first day); rows without a date take no part."""
    month = F.trunc(F.col(at).cast("date"), "month").alias("month")
    return df.where(F.col(at).isNotNull()).groupBy(*keys, month).agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(a), F.lit(0.0)).alias(a) for a in amounts])


def risk_score(df: DataFrame, weights: Mapping[str, int], cuts: Sequence[tuple[int, str]], above: str) -> DataFrame:
    """Weighted sum of alert counts, and the class of the first cut that it doesn't exceed."""
    score = reduce(lambda a, b: a + b, [F.col(c) * w for c, w in weights.items()])
    out = F
    for cut, label in cuts:
        out = out.when(F.col("risk_score") <= cut, label)
    return df.withColumn("risk_score", score).withColumn("risk_class", out.otherwise(above))


def latest_stamp(*cols: str) -> Column:
    """Latest of several audit stamps, nulls skipped."""
    return F.greatest(*cols) if len(cols) > 1 else F.col(cols[0])


# --- windows ------------------------------------------------------------------------------------------------


#: As ``partition``: all rows are one series, too many for one task (see ``ordered.over_order``).
RANGED = "ranged"

Partition = Sequence[str] | str | None


def _windowed(df: DataFrame, order: str | Sequence[str], partition: Partition, back: int, name: str, make: Callable[[WindowSpec], Column]) -> DataFrame:
    """``df`` with ``name``, made of a window that looks back at most ``back`` rows.

    Without a partition all rows meet in one task: give one, aggregate to the period grain first, or say ``RANGED``.
    """
    if partition == RANGED:
        return over_order(df, _cols(order), back, lambda w: {name: make(w)})
    return df.withColumn(name, make(Window.partitionBy(*(partition or [])).orderBy(*_cols(order))))


def pct_change(df: DataFrame, value: str, order: str | Sequence[str], k: int = 1, partition: Partition = None, digits: int = 1, name: str | None = None) -> DataFrame:
    """Percent change against the value ``k`` rows before; null if that is null or 0."""
    return _windowed(df, order, partition, k, name or f"{value}_change_{k}", lambda w: ratio_change(F.col(value), F.lag(value, k).over(w), digits))


def ratio_of_rates(df: DataFrame, rate: str, order: str | Sequence[str], k: int = 12, partition: Partition = None, name: str | None = None) -> DataFrame:
    """``(1 + rate) / (1 + rate k rows before) - 1``: a ratio of two single-period rates, not compounding."""
    return _windowed(df, order, partition, k, name or f"{rate}_ratio_{k}", lambda w: F.try_divide(1 + F.col(rate), 1 + F.lag(rate, k).over(w)) - 1)


def compound_rates(df: DataFrame, rate: str, order: str | Sequence[str], n: int = 12, partition: Partition = None, name: str | None = None) -> DataFrame:
    """Compounded rate of the last ``n`` rows, null before there are ``n``."""

    def make(w: WindowSpec) -> Column:
        last = w.rowsBetween(-n + 1, 0)
        return F.when(F.count(rate).over(last) == n, F.exp(F.sum(F.log1p(rate)).over(last)) - 1)

    return _windowed(df, order, partition, n - 1, name or f"{rate}_compound_{n}", make)


def rolling_sum(df: DataFrame, value: str, order: str | Sequence[str], n: int = 12, partition: Partition = None, name: str | None = None) -> DataFrame:
    return _windowed(df, order, partition, n - 1, name or f"{value}_rolling_{n}", lambda w: F.sum(value).over(w.rowsBetween(-n + 1, 0)))


def ytd(df: DataFrame, value: str, year: str, order: str, partition: Sequence[str] = ()) -> DataFrame:
    """``<value>_ytd`` and ``<value>_ytd_max``: running sum and maximum within the year."""
    w = Window.partitionBy(*partition, year).orderBy(order)
    return df.withColumn(f"{value}_ytd", F.sum(value).over(w)).withColumn(f"{value}_ytd_max", F.max(value).over(w))


def cumulative_progress(df: DataFrame, key: str, at: str, amount: str, total: str) -> DataFrame:
    """``accumulated`` by key in order of time, and ``progress``: its percent of ``total``, 0 without one."""
    w = Window.partitionBy(key).orderBy(at)
    out = df.withColumn("accumulated", F.sum(amount).over(w))
    return out.withColumn("progress", F.when(F.coalesce(F.col(total), F.lit(0)) > 0, F.round(F.col("accumulated") / F.col(total) * 100, 2)).otherwise(0.0))


def period_close(df: DataFrame, keys: Sequence[str], at: str, value: str, unit: str = "month") -> DataFrame:
    """Last value of each period: one partial aggregation instead of a window over every row."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, F.to_date(F.date_trunc(unit, at)).alias("period")).agg(F.max_by(value, at).alias(value))


def change_since_start(df: DataFrame, value: str, order: str | Sequence[str], partition: Partition = None, digits: int = 1) -> DataFrame:
    """Percent change since the first row of the series; with ``RANGED`` the first of all is looked up by an aggregate."""
    name = f"{value}_since_start"
    if partition == RANGED:
        rank = F.struct(*[x for i, c in enumerate(_cols(order)) for x in (F.col(c).isNotNull().alias(f"n{i}"), F.col(c).alias(f"c{i}"))])
        first = df.agg(F.min_by(F.struct(value), rank)[value].alias("_first"))
        return df.crossJoin(F.broadcast(first)).withColumn(name, ratio_change(F.col(value), F.col("_first"), digits)).drop("_first")
    whole = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return _windowed(df, order, partition, 0, name, lambda w: ratio_change(F.col(value), F.first(value).over(whole(w)), digits))


def change_since_base(df: DataFrame, value: str, at: str, base, keys: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """Percent change since the base period's value (by keys, if given)."""
    base_value = F.max(F.when(F.col(at) == F.lit(base), F.col(value)))
    if keys:
        return df.withColumn(f"{value}_since_base", ratio_change(F.col(value), base_value.over(Window.partitionBy(*keys)), digits))
    return df.crossJoin(F.broadcast(df.agg(base_value.alias("_base")))).withColumn(f"{value}_since_base", ratio_change(F.col(value), F.col("_base"), digits)).drop("_base")


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], nulls: str = "last") -> DataFrame:
    """The row of each key that comes first in descending order of the columns; ``nulls`` places nulls. Null keys are
    equal to each other. An aggregate that combines before the shuffle, so a frequent key costs a row a task."""
    first = nulls == "first"
    rank = F.struct(*[x for i, c in enumerate(order) for x in ((F.col(c).isNull() == first).alias(f"n{i}"), F.col(c).alias(f"c{i}"))])
    best = df.groupBy(*_cols(keys)).agg(F.max_by(F.struct(*df.columns), rank).alias("_row"))
    return best.select("_row.*")


def best_record(df: DataFrame, key: str, end: str, start: str, seq: str) -> DataFrame:
    """One row per key: active ones (no end) first, then the latest start, then source order."""
    w = Window.partitionBy(key).orderBy(F.col(end).isNull().desc(), F.desc_nulls_last(start), F.col(seq))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def locf(df: DataFrame, key: str, at: str, cols: Sequence[str], default: float = 0.0) -> DataFrame:
    """Last observation carried forward by key; what precedes the first observation gets ``default``."""
    w = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(w), F.lit(default)) for c in cols})


# --- report shaping -----------------------------------------------------------------------------------------


def rank_of(col: str, ranks: Sequence[str]) -> Column:
    """Position of the value in the list from 1, null for others."""
    out = F
    for i, value in enumerate(ranks, 1):
        out = out.when(F.col(col) == value, i)
    return out


def order_by_rank(df: DataFrame, col: str, ranks: Sequence[str]) -> DataFrame:
    """Sorted by a custom order; values that aren't listed come last."""
    return df.orderBy(rank_of(col, ranks).asc_nulls_last())


def top_n(df: DataFrame, measure: str, n: int = 100, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(measure), *ties).limit(n)


def unpivot_groups(df: DataFrame, ids: Sequence[str], groups: Mapping[str, Mapping[str, str]], name: str = "entity") -> DataFrame:
    """Wide columns by entity to a row per entity; ``groups`` maps an entity to measure and column.

    One scan (an exploded array of structs); rows in which all measures are null go.
    """
    measures = list(next(iter(groups.values())))
    rows = F.array(*[F.struct(F.lit(g).alias(name), *[F.col(c[m]).alias(m) for m in measures]) for g, c in groups.items()])
    return require_any(df.select(*ids, F.explode(rows).alias("_r")).select(*ids, "_r.*"), measures)


def period_table(df: DataFrame, at: str, measures: Sequence[str], periods: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Labelled rows in order, each with the measures' sums from a first to a last date, from one pass.

    A point is a period of one date. Periods without rows have null sums.
    """
    inside = lambda p: F.col(at).between(F.lit(p[1]).cast("date"), F.lit(p[2]).cast("date"))
    sums = df.agg(*[F.sum(F.when(inside(p), F.col(m))).alias(f"_{i}_{m}") for i, p in enumerate(periods) for m in measures])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(p[0]).alias("period"), *[F.col(f"_{i}_{m}").alias(m) for m in measures]) for i, p in enumerate(periods)])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def quarter_comparison(df: DataFrame, entity: str, value: str, year: str, quarter: str, at: tuple[int, int], digits: int = 0) -> DataFrame:
    """By entity present in the quarter ``at``: percent change on the quarter before, on the year before, of the
    last four quarters on the four before, and of those on the four before them, in one conditional aggregation."""
    end = at[0] * 4 + at[1]
    t = F.col(year) * 4 + F.col(quarter)
    point = lambda back: F.sum(F.when(t == end - back, F.col(value)))
    four = lambda back: F.sum(F.when(t.between(end - back - 3, end - back), F.col(value)))
    sums = df.where(t.between(end - 11, end)).groupBy(entity).agg(
        F.count_if(t == end).alias("_n"), *[point(b).alias(f"_p{b}") for b in (0, 1, 4)], *[four(b).alias(f"_y{b}") for b in (0, 4, 8)]
    )
    change = lambda a, b: ratio_change(F.col(a), F.col(b), digits)
    return sums.where("_n > 0").select(
        entity, change("_p0", "_p1").alias("on_quarter"), change("_p0", "_p4").alias("on_year"),
        change("_y0", "_y4").alias("four_quarters"), change("_y4", "_y8").alias("four_quarters_before"),
    )


def year_matrix(df: DataFrame, year: str, years: tuple[int, int], categories: Mapping[str, tuple[str | None, str | None]], digits: int = 0) -> DataFrame:
    """Two-year matrix: ``categories`` maps a label to its total and used columns; new is total less used.

    A category of one kind names None for the other: without a total there are no new ones, without a used column
    all are new.
    """
    sums = df.where(F.col(year).isin(*years)).groupBy(year)
    aggs = []
    for i, (total, used) in enumerate(categories.values()):
        aggs.append((F.sum(used) if used else F.lit(None).cast("double")).alias(f"_u{i}"))
        aggs.append((F.sum(F.col(total) - F.coalesce(used, F.lit(0))) if total and used else F.sum(total) if total else F.lit(None).cast("double")).alias(f"_n{i}"))
    wide = sums.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("category"), F.col(f"_u{i}").cast("double").alias("used"), F.col(f"_n{i}").cast("double").alias("new")) for i, c in enumerate(categories)])
    long = wide.select(year, F.explode(rows).alias("r")).select(year, "r.*")
    pick = lambda m, y: F.max(F.when(F.col(year) == y, F.col(m)))
    out = long.groupBy("position", "category").agg(*[pick(m, y).alias(f"{m}_{k}") for m in ("used", "new") for k, y in zip("ab", years, strict=True)])
    return out.select(
        "position", "category", "used_a", "new_a", "used_b", ratio_change(F.col("used_b"), F.col("used_a"), digits).alias("used_change"),
        "new_b", ratio_change(F.col("new_b"), F.col("new_a"), digits).alias("new_change"),
    )


def sectioned_panel(sections: Mapping[str, DataFrame]) -> DataFrame:
    """Several aggregates stacked with their section's name; columns that a section lacks are null."""
    named = [frame.withColumn("section", F.lit(name)) for name, frame in sections.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def classify_status(df: DataFrame, as_of: str, margin: float = 5.0) -> DataFrame:
    """``execution``, ``deadline`` and ``pace`` of works from ``physical``, ``financial``, ``due``, ``delivered``.

    ``as_of`` is the day that counts as today. Money more than ``margin`` points ahead of the work is early, more
    behind is late; without both figures the pace counts as balanced.
    """
    physical, financial = F.col("physical"), F.col("financial")
    execution = (
        F.when(physical == 100, "complete").when(physical == 0, "not started").when((physical > 0) & (physical < 100), "in progress").otherwise("unknown")
    )
    deadline = F.when(F.col("delivered"), "delivered").when(~F.col("delivered") & (F.col("due") < F.lit(as_of).cast("date")), "late").otherwise("in time")
    pace = F.when(financial > physical + margin, "money ahead").when(financial < physical - margin, "money behind").otherwise("balanced")
    return df.withColumns({"execution": execution, "deadline": deadline, "pace": pace})


def series_slice(df: DataFrame, at: Column, cols: Sequence[str], require: Sequence[str] | None = None, name: str = "date") -> DataFrame:
    """Chosen columns under a date, rows without any of the required values left out, newest first."""
    return require_any(df.select(at.alias(name), *cols), require or cols).orderBy(F.desc(name))

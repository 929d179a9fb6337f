"""Ordered computations that stay spread out when one group holds much of the data.

A Spark window puts each group into one task. That is the right plan while the largest
group is small, and the wrong one when a single key (or no key at all) holds a third of a
huge table. Every function here measures the largest group first. Below a limit it
uses the plain window. Above it, the rows are range-partitioned by (keys, order), so a hot
group covers many balanced chunks; each chunk is computed alone and what it needs from
earlier chunks is carried over:

* ``rolling``       the last few rows of the preceding chunks are copied in;
* ``running_sums``  the totals of the preceding chunks are added;
* ``running_last``  the last value of the preceding chunks fills the gap;
* ``span_totals``   time spans are split into cells of fixed length.

A key that covers several chunks is the first or last key of each, so tables of such
(key, chunk) pairs have at most two rows per chunk. That bound is what makes the
broadcasts below safe; it does not depend on the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from goldseam.session import materialize

GROUP_ROWS = 2_000_000
# Spark evaluates a sliding frame anew for every row, so the cost of a group grows with
# rows times frame length. Time-span frames therefore get a lower limit.
SLIDING_ROWS = 20_000
# Quantiles: the sketch's inverse error, and the most values between two bounds that are listed.
SKETCH_ACCURACY = 5_000
LISTED = 20_000
_GRID = 128
# Chunks grow in number with the table; the upper bound keeps the borders and the tables of
# spanning keys small, and a chunk that gets larger than planned is sorted with spilling.
CHUNK_ROWS = 5_000_000
MAX_CHUNKS = 20_000
_SETTING = "goldseam.maxGroupRows"


def _measure(df: DataFrame, keys: Sequence[str], limit: int = GROUP_ROWS) -> tuple[bool, int]:
    """Whether the largest group is small enough for a plain window, and all rows."""
    limit = min(limit, int(df.sparkSession.conf.get(_SETTING, str(limit))))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.max("n").alias("largest"), F.sum("n").alias("total")).first()
    return (row["largest"] or 0) <= limit, row["total"] or 0


def fits_one_task(df: DataFrame, keys: Sequence[str], limit: int = GROUP_ROWS) -> bool:
    """Whether the largest group of ``df`` is small enough for a plain window.

    The setting ``goldseam.maxGroupRows`` lowers the limit.
    """
    return _measure(df, keys, limit)[0]


def sort_columns(order: Sequence[str], flip: bool = False) -> list[Column]:
    """Columns from names, where a leading minus means descending."""
    result = []
    for name in order:
        down = name.startswith("-") != flip
        column = F.col(name.lstrip("-"))
        result.append(column.desc() if down else column.asc())
    return result


def micros(column: str | Column) -> Column:
    """A timestamp (with or without zone) as microseconds since the epoch."""
    value = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(value.cast("timestamp"))


def cell_of(column: str, width: int) -> Column:
    """Number of the cell of ``width`` that a whole number lies in, rounded down."""
    return F.expr(f"({column} - pmod({column}, {width}L)) div {width}L")


def join_whole(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys match each other, with the left side's key columns."""
    renamed = right
    for name in on:
        renamed = renamed.withColumnRenamed(name, f"_k_{name}")
    condition = F.lit(True)
    for name in on:
        condition = condition & left[name].eqNullSafe(renamed[f"_k_{name}"])
    return left.join(renamed, condition, how).drop(*[f"_k_{name}" for name in on])


def _by(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], total: int) -> DataFrame:
    """Rows with ``_chunk``, a balanced range of the (keys, order) sequence.

    The table is written out: the chunk borders come from a sample, and every later read
    must see the same borders.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(max(least, total // CHUNK_ROWS + 1), max(least, MAX_CHUNKS))
    laid = df.repartitionByRange(parts, *[F.col(k) for k in keys], *sort_columns(order))
    return materialize(laid.withColumn("_chunk", F.spark_partition_id()), "chunks")


def _spanning(chunked: DataFrame, keys: Sequence[str], *totals: Column) -> DataFrame:
    """Per (key, chunk) totals of the keys that cover more than one chunk."""
    cells = chunked.groupBy(*keys, "_chunk").agg(*totals)
    return cells.withColumn("_cover", F.count(F.lit(1)).over(_by(keys))).filter("_cover > 1")


def _attach(big: DataFrame, small: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join a table that is bounded by the number of chunks."""
    return join_whole(big, F.broadcast(small), on, how)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    reach: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Apply window expressions that look back at most ``reach`` rows.

    ``compute`` gets the rows and an ordered window and adds columns to them.
    """
    small, total = _measure(df, keys)
    if small:
        return compute(df, _by(keys).orderBy(*sort_columns(order)))

    rows = _chunked(df, keys, order, total)
    on = [*keys, "_chunk"]
    ahead = _by(keys).orderBy("_chunk").rowsBetween(1, reach)
    following = _spanning(rows, keys, F.count(F.lit(1)).alias("_n")).withColumn(
        "_ahead", F.collect_list(F.struct("_chunk", "_n")).over(ahead)
    )
    between = F.aggregate(
        F.slice("_ahead", F.lit(1), F.col("_step")),
        F.lit(0).cast("long"),
        lambda total, item: total + item["_n"],
    )
    targets = (
        following.select(*on, "_ahead", F.posexplode("_ahead").alias("_step", "_to"))
        .withColumn("_between", between)
        .filter(F.col("_between") < reach)
        .select(
            *on,
            F.col("_to._chunk").alias("_target"),
            (F.lit(reach) - F.col("_between")).alias("_take"),
        )
    )
    from_end = Window.partitionBy(*on).orderBy(*sort_columns(order, flip=True))
    tails = (
        _attach(rows, targets.select(*on).distinct(), on, "left_semi")
        .withColumn("_back", F.row_number().over(from_end))
        .filter(F.col("_back") <= reach)
    )
    halo = (
        _attach(tails, targets, on, "inner")
        .filter(F.col("_back") <= F.col("_take"))
        .withColumn("_chunk", F.col("_target"))
        .select(*rows.columns, F.lit(True).alias("_halo"))
    )
    both = rows.withColumn("_halo", F.lit(False)).unionByName(halo)
    done = compute(both, Window.partitionBy(*on).orderBy(*sort_columns(order)))
    return done.filter(~F.col("_halo")).drop("_halo", "_chunk")


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, str],
    include_current: bool = True,
) -> DataFrame:
    """Cumulative sums per key: ``{output: input}``, zero before the first row."""
    end = Window.currentRow if include_current else -1

    def local(rows: DataFrame, window: WindowSpec) -> DataFrame:
        frame = window.rowsBetween(Window.unboundedPreceding, end)
        columns = {
            out: F.coalesce(F.sum(src).over(frame), F.lit(0)) for out, src in sums.items()
        }
        return rows.withColumns(columns)

    small, total = _measure(df, keys)
    if small:
        return local(df, _by(keys).orderBy(*sort_columns(order)))

    rows = _chunked(df, keys, order, total)
    on = [*keys, "_chunk"]
    before = _by(keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = _spanning(rows, keys, *[F.sum(src).alias(f"_t_{out}") for out, src in sums.items()])
    carried = totals.select(
        *on, *[F.sum(f"_t_{out}").over(before).alias(f"_c_{out}") for out in sums]
    )
    inside = local(rows, Window.partitionBy(*on).orderBy(*sort_columns(order)))
    joined = _attach(inside, carried, on, "left")
    added = joined.withColumns(
        {
            out: (F.col(out) + F.coalesce(F.col(f"_c_{out}"), F.lit(0))).cast(
                inside.schema[out].dataType
            )
            for out in sums
        }
    )
    return added.drop("_chunk", *[f"_c_{out}" for out in sums])


def running_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], source: str, output: str
) -> DataFrame:
    """The latest non-null ``source`` at or before each row. ``order`` is ascending."""

    def local(rows: DataFrame, window: WindowSpec) -> DataFrame:
        frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumn(output, F.last(source, ignorenulls=True).over(frame))

    small, total = _measure(df, keys)
    if small:
        return local(df, _by(keys).orderBy(*sort_columns(order)))

    rows = _chunked(df, keys, order, total)
    on = [*keys, "_chunk"]
    place = F.when(F.col(source).isNotNull(), F.struct(*order))
    ends = _spanning(rows, keys, F.max_by(source, place).alias("_end"))
    before = _by(keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*on, F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    inside = local(rows, Window.partitionBy(*on).orderBy(*sort_columns(order)))
    joined = _attach(inside, carried, on, "left")
    return joined.withColumn(output, F.coalesce(output, "_carried")).drop("_chunk", "_carried")


def row_at(df: DataFrame, order: Sequence[str], positions: dict[str, int]) -> DataFrame:
    """The rows at given 1-based positions of the total order, with their names in ``_at``.

    Only the order columns are moved, and above the limit only the chunks that hold a
    wanted position are numbered.
    """
    names = [name.lstrip("-") for name in order]
    narrow = df.select(*names)
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("_at"), F.lit(place).cast("long").alias("_rank"))
            for name, place in positions.items()
        ]
    )

    def pick(rows: DataFrame) -> DataFrame:
        hits = rows.withColumn("_hit", F.explode(wanted)).filter("_hit._rank = _place")
        return hits.select(F.col("_hit._at").alias("_at"), *names)

    small, total = _measure(narrow, [])
    if small:
        return pick(
            narrow.withColumn("_place", F.row_number().over(_by([]).orderBy(*sort_columns(order))))
        )

    rows = _chunked(narrow, [], order, total)
    sizes = rows.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = _by([]).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    holds = F.exists(
        wanted,
        lambda w: (w["_rank"] > F.col("_start")) & (w["_rank"] <= F.col("_start") + F.col("_n")),
    )
    inside = _attach(rows, starts.filter(holds).select("_chunk", "_start"), ["_chunk"], "inner")
    local = F.row_number().over(Window.partitionBy("_chunk").orderBy(*sort_columns(order)))
    return pick(inside.withColumn("_place", F.col("_start") + local))


def select_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    probabilities: Sequence[float],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Exact linearly interpolated quantiles of several double columns, by distributed selection.

    One pass sketches all columns and yields for every quantile two values of the data that surely
    enclose it. A second pass counts what lies below and lists the few values between, from which the
    quantile is read. Where more than ``LISTED`` values lie between, further passes sketch only
    these and move the bounds together first; each divides their number by about twenty, so passes
    grow with the logarithm of the rows and no list with the data. Equal values move to the bounds, so
    a value that a third of all rows hold is a number in a count.

    Returns ``keys``, ``q_0, q_1, ..`` (an array for each column, of nulls if it has no value) and the
    ``extra`` aggregates. The expressions are SQL text, as there are dozens for each quantile.
    """
    targets = [(i, float(p)) for i in range(len(columns)) for p in probabilities]
    margin = 3 / SKETCH_ACCURACY
    names = [f"`{c}`" for c in columns]

    def sketch(value: str, places: Sequence[float]) -> str:
        return f"percentile_approx({value}, array({', '.join(f'{x!r}D' for x in places)}), {SKETCH_ACCURACY})"

    def ranks(i: int, p: float) -> tuple[str, str, str]:
        at = f"({p!r}D * (_n{i} - 1))"
        return at, f"floor({at})", f"ceil({at})"

    places = [x for p in probabilities for x in (max(0.0, p - margin), min(1.0, p + margin))]
    parts = []
    for i, v in enumerate(names):
        parts += [f"count({v}) AS _n{i}", f"min({v}) AS _least{i}", f"max({v}) AS _most{i}", f"{sketch(v, places)} AS _a{i}"]
    first = df.groupBy(*keys).agg(*[F.expr(x) for x in parts], *extra)
    numbers = [f"_n{i}" for i in range(len(columns))]
    extras = first.columns[len(keys) + len(parts) :]
    # The margin has to cover a rank, as a sketch counts ranks in another way; few values are enclosed
    # by the smallest and the largest one.
    few = 4 / margin
    bounds, between = [], []
    for t, (i, _) in enumerate(targets):
        k = t % len(probabilities)
        lo, hi = (f"IF(_n{i} < {few}, _{e}{i}, _a{i}[{2 * k + up}])" for up, e in enumerate(("least", "most")))
        bounds.append(f"struct({lo} AS lo, {hi} AS hi)")
        between.append(f"IF(_n{i} < {few}, _n{i}, ceil(_n{i} * {4 * margin}))")

    def settled(rows: DataFrame, bounds: list[str], between: list[str]) -> DataFrame:
        """The bounds, computed once: a table, or without keys its one row."""
        both = [f"array({', '.join(bounds)}) AS _b", f"array({', '.join(between)}) AS _m"]
        rows = rows.select(*keys, *numbers, *extras, *[F.expr(x) for x in both])
        return materialize(rows, "bounds") if keys else rows.sparkSession.createDataFrame(rows.collect(), rows.schema)

    def counts(state: DataFrame, listed: Callable[[str], str]) -> DataFrame:
        """What lies below, at and above each lower bound; the rows are joined with their bounds, or,
        without keys, compared with plain numbers."""
        rows = join_whole(df, state.select(*keys, "_b"), keys) if keys else df
        known = None if keys else state.select("_b").first()["_b"]
        parts = []
        for t, (i, _) in enumerate(targets):
            lo, hi = f"_b[{t}].lo", f"_b[{t}].hi"
            if known:
                lo, hi = ("CAST(NULL AS DOUBLE)" if x is None else f"CAST('{x!r}' AS DOUBLE)" for x in known[t])
            v = names[i]
            inside = f"CASE WHEN {v} > {lo} AND {v} < {hi} THEN {v} END"
            parts += [
                f"count_if({v} < {lo}) AS _below{t}", f"count_if({v} = {lo}) AS _at{t}",
                f"count({inside}) AS _in{t}", f"{listed(inside)} AS _list{t}",
            ]
        grouped = rows.groupBy(*keys).agg(*[F.expr(x) for x in parts])
        return join_whole(grouped, state, keys) if keys else grouped.crossJoin(F.broadcast(state))

    state = settled(first, bounds, between)
    grid = [k / _GRID for k in range(_GRID + 1)]
    while (state.agg(F.max(F.array_max("_m"))).first()[0] or 0) > LISTED:
        found = counts(state, lambda inside: sketch(inside, grid))
        bounds, between = [], []
        for t, (i, p) in enumerate(targets):
            _, low, high = ranks(i, p)
            ends = []
            # A mark further out covers the sketch's error; beyond the marks the bound stays.
            for rank, step, far in ((low, -1, f"_b[{t}].lo"), (high, 2, f"_b[{t}].hi")):
                place = f"(CAST(floor(({rank} - _below{t} - _at{t}) * {_GRID} / greatest(_in{t}, 1)) AS INT) + {step})"
                ends.append(f"IF(_in{t} > 0 AND {place} BETWEEN 0 AND {_GRID}, get(_list{t}, {place}), {far})")
            bounds.append(f"struct({ends[0]} AS lo, {ends[1]} AS hi)")
            between.append(f"ceil(_in{t} * {6 / _GRID}) + 2")
        state = settled(found, bounds, between)

    found = counts(state, lambda inside: f"array_sort(collect_list({inside}))")
    picked, results = [], []
    for t, (i, p) in enumerate(targets):
        at, low, high = ranks(i, p)
        for side, rank in (("l", low), ("h", high)):
            picked.append(
                f"CASE WHEN _n{i} > 0 AND {rank} < _below{t} THEN CAST(raise_error('a bound is no bound') AS DOUBLE) "
                f"WHEN {rank} < _below{t} + _at{t} THEN _b[{t}].lo WHEN {rank} < _below{t} + _at{t} + _in{t} "
                f"THEN get(_list{t}, CAST({rank} - _below{t} - _at{t} AS INT)) ELSE _b[{t}].hi END AS _{side}{t}"
            )
        mixed = f"({high} - {at}) * _l{t} + ({at} - {low}) * _h{t}"
        results.append(f"CASE WHEN _n{i} > 0 THEN CASE WHEN _l{t} = _h{t} THEN _l{t} WHEN {low} = {high} THEN _l{t} ELSE {mixed} END END")
    found = found.select(*keys, *numbers, *extras, *[F.expr(x) for x in picked])
    each = len(probabilities)
    arrays = [f"array({', '.join(results[i * each : (i + 1) * each])}) AS q_{i}" for i in range(len(columns))]
    return found.select(*keys, *[F.expr(x) for x in arrays], *extras)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    output: str = "quantiles",
) -> DataFrame:
    """Exact linearly interpolated quantiles per key, as one array column. Nulls do not count; a
    key without values has no row."""
    present = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    return select_quantiles(present, keys, ["_v"], probabilities).select(*keys, F.col("q_0").alias(output))


def _divisor(span: int, least: int) -> int:
    """The first number from ``least`` on that divides the span, so that cells line up."""
    while span % least:
        least += 1
    return least


def span_totals(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    span_seconds: int,
    value: str,
    outputs: tuple[str, str],
    cells: int = 1,
) -> DataFrame:
    """Row count and sum of ``value`` over the closed span [t - span, t], per (key, time).

    One row per distinct (key, time) comes back. Above the limit the time line is cut into
    at least ``cells`` cells per span, more where a cell would be too full. A row then needs
    its own cell up to ``t``, the whole cells in between from a small table, and the late part
    of the cell one span earlier, whose rows are copied in shifted by the span.
    """
    count_name, sum_name = outputs
    span = span_seconds * 1_000_000
    points = (
        df.withColumn("_t", micros(time))
        .groupBy(*keys, time, "_t")
        .agg(F.count(value).alias("_n"), F.sum(value).alias("_s"))
    )
    if fits_one_task(df, keys, SLIDING_ROWS):
        frame = _by(keys).orderBy("_t").rangeBetween(-span, 0)
        return points.select(
            *keys,
            time,
            F.sum("_n").over(frame).alias(count_name),
            F.sum("_s").over(frame).alias(sum_name),
        )

    points = materialize(points, "points")
    cells = _divisor(span, cells)
    fullest = points.groupBy(*keys, cell_of("_t", span // cells)).count().agg(F.max("count")).first()[0]
    # Times are distinct within a key, so finer cells split any cell that is too full.
    cells = _divisor(span, cells * max(1, -(-(fullest or 0) // GROUP_ROWS)))
    points = points.withColumn("_cell", cell_of("_t", span // cells))
    own = points.select(*keys, time, "_t", "_cell", "_n", "_s", F.lit(False).alias("_old"))
    old = points.select(
        *keys,
        F.col(time),
        (F.col("_t") + span).alias("_t"),
        (F.col("_cell") + cells).alias("_cell"),
        "_n",
        "_s",
        F.lit(True).alias("_old"),
    )
    per_cell = points.groupBy(*keys, "_cell").agg(F.sum("_n").alias("_cn"), F.sum("_s").alias("_cs"))
    middle_frame = _by(keys).orderBy("_cell").rangeBetween(-(cells - 1), -1)
    middle = per_cell.select(
        *keys,
        "_cell",
        F.coalesce(F.sum("_cn").over(middle_frame), F.lit(0)).alias("_mn"),
        F.coalesce(F.sum("_cs").over(middle_frame), F.lit(0)).alias("_ms"),
    ) if cells > 1 else None
    at_cell = Window.partitionBy(*keys, "_cell").orderBy("_t")
    upto = at_cell.rangeBetween(Window.unboundedPreceding, 0)
    earlier = at_cell.rangeBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys, "_cell")

    def part(column: str) -> Column:
        mine = F.sum(F.when(~F.col("_old"), F.col(column))).over(upto)
        theirs = F.when(F.col("_old"), F.col(column))
        late = F.coalesce(F.sum(theirs).over(whole), F.lit(0)) - F.coalesce(
            F.sum(theirs).over(earlier), F.lit(0)
        )
        return F.coalesce(mine, F.lit(0)) + late

    both = own.unionByName(old).withColumns({"_pn": part("_n"), "_ps": part("_s")})
    result = both.filter(~F.col("_old"))
    if middle is None:
        return result.select(
            *keys,
            time,
            F.col("_pn").alias(count_name),
            F.when(F.col("_pn") > 0, F.col("_ps")).alias(sum_name),
        )
    joined = join_whole(result, middle, [*keys, "_cell"])
    return joined.select(
        *keys,
        time,
        (F.col("_pn") + F.col("_mn")).alias(count_name),
        # No value in the span: null, as a plain window gives it.
        F.when(F.col("_pn") + F.col("_mn") > 0, F.col("_ps") + F.col("_ms")).alias(sum_name),
    )

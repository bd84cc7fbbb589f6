"""Projection, predicates, joins along parent/child paths, small aggregates, ranks, top-n and set forms."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewright.functions.scalars import cuts_below
from tidewright.operators.cdc import content_hash
from tidewright.operators.scans import numbered
from tidewright.sources.files import kept

# --- projection and predicates


def select_keep_keys(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """``columns`` of ``df``; raises if a key or cursor in ``keys`` would be lost."""
    lost = [k for k in keys if k not in columns]
    if lost:
        raise ValueError(f"the projection loses {lost}")
    return df.select(*columns)


_COMPARE = {
    "eq": lambda c, v: c == v,
    "ne": lambda c, v: c.isNull() | (c != v),
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
}


def where_spec(df: DataFrame, spec: list[tuple[str, str, object]]) -> DataFrame:
    """Rows that meet every ``(dotted field, eq|ne|gt|gte|lt|lte|in, value)``.

    Values are cast to the field's type, so the stored column is compared as it is. Null meets only ``ne``.
    """
    for field, op, value in spec:
        kind = df.select(field).schema[0].dataType
        if op == "in":
            df = df.where(F.col(field).isin([F.lit(v).cast(kind) for v in value]))
        elif op in _COMPARE:
            df = df.where(_COMPARE[op](F.col(field), F.lit(value).cast(kind)))
        else:
            raise ValueError(f"unknown comparison {op}")
    return df


def and_all(*predicates: Column | None) -> Column:
    """AND of those that are given; true without any."""
    return reduce(lambda a, b: a & b, [p for p in predicates if p is not None], F.lit(True))


def search_names(df: DataFrame, name: str, pattern: str) -> DataFrame:
    return df.where(F.col(name).rlike(pattern))


def key_filter(df: DataFrame, **keys: str) -> DataFrame:
    """Equality on text keys in either case."""
    return df.where(and_all(*(F.lower(k) == v.lower() for k, v in keys.items())))


def option_filters(df: DataFrame, **options) -> DataFrame:
    """Equality on columns; options that are None do not filter."""
    return df.where(and_all(*(F.col(k) == F.lit(v) for k, v in options.items() if v is not None)))


def ids_in(df: DataFrame, column: str, listed: str) -> DataFrame:
    """Rows whose id is in a comma-separated list; blanks are trimmed and empty items dropped."""
    ids = [x.strip() for x in listed.split(",") if x.strip()]
    return df.where(F.col(column).isin([F.lit(i).cast(df.schema[column].dataType) for i in ids]))


def stamp(df: DataFrame, **constants) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def drop_control(df: DataFrame, pattern: str = r"^__|@|^deferred$") -> DataFrame:
    """Without columns whose name matches."""
    return df.select([F.col(f"`{c}`") for c in df.columns if not re.search(pattern, c)])


def pad_to_schema(df: DataFrame, schema: T.StructType, never_pad: list[str]) -> DataFrame:
    """Columns of ``schema`` in its order, missing ones null; a missing key raises."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if lost := [m for m in missing if m in never_pad]:
        raise ValueError(f"keys are missing: {lost}")
    return df.select(*(F.lit(None).cast(f.dataType).alias(f.name) if f.name in missing else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def prefix_filter(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.where(F.col(column).startswith(prefix))


def wildcard_filter(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """``*`` any run, ``?`` one character, in either case."""
    like = re.sub(r"([%_\\])", r"\\\1", pattern).replace("*", "%").replace("?", "_")
    return df.where(F.lower(column).like(like.lower()))


# --- joins


def fan_out(parents: DataFrame, children: DataFrame, keys: list[str], copy: list[str] | None = None) -> DataFrame:
    """Child rows with the columns ``copy`` of their parent."""
    return children.join(parents.select(*keys, *(copy or [])), keys)


def filters_at(levels: list[tuple[DataFrame, list[str], Column | None]]) -> DataFrame:
    """Inner joins down a path with a filter at each level, put before the join so that it prunes.

    A level is ``(table, key columns shared with the level above, filter)``.
    """
    out = None
    for df, keys, condition in levels:
        df = df if condition is None else df.where(condition)
        out = df if out is None else out.join(df, keys)
    return out


def cohort_members(users: DataFrame, user: str, cohorts: dict[str, Column]) -> DataFrame:
    """``(cohort, user)`` for every cohort whose condition a user meets; one pass over the users."""
    named = F.array(*(F.when(c, F.lit(k)) for k, c in cohorts.items()))
    return users.select(F.explode(F.array_compact(named)).alias("cohort"), user)


def junction(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """Distinct pairs of related ids with the id ``left_right``."""
    pairs = left.select(*keys, left_id).join(right.select(*keys, right_id), keys).select(left_id, right_id).distinct()
    return pairs.withColumn("id", F.concat_ws("_", left_id, right_id))


def expand_path(df: DataFrame, path: list[tuple[str, list[str]]], leaf: list[str]) -> DataFrame:
    """Leaf rows of nested arrays with every ancestor's keys.

    ``path`` lists ``(array column, key fields of its elements)`` from the top; ``leaf`` are the fields taken from the last one. Keys
    are named ``<array>_<key>``, numbered where that name is taken. Each level is exploded on its own.
    """
    keys = [c for c in df.columns if c != path[0][0]]
    for i, (array, fields) in enumerate(path):
        last = i + 1 == len(path)
        df = df.select(*keys, F.explode(array).alias("__e"))
        made = []
        for f in leaf if last else fields:
            name, n = (f if last else f"{array}_{f}"), 1
            while name in keys + [m for m, _ in made]:
                n += 1
                name = f"{array}_{f}_{n}"
            made.append((name, F.col(f"__e.{f}").alias(name)))
        below = [] if last else [F.col(f"__e.{path[i + 1][0]}").alias(path[i + 1][0])]
        df = df.select(*keys, *(c for _, c in made), *below)
        keys += [m for m, _ in made]
    return df


def _doubled(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """``(node, parent, at, depth)`` after pointer doubling: each round a pointer jumps as far as the one that it points to has come.

    ``at`` is null where a root was reached; else it is a node that is missing, or one on a cycle. A row takes as many rounds as the logarithm of its depth; with as many
    steps as there are rows, what has not ended goes round in a cycle.
    """
    state = nodes.where(F.col(node).isNotNull()).select(F.col(node).alias("node"), F.col(parent).alias("parent"), F.col(parent).alias("at"), F.when(F.col(parent).isNull(), 0).otherwise(1).alias("depth"), F.lit(False).alias("lost"))
    state = kept(state, "pointers")
    steps, rows = 1, state.count()
    # pointers pack into small files, and a side taken for small would be sent through the driver in every round: all joins here are merges
    while steps < 2 * rows and not state.where("at is not null and not lost").isEmpty():
        to = state.select(F.col("node").alias("__n"), F.col("at").alias("__at"), F.col("depth").alias("__d"), F.col("lost").alias("__lost")).hint("merge")
        going = F.col("at").isNotNull() & ~F.col("lost")
        met = state.where(going).join(to, F.col("at") == F.col("__n"), "left")  # what has ended would meet in the task of the nulls
        there = F.col("__n").isNotNull()
        moved = met.select(
            "node",
            "parent",
            F.when(there, F.col("__at")).otherwise(F.col("at")).alias("at"),
            F.when(there, F.col("depth") + F.col("__d")).otherwise(F.col("depth")).alias("depth"),
            (~there | F.coalesce("__lost", F.lit(False))).alias("lost"),
        )
        state = kept(moved.union(state.where(~going)), "pointers")
        steps *= 2
    return state


def hierarchy(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """``(node, parent, depth)`` of all nodes below roots (null parent), of any depth; a node with several parents has a row for each way down.

    Nodes on or below a cycle and below missing parents have no depth: ``hierarchy_faults`` names them.
    """
    return _doubled(nodes, node, parent).where("at is null").select("node", "parent", "depth")


def hierarchy_faults(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """``(node, parent, fault, at)`` of nodes that no root leads to: ``orphan`` (``at`` is the parent that is missing above it), ``cycle`` or ``below cycle`` (``at`` is the least node of the cycle).

    Takes one parent for each node.
    """
    state = _doubled(nodes, node, parent).where("at is not null")
    on = kept(state.where("not lost").select(F.col("at").alias("node")).distinct().hint("merge").join(nodes.select(F.col(node).alias("node"), F.col(parent).alias("at")), "node").withColumn("low", F.least("node", "at")), "cycles")
    steps, size = 1, on.count()
    while steps < size:  # the least node of a cycle, by doubling again
        to = on.select(F.col("node").alias("at"), F.col("at").alias("__at"), F.col("low").alias("__low")).hint("merge")
        on = kept(on.join(to, "at").select("node", F.col("__at").alias("at"), F.least("low", "__low").alias("low")), "cycles")
        steps *= 2
    named = state.join(on.select(F.col("node").alias("at"), "low").hint("merge"), "at", "left").join(on.select("node", F.lit(True).alias("__on")).hint("merge"), "node", "left")
    fault = F.when(F.col("lost"), "orphan").when(F.col("__on"), "cycle").otherwise("below cycle")
    return named.select("node", "parent", fault.alias("fault"), F.coalesce("low", "at").alias("at"))


def vanished_parents(previous: DataFrame, current: DataFrame, children: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Parents that are gone, and the children whose parent is still there."""
    return previous.join(current, keys, "left_anti"), children.join(current.select(*keys).distinct(), keys, "left_semi")


# --- aggregates, windows, order


def count_min_max_by_group(df: DataFrame, groups: list[str], column: str) -> DataFrame:
    return df.groupBy(*groups).agg(F.count("*").alias("n"), F.min(column).alias("min"), F.max(column).alias("max"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n")).select(F.lit(k).alias("table_name"), "n") for k, df in tables.items()))


def point_type_catalog(df: DataFrame, description: str, unit: str) -> DataFrame:
    """First word of the description (``Unknown`` without one) by unit, most frequent first."""
    first = F.split_part(F.trim(F.coalesce(description, F.lit(""))), F.lit(" "), F.lit(1))
    kind = F.when(first == "", "Unknown").otherwise(first)
    return df.groupBy(kind.alias("point_type"), F.col(unit).alias("unit")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "point_type", "unit")


def ordinal_in_group(df: DataFrame, group: list[str], order: list[str], given: str, name: str = "ordinal") -> DataFrame:
    """The given position, zero kept, or else the 1-based one in the group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.coalesce(F.col(given).cast("int"), F.row_number().over(w)))


def result_index(df: DataFrame, query: list[str], order: list[Column], name: str = "result_index") -> DataFrame:
    """Zero-based rank inside each query's result."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*query).orderBy(*order)) - 1)


def number_rows(df: DataFrame, position: str, header_rows: int = 1, name: str = "row_number") -> DataFrame:
    """Sheet row numbers from a zero-based position of the data row; the first data row comes after the header."""
    return df.withColumn(name, F.col(position) + F.lit(1 + header_rows))


def recent_n(df: DataFrame, time: str, n: int, tiebreak: str, preview: dict[str, int] | None = None) -> DataFrame:
    """Newest ``n`` rows; ``preview`` cuts text columns to so many characters. Runs as a distributed top-n."""
    top = df.orderBy(F.col(time).desc_nulls_last(), F.col(tiebreak).desc()).limit(n)
    return top.withColumns({c: F.left(c, F.lit(k)) for c, k in (preview or {}).items()})


def sort_nulls_last(df: DataFrame, column: str, ascending: bool = True, *tiebreak: str) -> DataFrame:
    """Missing values last when ascending and first when descending."""
    c = F.col(column)
    return df.orderBy(c.asc_nulls_last() if ascending else c.desc_nulls_first(), *tiebreak)


def page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def top_groups(df: DataFrame, group: list[str], latest: str, n: int) -> DataFrame:
    """Groups with most rows, then the newest, then by name."""
    g = df.groupBy(*group).agg(F.count("*").alias("n"), F.max(latest).alias("latest"))
    return g.orderBy(F.desc("n"), F.desc("latest"), *group).limit(n)


# --- set forms


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Each row once; rows with maps, which cannot be compared, by their content hash."""
    if any(isinstance(f.dataType, T.MapType | T.VariantType) for f in df.schema):
        return df.withColumn("__h", content_hash(df)).dropDuplicates(["__h"]).drop("__h")
    return df.distinct()


def drop_duplicate_ids(df: DataFrame, ids: list[str], order: list[str]) -> DataFrame:
    """The first row of each id by ``order``, without a window."""
    return df.groupBy(*ids).agg(F.min_by(F.struct(*[c for c in df.columns if c not in ids]), F.struct(*order)).alias("r")).select(*ids, "r.*").select(df.columns)


def except_unchanged(previous: DataFrame, current: DataFrame) -> DataFrame:
    return current.exceptAll(previous.select(current.columns))


def union_sources(tables: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """Rows of all tables with the table's name; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn(tag, F.lit(k)) for k, df in tables.items()))


# --- splitting work


def balanced_bins(weights: DataFrame, key: str, weight: str, n: int) -> DataFrame:
    """``(key, weight, bin)``: keys by falling weight, each to the bin with the least load (of equal loads the first).

    Keys of one weight are alike, so they are dealt together: weights are counted first (a small table: distinct weights), and every bin is told
    how many keys of a weight it takes. Inside a weight keys are numbered by key and hash range, so that a weight that most
    keys have is no single task's. Null weights count as zero. With more than ``MOST_WEIGHTS`` distinct weights ``level_bins`` deals them, within its bound.
    """
    if weights.agg(F.approx_count_distinct(weight)).first()[0] > MOST_WEIGHTS:
        return level_bins(weights, key, weight, n)
    parts = 256
    w = F.coalesce(F.col(weight), F.lit(0).cast(weights.schema[weight].dataType))
    marked = weights.withColumns({"__w": w, "__p": F.pmod(F.xxhash64(key), F.lit(parts))})
    sizes = marked.groupBy("__w", "__p").agg(F.count("*").alias("n"))
    shifts = sizes.withColumn("__s", F.sum("n").over(Window.partitionBy("__w").orderBy("__p")) - F.col("n")).drop("n")
    loads, dealt = [0] * n, []
    for r in sizes.groupBy("__w").agg(F.sum("n").alias("n")).orderBy(F.desc("__w")).toLocalIterator():  # a row for each distinct weight
        before = 0
        for b, k in enumerate(_fill(loads, r["__w"], r["n"])):
            if k:
                dealt.append((r["__w"], before, before + k, b))
                before += k
    schema = T.StructType([T.StructField("__w", marked.schema["__w"].dataType), T.StructField("__low", T.LongType()), T.StructField("__high", T.LongType()), T.StructField("bin", T.IntegerType())])
    plan = weights.sparkSession.createDataFrame(dealt, schema)
    at = F.row_number().over(Window.partitionBy("__w", "__p").orderBy(key)) - 1
    ranked = marked.withColumn("__k", at).join(shifts, ["__w", "__p"]).withColumn("__k", F.col("__k") + F.col("__s"))
    runs = plan.groupBy("__w").agg(F.sort_array(F.collect_list(F.struct("__low", "__high", "bin"))).alias("__runs"))  # ``n`` bins at most
    return ranked.join(runs, "__w").withColumn("bin", F.filter("__runs", lambda r: r["__high"] > F.col("__k"))[0]["bin"]).select(*weights.columns, "bin")


#: Distinct weights up to which ``balanced_bins`` deals key by key.
MOST_WEIGHTS = 10_000


def level_bins(weights: DataFrame, key: str, weight: str, n: int, share: int = 16) -> DataFrame:
    """``(key, weight, bin)`` for weights of any number of values: heavy keys one by one, the rest like water up to one level.

    A key above one ``share``-th of a bin's mean load is heavy; there are less than ``share * n`` of them, and they go by falling weight to the bin with the least load.
    The others are laid end to end in the order of their hashes and cut where the bins come up to one level. No bin exceeds the level by more than the heaviest of the others, so by
    less than one ``share``-th of the mean load. Null weights count as zero; negative ones raise. The running sums are taken in ranges of the hash, one task each.
    """
    spark, parts = weights.sparkSession, max(32, int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    marked = weights.withColumns({"__w": w, "__h": F.xxhash64(key)}).withColumn("__p", F.pmod("__h", F.lit(parts)))
    total, least = marked.agg(F.sum("__w"), F.min("__w")).first()
    if least is not None and least < 0:
        raise ValueError(f"{weight} has negative values")
    if not total:
        return marked.withColumn("bin", F.pmod("__h", F.lit(n)).cast("int")).select(*weights.columns, "bin")
    heavy_from = total / (share * n)
    loads, dealt = [0.0] * n, []
    for k, x in sorted(((r[key], r["__w"]) for r in marked.where(F.col("__w") > heavy_from).select(key, "__w").collect()), key=lambda r: (-r[1], r[0])):  # less than share * n
        b = min(range(n), key=lambda i: (loads[i], i))
        loads[b] += x
        dealt.append((k, b))
    rest = marked.where(F.col("__w") <= heavy_from)
    sums = {r["__p"]: r["s"] for r in rest.groupBy("__p").agg(F.sum("__w").alias("s")).collect()}  # one row a range
    level, cuts, at = _level(loads, sum(sums.values())), [], 0.0
    for x in loads[:-1]:
        at += max(0.0, level - x)
        cuts.append(at)
    before, shift = 0.0, []
    for p in range(parts):
        shift += [F.lit(p), F.lit(before)]
        before += sums.get(p, 0.0)
    upto = F.sum("__w").over(Window.partitionBy("__p").orderBy("__h", key).rowsBetween(Window.unboundedPreceding, 0)) + F.create_map(*shift)[F.col("__p").cast("int")]
    placed = rest.withColumn("__m", upto - F.col("__w") / 2).withColumn("bin", cuts_below(F.col("__m"), cuts, T.DoubleType()).cast("int")).select(*weights.columns, "bin")
    one = spark.createDataFrame(dealt, T.StructType([T.StructField(key, weights.schema[key].dataType), T.StructField("bin", T.IntegerType())]))
    return placed.unionByName(weights.join(F.broadcast(one), key).select(*weights.columns, "bin"))  # less than share * n rows


def _level(loads: list[float], amount: float) -> float:
    """How high ``amount`` comes when it fills up bins that hold ``loads``."""
    order, k = sorted(loads), 0
    while k + 1 < len(order) and sum(order[k + 1] - x for x in order[: k + 1]) < amount:
        k += 1
    return (sum(order[: k + 1]) + amount) / (k + 1)


def _fill(loads: list, weight, count: int) -> list[int]:
    """How many of ``count`` keys of one weight each bin takes, always the least loaded one next; ``loads`` grows.

    Whole rounds are given at once: the level is found that ``count`` keys reach, and the last few go one by one.
    """
    n = len(loads)
    taken = [0] * n
    if weight <= 0:
        return [count // n + (b < count % n) for b in range(n)]
    low, high = min(loads), max(loads) + weight * (count // n + 1)
    under = lambda level: [max(0, -(-(level - x) // weight)) for x in loads]  # keys until a bin reaches the level
    for _ in range(200):
        middle = (low + high) / 2 if isinstance(weight, float) else (low + high) // 2
        if sum(under(middle)) <= count:
            if middle == low:
                break
            low = middle
        else:
            high = middle
    for b, k in enumerate(under(low)):
        taken[b] = int(k)
        loads[b] += weight * int(k)
    for _ in range(count - sum(taken)):
        b = min(range(n), key=lambda i: (loads[i], i))
        taken[b] += 1
        loads[b] += weight
    return taken


def contiguous_bins(df: DataFrame, order: str, n: int, name: str = "bin") -> DataFrame:
    """Equal contiguous slices in the order of a column with distinct values, of any type; the first ``rows % n`` have one more. Nulls come first.

    Positions are running totals of counts by ranges of the column; no task sorts more than a range.
    """
    placed, total = numbered(df, order, "__i")
    small, extra = total // n, total % n
    large = (small + 1) * extra
    bin_ = F.when(F.col("__i") < large, F.floor(F.col("__i") / (small + 1))).otherwise(extra + F.floor((F.col("__i") - large) / max(small, 1)))
    return placed.withColumn(name, (bin_ + 1).cast("int")).drop("__i")

"""Cross-checks and reports: two routes to one number, lost rows, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def crosscheck(left: DataFrame, right: DataFrame, key: str = "key", value: str = "n") -> DataFrame:
    """Keys whose values differ, or that one side lacks. A key that repeats counts with its maximum."""
    a = left.groupBy(key).agg(F.max(value).alias("left_value"))
    b = right.groupBy(key).agg(F.max(value).alias("right_value"))
    return a.join(b, key, "full_outer").where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def missing(expected: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """Expected rows without a counterpart."""
    return expected.join(found, on, "left_anti")


def lost(before: DataFrame, after: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """Values of `before` that are neither in `after` nor rejected."""
    out = before.subtract(after)
    return out.subtract(rejected) if rejected is not None else out


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def share_of_total(rows: DataFrame, value: str) -> DataFrame:
    """Each row's share of the sum; the sum is one row, joined, so no window gathers the table."""
    total = rows.agg(F.sum(value).alias("__total"))
    return rows.join(F.broadcast(total)).withColumn("share", F.col(value) / F.col("__total")).drop("__total")


def top_k(rows: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each group."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def forward_fill(rows: DataFrame, keys: list[str], order: str, value: str, out: str, current: bool = True) -> DataFrame:
    """The last value that isn't null, up to this row or, without `current`, before it."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    return rows.withColumn(out, F.last(value, True).over(w))


def next_numbers(rows: DataFrame, keys: list[str], number: str, order: str) -> DataFrame:
    """Rows without a number get the next ones after their group's maximum."""
    group = Window.partitionBy(*keys)
    nth = F.row_number().over(group.orderBy(F.col(number).isNotNull(), order))
    return rows.withColumn("assigned", F.coalesce(F.col(number), F.coalesce(F.max(number).over(group), F.lit(0)) + nth))


def mode_first_seen(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each group; ties: the one seen first."""
    used = rows.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    return used.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("n"), "seen")).alias(value), F.max("n").alias("n"))


def totals(rows: DataFrame, group: str, distinct: str) -> DataFrame:
    """Rows and distinct values of each group and, under null, of all."""
    return rows.rollup(group).agg(F.count("*").alias("n"), F.count_distinct(distinct).alias("distinct"))


def roll_text(rows: DataFrame, keys: list[str], order: str, text: str, separator: str = "\n") -> DataFrame:
    """Texts of a group joined in order."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), separator)
    return rows.groupBy(*keys).agg(joined.alias("text"), F.count("*").alias("n"))


def broken_links(links: DataFrame, files: DataFrame) -> DataFrame:
    """links (page, href) to files (path) that don't exist: fragments and queries go, folders mean their index, ".." is resolved."""
    target = F.regexp_replace("href", "[#?].*$", "")
    base = F.when(F.startswith(target, F.lit("/")), F.lit("")).otherwise(F.regexp_replace("page", "[^/]*$", ""))
    parts = F.split(F.concat(base, target), "/")
    walked = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: F.when((p == ".") | (p == ""), acc).when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, p)))
    path = F.array_join(walked, "/")
    # a folder's file is its index
    path = F.when(F.endswith(target, F.lit("/")) | (path == ""), F.concat(path, F.when(path == "", "index.html").otherwise("/index.html"))).otherwise(path)
    local = links.where(~F.col("href").rlike("^(?:[a-z]+:|//|#)")).select("page", "href", path.alias("path"))
    return local.join(files, "path", "left_anti")


def gate(notes: DataFrame, strict: bool, what: str = "findings") -> int:
    """The number of notes; an error if there are any and the run is strict."""
    n = notes.count()
    if n and strict:
        examples = "; ".join(str(tuple(r)) for r in notes.limit(3).collect())
        raise ValueError(f"{n} {what}: {examples}")
    return n


def unknown_terms(texts: DataFrame, column: str, terms: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """CURIEs of a text column whose IRI isn't among `terms` (term)."""
    from ..functions.text import curies

    spaces = F.create_map(*[F.lit(x) for kv in prefixes.items() for x in kv])
    found = texts.select(F.explode(curies(F.col(column), list(prefixes))).alias("curie")).distinct()
    named = found.withColumn("term", F.concat(spaces[F.substring_index("curie", ":", 1)], F.regexp_replace("curie", "^[^:]*:", "")))
    return named.join(terms, "term", "left_anti").select("curie")

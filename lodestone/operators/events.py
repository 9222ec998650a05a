"""Events: anchored clusters, roll-up, map features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import orbits

#: Distinct days of a key that are folded in one array; a key with more has its anchors found by pointers.
FEW = 512


def anchored_clusters(rows: DataFrame, keys: list[str], at: str, order: list[str], days: int = 14) -> DataFrame:
    """Adds `cluster`, the number of a row's cluster within its keys.

    In the order (`order`, `at`), a row joins the open cluster if it begins at most `days` after
    the cluster's first date, or if either date is missing; otherwise it opens one. The distance
    counts from the anchor, so this is no session window. An ordered fold over each group.
    """
    item = F.struct(*[F.col(c) for c in order], F.col(at).cast("date").alias("__at"), F.struct(*[F.col(c) for c in rows.columns]).alias("__row"))
    lists = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("__items"))

    numbered = lists.select("__items", _numbers(F.col("__items"), days).alias("__n"))
    return numbered.select(F.explode(F.arrays_zip("__items", "__n")).alias("z")).select("z.__items.__row.*", F.col("z.__n").alias("cluster"))


def _numbers(items: Column, days: int) -> Column:
    """Cluster numbers of items (with a date `__at`) in their order: an ordered fold."""

    def step(acc: Column, x: Column) -> Column:
        day = x["__at"]
        stays = (acc["n"] > 0) & (day.isNull() | acc["anchor"].isNull() | (F.datediff(day, acc["anchor"]) <= days))
        n = F.when(stays, acc["n"]).otherwise(acc["n"] + 1)
        return F.struct(n.alias("n"), F.when(stays, acc["anchor"]).otherwise(day).alias("anchor"), F.array_append(acc["out"], n).alias("out"))

    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast("date").alias("anchor"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(items, start, step, lambda a: a["out"])


def anchored_by_day(rows: DataFrame, keys: list[str], at: str, days: int = 14, few: int = FEW) -> DataFrame:
    """anchored_clusters in the order of `at` alone (missing dates first), for keys with very many rows.

    Rows of one day are in one cluster, so what is numbered are the distinct days of a key; rows get
    their number by a join on key and day. Keys of at most `few` days are folded, others go by pointers
    from each day to the first one beyond its span. With a missing date all of a key is one cluster.
    """
    own = rows.withColumn("__at", F.col(at).cast("date"))
    seen = own.select(F.struct(*keys).alias("__k"), "__at").distinct()
    sizes = seen.groupBy("__k").agg(F.count("*").alias("n"))
    many = sizes.where(F.col("n") > few).select("__k")
    large = not many.isEmpty()
    small = seen.join(many, "__k", "left_anti") if large else seen
    numbers = _folded(small.groupBy("__k").agg(F.array_sort(F.collect_list(F.struct("__at"))).alias("__items")), days)
    if large:
        numbers = numbers.unionByName(_pointed(seen.join(many, "__k", "left_semi"), days))
    numbers = numbers.select(*[F.col("__k")[k].alias(f"__{k}") for k in keys], F.col("__at").alias("__day"), "cluster")
    same = own["__at"].eqNullSafe(numbers["__day"])
    for k in keys:
        same = same & own[k].eqNullSafe(numbers[f"__{k}"])
    return own.join(numbers, same).select(*rows.columns, "cluster")


def _folded(lists: DataFrame, days: int) -> DataFrame:
    """(__k, __at, cluster) of keys with their days in an array."""
    return lists.select("__k", F.explode(F.arrays_zip("__items", _numbers(F.col("__items"), days).alias("__n"))).alias("z")).select("__k", F.col("z.__items.__at").alias("__at"), F.col("z.__n").alias("cluster"))


def _pointed(seen: DataFrame, days: int) -> DataFrame:
    """(__k, __at, cluster) of keys with any number of days.

    Days lie in buckets as wide as a span, so a day's pointer, the first day beyond its span, is in the
    next bucket or the first day of the first one after that which holds any. A key has at most as many
    days as the calendar, so windows over its buckets and days are bounded.
    """
    width = days + 1
    undated = seen.where("__at IS NULL").select("__k")
    day = F.unix_date("__at")
    dated = seen.where("__at IS NOT NULL").join(undated, "__k", "left_anti").select("__k", day.alias("day"), F.floor(day / width).alias("bucket"), F.pmod(day, F.lit(width)).alias("place"))
    held = dated.select("__k", "bucket", "place", F.lit(1).alias("held"), "day")
    asked = dated.select("__k", (F.col("bucket") + 1).alias("bucket"), "place", F.lit(0).alias("held"), "day")
    down = Window.partitionBy("__k", "bucket").orderBy(F.desc("place"), F.desc("held")).rowsBetween(Window.unboundedPreceding, 0)
    near = held.unionByName(asked).withColumn("near", F.last(F.when(F.col("held") == 1, F.col("day")), True).over(down)).where("held = 0").select("__k", "day", (F.col("bucket") - 1).alias("bucket"), "near")
    along = Window.partitionBy("__k").orderBy("bucket")
    firsts = dated.groupBy("__k", "bucket").agg(F.min("day").alias("first")).select("__k", "bucket", F.lead("bucket").over(along).alias("after"), F.lead("first").over(along).alias("one"), F.lead("first", 2).over(along).alias("two"))
    far = F.when(F.col("after") == F.col("bucket") + 1, F.col("two")).otherwise(F.col("one"))
    steps = near.join(firsts, ["__k", "bucket"]).select("__k", "day", F.coalesce("near", far).alias("next")).where("next IS NOT NULL")
    node = lambda c: F.struct("__k", F.col(c).alias("day"))
    levels = orbits.powers(steps.select(node("day").alias("a"), node("next").alias("b")))
    anchors = orbits.orbits(levels, dated.groupBy("__k").agg(F.min("day").alias("day")).select(node("day").alias("node"))).select("node.__k", "node.day", F.lit(1).alias("anchor"))
    numbered = dated.select("__k", "day").join(anchors, ["__k", "day"], "left").withColumn("cluster", F.sum(F.coalesce("anchor", F.lit(0))).over(Window.partitionBy("__k").orderBy("day")).cast("int"))
    whole = seen.join(undated, "__k", "left_semi").select("__k", "__at", F.lit(1).alias("cluster"))
    return numbered.select("__k", F.date_from_unix_date("day").alias("__at"), "cluster").unionByName(whole)


def roll_up(rows: DataFrame, keys: list[str], start: str, end: str, place: str) -> DataFrame:
    """One row an event: first start, last end, the place of the first row that has one."""
    return rows.groupBy(*keys).agg(F.min(start).alias("start"), F.max(end).alias("end"), F.min_by(place, F.when(F.col(place).isNotNull(), F.struct(start, place))).alias("place"), F.count("*").alias("n"))


def point(wkt: Column) -> Column:
    """struct(lon, lat) of "POINT(lon lat)"; another text is an error."""
    pattern = r"^\s*(?:<[^>]*>\s*)?POINT\s*\(\s*(-?[0-9.]+)\s+(-?[0-9.]+)\s*\)\s*$"
    checked = F.when(wkt.rlike(pattern), wkt).when(wkt.isNotNull(), F.raise_error(F.concat(F.lit("no point: "), wkt)).cast("string"))
    return F.struct(F.regexp_extract(checked, pattern, 1).cast("double").alias("lon"), F.regexp_extract(checked, pattern, 2).cast("double").alias("lat"))


def features(rows: DataFrame) -> DataFrame:
    """rows (event, name, start, end, lon, lat, place, place_label, entry, label, title, issued, volume, issue, n; one for each entry of an event) -> (event, feature: GeoJSON text), latest first.

    Entries are a set in journal order; events are sorted by (start or "", name), both falling.
    """
    entries = F.array_sort(F.collect_set(F.struct("volume", "issue", "n", "entry", "label", "title", "issued")))
    grouped = rows.groupBy("event").agg(F.min("name").alias("name"), F.min("start").alias("start"), F.max("end").alias("end"), F.first("lon", True).alias("lon"), F.first("lat", True).alias("lat"), F.min("place").alias("place"), F.min("place_label").alias("place_label"), entries.alias("es"))
    own = F.transform("es", lambda e: F.struct(e["entry"].alias("iri"), e["label"].alias("label"), e["title"].alias("title"), e["issued"].alias("issued")))
    body = F.struct(
        F.lit("Feature").alias("type"), F.col("event").alias("id"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
        F.struct("name", "start", "end", F.struct(F.col("place").alias("iri"), F.col("place_label").alias("label")).alias("place"), own.alias("entries")).alias("properties"),
    )
    return grouped.orderBy(F.coalesce("start", F.lit("")).desc(), F.col("name").desc(), "event").select("event", F.to_json(body).alias("feature"))


def by_place(rows: DataFrame) -> DataFrame:
    """Map markers: features and entries of each place."""
    return rows.groupBy("place").agg(F.count_distinct("event").alias("events"), F.count_distinct("entry").alias("entries"), F.first("lon", True).alias("lon"), F.first("lat", True).alias("lat"))


def inside_share(points: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """The share of points in a box, and whether it makes the box the viewport (80 % or more)."""
    inside = F.col("lon").between(west, east) & F.col("lat").between(south, north)
    return points.agg(F.avg(inside.cast("double")).alias("share")).select("share", (F.col("share") >= 0.8).alias("fits"))

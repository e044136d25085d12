"""Values of call arguments, clustered at three levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAP = 120
#: Bytes of a level's values, 32 more for each, up to which drawn() broadcasts it.
BROADCAST_BYTES = 32_000_000


def observed(args: DataFrame) -> DataFrame:
    """level, func, param, p_type, observed: counts of arguments by (func, param), by param and by known type.

    args: func, param, p_type, cluster, value, source, ord.  One pass over the arguments by grouping sets.
    """
    one = args.select("func", "param", "p_type")
    by_param = one.groupingSets([["func", "param"], ["param"]], "func", "param").agg(F.count(F.lit(1)).alias("observed"), F.grouping("func").alias("g"))
    first = by_param.select(F.when(F.col("g") == 1, "param").otherwise("function").alias("level"), "func", "param", F.lit(None).cast("string").alias("p_type"), "observed")
    kinds = one.where("p_type <> 'unknown'").groupBy("p_type").agg(F.count(F.lit(1)).alias("observed"))
    return first.unionByName(kinds.select(F.lit("type").alias("level"), F.lit(None).cast("string").alias("func"), F.lit(None).cast("string").alias("param"), "p_type", "observed"))


def values(args: DataFrame, keys: list[str], cap: int = CAP) -> DataFrame:
    """The first `cap` distinct values of each cluster, by order of arrival, with their counts."""
    distinct = args.groupBy(*keys, "cluster", "value").agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("occurrences"))
    rank = F.row_number().over(Window.partitionBy(*keys, "cluster").orderBy("first", "value"))
    return distinct.withColumn("value_rank", rank).where(F.col("value_rank") <= cap).drop("first")


def cluster_counts(args: DataFrame, keys: list[str], cap: int = CAP) -> DataFrame:
    """occurrences, and merged_count: distinct values up to the cap, summed over sources."""
    per = args.groupBy(*keys, "cluster", "source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("d"))
    return per.groupBy(*keys, "cluster").agg(F.sum("n").alias("occurrences"), F.sum(F.least("d", F.lit(cap))).alias("merged_count"))


def drawn(args: DataFrame, pool: DataFrame, seed: int, most: int) -> DataFrame:
    """args with level_rank and others: up to `most` other values, by hash, from the first level of the pool that has any.

    args: uuid, message_index, func, param, p_type, value, and any more.  pool: level_rank (0 function, 1 param, 2 type),
    func, param, p_type, value.  Each entry of the pool is one list, and an argument stays one row, whatever the pool
    holds.  Levels of up to BROADCAST_BYTES are broadcast, as a few keys may have all arguments.
    """
    sizes = dict(pool.groupBy("level_rank").agg(F.sum(F.octet_length("value") + 32)).collect())
    key = lambda x: F.md5(F.concat_ws("|", F.lit(str(seed)), "uuid", "message_index", "param", x).cast("binary"))
    found = args.withColumn("others", F.array().cast("array<string>")).withColumn("level_rank", F.lit(None).cast("int"))
    for level, on in enumerate((["func", "param"], ["param"], ["p_type"])):
        own = pool.where(F.col("level_rank") == level).groupBy(*(F.col(c).alias(f"_{c}") for c in on)).agg(F.collect_set("value").alias("_values"))
        own = F.broadcast(own) if (sizes.get(level) or 0) <= BROADCAST_BYTES else own
        both = found.join(own, [F.col(c) == F.col(f"_{c}") for c in on], "left")
        ranked = F.array_sort(F.transform(F.filter("_values", lambda x: x != F.col("value")), lambda x: F.struct(key(x).alias("key"), x.alias("other"))))
        own_others = F.coalesce(F.transform(F.slice(ranked, 1, most), lambda x: x["other"]), F.array().cast("array<string>"))
        had = F.size("others") > 0
        both = both.withColumns({"others": F.when(had, F.col("others")).otherwise(own_others), "level_rank": F.when(had, F.col("level_rank")).otherwise(F.lit(level))})
        found = both.select(*args.columns, "others", "level_rank")
    return found


def substitutes(args: DataFrame, pool: DataFrame, seed: int, most: int) -> DataFrame:
    """For each argument up to `most` other values from the first level of the pool that has any, one a row.

    As drawn(), where arguments of one uuid, message_index and param count as one.
    """
    arg = drawn(args.select("uuid", "message_index", "func", "param", "p_type", "value"), pool, seed, most)
    found = arg.select("*", F.explode("others").alias("other")).drop("others")
    w = Window.partitionBy("uuid", "message_index", "param")
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "uuid", "message_index", "param", "other").cast("binary"))
    first = found.withColumn("least", F.min("level_rank").over(w)).where("level_rank = least").dropDuplicates(["uuid", "message_index", "param", "other"])
    return first.withColumn("pick", F.row_number().over(w.orderBy(key, "other"))).where(F.col("pick") <= most).drop("least")


def levels(args: DataFrame) -> DataFrame:
    """Arguments once for each level: level_rank and level (function, param, type), the keys of that level, and the rest.

    args: func, param, p_type, cluster, value, source, ord, required.  Arguments of unknown type are no entries of the type level.
    """
    none = F.lit(None).cast("string")
    own = lambda rank, level, kept: F.struct(F.lit(rank).alias("level_rank"), F.lit(level).alias("level"), *((F.col(c) if c in kept else none).alias(c) for c in ("func", "param", "p_type")))
    types = F.when(F.col("p_type") != "unknown", own(2, "type", ("p_type",)))
    each = F.filter(F.array(own(0, "function", ("func", "param")), own(1, "param", ("param",)), types), lambda x: x.isNotNull())
    return args.select(F.explode(each).alias("k"), F.col("p_type").alias("type"), "cluster", "value", "source", "ord", "required").select("k.*", "type", "cluster", "value", "source", "ord", "required")


LEVEL = ["level_rank", "level", "func", "param", "p_type"]


def entries(args: DataFrame) -> DataFrame:
    """One row for each entry of each level: observed, required (of any argument), type (the first that is known)."""
    own = levels(args)
    first = F.min_by(F.when(F.col("type") != "unknown", F.col("type")), F.when(F.col("type") != "unknown", F.col("ord")))
    return own.groupBy(*LEVEL).agg(F.count(F.lit(1)).alias("observed"), F.bool_or("required").alias("required"), first.alias("type"))


def pool(args: DataFrame, cap: int = CAP) -> DataFrame:
    """The whole pool: the first `cap` distinct values of each cluster of each entry, with value_rank and occurrences."""
    return values(levels(args), LEVEL, cap)


def merge(snapshots: DataFrame, cap: int = CAP) -> DataFrame:
    """One pool from the pools of several runs: LEVEL, cluster, value, value_rank, occurrences, and merged_count for each cluster.

    snapshots: LEVEL, cluster, value, value_rank, occurrences, snapshot (its place in the order of runs).  Values come in
    the order of runs and of their ranks; a cluster counts each run's kept values once.
    """
    key = [*LEVEL, "cluster"]
    one = snapshots.groupBy(*key, "value").agg(F.min(F.struct("snapshot", "value_rank")).alias("first"), F.sum("occurrences").alias("occurrences"), F.count(F.lit(1)).alias("runs"))
    w = Window.partitionBy(*key)
    ranked = one.withColumn("value_rank", F.row_number().over(w.orderBy("first", "value"))).withColumn("merged_count", F.sum("runs").over(w))
    return ranked.where(F.col("value_rank") <= cap).drop("first", "runs")


def summary(records: int, files: int, calls: int, arguments: int, source_path: str, stats_path: str | None, cap: int, created_at: str) -> dict:
    """The block `meta` of a pool's file; its names are fixed values."""
    return {"created_at": created_at, "source_path": source_path, "files_count": files, "total_records": records, "total_function_calls": calls, "total_arguments": arguments, "stats_path": stats_path, "max_values_per_cluster": cap}

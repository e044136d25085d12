"""Multiple-choice questions.  Draws are ranks of hashes, so results repeat under any partitioning."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toolloom.functions import text as X
from toolloom.session import ship


#: (tool, token) rows up to which nearest() broadcasts its index: 4 bytes each, and the names.
INDEX_ROWS = 5_000_000


def nearest(profiles: DataFrame, k: int, most: int = INDEX_ROWS) -> DataFrame:
    """function_name, other, score, rank: the k other tools with most tokens in common, ties by falling name.

    profiles: function_name (distinct), tokens (array).  Tools without a common token fill up.  A catalog of
    up to `most` rows (tool, token) is indexed once and broadcast; a larger one is joined with itself by token.
    """
    rows = profiles.select("function_name", F.explode(F.array_distinct("tokens")).alias("token"))
    return _nearest_by_index(profiles, rows, k) if rows.limit(most + 1).count() <= most else _nearest_by_join(profiles, rows, k)


def _nearest_by_index(profiles: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    ship(profiles.sparkSession)
    known = rows.toPandas()
    names = np.array(sorted(r["function_name"] for r in profiles.select("function_name").collect()), object)
    place = {x: i for i, x in enumerate(names)}
    codes, tokens = pd.factorize(known["token"])
    order = np.argsort(codes, kind="stable")
    tools = known["function_name"].map(place).to_numpy(np.int32, na_value=0)[order]
    first = np.searchsorted(codes[order], np.arange(len(tokens) + 1))
    sent = profiles.sparkSession.sparkContext.broadcast((names, {t: i for i, t in enumerate(tokens)}, first, tools))  # bounded by INDEX_ROWS

    def run(parts):
        names, code, first, tools = sent.value
        n, at = len(names), {x: i for i, x in enumerate(names)}
        top = min(k, n - 1)
        for pdf in parts:
            out = []
            for name, own in zip(pdf["function_name"], pdf["tokens"]):
                lists = [tools[first[c] : first[c + 1]] for t in set(own) if (c := code.get(t)) is not None]
                score = np.bincount(np.concatenate(lists), minlength=n) if lists else np.zeros(n, np.int64)
                key = score * n + np.arange(n)  # names ascend, so a later one wins a tie
                key[at[name]] = -1
                if top > 0:
                    best = np.argpartition(key, n - top)[n - top :]
                    best = best[np.argsort(-key[best])]
                    out += [(name, names[b], int(score[b]), r + 1) for r, b in enumerate(best)]
            yield pd.DataFrame(out, columns=["function_name", "other", "score", "rank"])

    return profiles.select("function_name", "tokens").mapInPandas(run, "function_name string, other string, score long, rank int")


def _nearest_by_join(profiles: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    total = profiles.count()
    counted = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # tokens that every tool has add the same to each score
    every = counted.where(F.col("n") == total).count()
    words = rows.join(counted.where(F.col("n") < total).select("token"), "token")
    pairs = words.join(words.withColumnRenamed("function_name", "other"), "token").where("function_name <> other")
    score = pairs.groupBy("function_name", "other").agg((F.count(F.lit(1)) + every).alias("score"))
    rank = F.row_number().over(Window.partitionBy("function_name").orderBy(F.desc("score"), F.desc("other")))
    scored = score.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
    # what fills up: of the last 2k + 1 names at most k + 1 are the tool's own or scored
    last = profiles.select(F.col("function_name").alias("other")).orderBy(F.desc("other")).limit(2 * k + 1)
    many = scored.groupBy("function_name").agg(F.count(F.lit(1)).alias("n"))
    short = profiles.select("function_name").join(many, "function_name", "left").where(F.coalesce("n", F.lit(0)) < k).select("function_name")
    fill = short.join(F.broadcast(last)).where("function_name <> other").join(scored, ["function_name", "other"], "left_anti").withColumn("score", F.lit(every).cast("long"))
    return scored.unionByName(fill.select("function_name", "other", "score")).withColumn("rank", rank).where(F.col("rank") <= k)


def shuffled(options: DataFrame, key: list[str], seed: int) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(X.rank_key(f"{seed}s", *(F.col(c) for c in key), F.col("option")), "option")
    return options.withColumn("position", F.row_number().over(w) - 1).withColumn("letter", X.letter(F.col("position")))


def param_options(catalog: DataFrame) -> DataFrame:
    """function_name, option, is_answer from `properties` and `required` (arrays of names).

    Right: all required names.  Wrong: one left out (if there are two or more), or one optional added.
    Functions without a required property, or without a wrong option, have no question.
    """
    req = F.array_sort(F.array_intersect("required", "properties"))
    c = catalog.select("function_name", req.alias("r"), F.array_except("properties", "required").alias("o")).where(F.size("r") > 0)
    text = lambda x: F.array_join(F.array_sort(x), ", ")
    less = F.when(F.size("r") > 1, F.transform("r", lambda x: text(F.array_remove(F.col("r"), x)))).otherwise(F.array().cast("array<string>"))
    more = F.transform("o", lambda x: text(F.array_append(F.col("r"), x)))
    wrong = c.withColumn("w", F.array_distinct(F.concat(less, more))).where(F.size("w") > 0)
    rows = wrong.select("function_name", F.explode("w").alias("option"), F.lit(False).alias("is_answer"))
    return rows.unionByName(wrong.select("function_name", text(F.col("r")).alias("option"), F.lit(True).alias("is_answer")))


def drop_variants(args: DataFrame) -> DataFrame:
    """Argument texts of each call with one argument left out, and the right one: uuid, message_index, dropped, option.

    args: uuid, message_index, param, value (text).  A call's only argument cannot be left out.
    """
    key = ["uuid", "message_index"]
    own = args.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("param", "value"))).alias("a"))
    text = lambda x: F.array_join(F.transform(x, lambda p: F.concat(p["param"], F.lit("="), p["value"])), "; ")
    right = own.select(*key, F.lit(None).cast("string").alias("dropped"), text(F.col("a")).alias("option"))
    less = own.where(F.size("a") > 1).select(*key, "a", F.explode("a.param").alias("dropped"))
    return right.unionByName(less.select(*key, "dropped", text(F.filter("a", lambda p: p["param"] != F.col("dropped"))).alias("option")))


def value_options(args: DataFrame, negatives: int, seed: int) -> DataFrame:
    """uuid, message_index, option, is_answer, position, letter from left-out and replaced arguments.

    args: uuid, message_index, param, value (text), others (texts for its place, or null).  Distinct wrong texts are
    drawn by hash.  A call is one row until its options are drawn.  Calls without a uuid have no question.
    """
    key = ["uuid", "message_index"]
    own = args.where("uuid is not null and message_index is not null").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("param", "value", "others"))).alias("a"))
    text = lambda x, value=lambda p: p["value"]: F.array_join(F.transform(x, lambda p: F.concat(p["param"], F.lit("="), value(p))), "; ")
    none = F.array().cast("array<string>")
    less = F.when(F.size("a") > 1, F.transform("a", lambda p: text(F.filter("a", lambda q: q["param"] != p["param"])))).otherwise(none)
    changed = F.flatten(F.transform("a", lambda p: F.transform(F.coalesce(p["others"], none), lambda o: text(F.col("a"), lambda q: F.when(q["param"] == p["param"], o).otherwise(q["value"])))))
    by_hash = lambda xs, salt: F.transform(F.array_sort(F.transform(xs, lambda x: F.struct(X.rank_key(salt, *(F.col(c) for c in key), x).alias("key"), x.alias("option")))), lambda x: x["option"])
    all_ = own.select(*key, text(F.col("a")).alias("right"), F.array_distinct(F.concat(less, changed)).alias("wrong"))
    few = all_.select(*key, "right", F.slice(by_hash(F.filter("wrong", lambda x: x != F.col("right")), seed), 1, negatives).alias("few"))
    rows = few.select(*key, "right", F.when(F.size("few") > 0, by_hash(F.array_append("few", F.col("right")), f"{seed}s")).alias("options"))
    # outer, as else Spark computes the lists once more to filter the calls
    each = rows.select(*key, "right", F.posexplode_outer("options").alias("position", "option")).where("option is not null")
    return each.select(*key, "option", (F.col("option") == F.col("right")).alias("is_answer"), "position", X.letter(F.col("position")).alias("letter"))

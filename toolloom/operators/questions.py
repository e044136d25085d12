"""Questions of the three modes from trajectories, end to end, as rows of seven columns.

Draws are ranks of hashes (see functions/text.py), so that rows repeat under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toolloom.functions import fidelity
from toolloom.functions import text as X
from toolloom.operators import catalog as C
from toolloom.operators import mcq, pool
from toolloom.operators import trajectories as T

KEY = ["uuid", "message_index"]
COLUMNS = ["mode", "question", "options", "answer", "function_name", "record_uuid", "message_index"]
#: Of the wrong options that a catalog gives, the share from the tool's own family.
FAMILY_SHARE = 0.3


def distractors(asked: DataFrame, have: DataFrame, profiles: DataFrame, seed: int) -> DataFrame:
    """uuid, message_index, option: up to `needed` tools that the record lacks.

    asked: uuid, message_index, func, needed (1 or more).  have: uuid, function_name.  profiles:
    function_name, tokens.  First tools of the same family, by hash, up to a share of 0.3 (one at least);
    then, but for one place, those with most tokens in common; then any by hash.
    """
    most = asked.agg(F.max("needed")).first()[0] or 0
    held = have.groupBy("uuid").agg(F.count_distinct("function_name").alias("n")).agg(F.max("n")).first()[0] or 0
    k = int(2 * most + held + 1)  # so many of a tool's list are enough, whatever a record has
    named = profiles.select("function_name", X.family(F.col("function_name")).alias("family"))
    # of a family the first k by a hash of the member alone, and of all tools likewise
    first = named.withColumn("r", F.row_number().over(Window.partitionBy("family").orderBy(X.rank_key(seed, F.col("function_name")), "function_name"))).where(F.col("r") <= k)
    kin = named.join(first.select("family", F.col("function_name").alias("option")), "family").select(F.col("function_name").alias("func"), "option", F.lit(0).alias("tier"), F.lit(0).alias("n"))
    near = mcq.nearest(profiles, k).select(F.col("function_name").alias("func"), F.col("other").alias("option"), F.lit(1).alias("tier"), F.col("rank").alias("n"))
    # and of all tools the first k, as a list that every name has: k is small, and calls meet one table of lists
    some = profiles.select("function_name").orderBy(X.rank_key(seed, F.col("function_name")), "function_name").limit(k).agg(F.collect_list("function_name").alias("options"))
    rest = named.join(F.broadcast(some)).select(F.col("function_name").alias("func"), F.explode("options").alias("option"), F.lit(2).alias("tier"), F.lit(0).alias("n"))
    every = asked.join(kin.unionByName(near).unionByName(rest), "func").select(*KEY, "func", "needed", "option", "tier", "n")
    every = every.where("option <> func").join(have.select("uuid", F.col("function_name").alias("option")).distinct(), ["uuid", "option"], "left_anti")
    draw = X.rank_key(seed, F.col("uuid"), F.col("message_index"), F.col("option"))
    own = Window.partitionBy(*KEY, "tier")
    placed = every.withColumn("draw", draw).withColumn("place", F.row_number().over(own.orderBy("n", "draw", "option")))
    target = F.greatest(F.lit(1), F.bround(F.col("needed") * FAMILY_SHARE).cast("int"))
    family = placed.withColumn("kin", (F.col("tier") == 0) & (F.col("place") <= target))
    # a tool in several lists counts once: as kin, else by its nearness, else by hash
    one = family.where("tier > 0 or kin").groupBy(*KEY, "needed", "option", "draw").agg(F.min(F.struct("tier", "n")).alias("t"))
    kin_n = F.sum(F.when(F.col("t.tier") == 0, 1).otherwise(0)).over(Window.partitionBy(*KEY))
    ranked = one.withColumn("kin", kin_n).withColumn("place", F.row_number().over(Window.partitionBy(*KEY, F.col("t.tier")).orderBy("t.n", "draw", "option")))
    chosen = F.when(F.col("t.tier") == 0, 0).when((F.col("t.tier") == 1) & (F.col("place") <= F.greatest(F.lit(0), F.col("needed") - F.col("kin") - 1)), 1).otherwise(2)
    order = Window.partitionBy(*KEY).orderBy("choice", F.when(F.col("choice") < 2, F.col("place")), "draw", "option")
    return ranked.withColumn("choice", chosen).withColumn("last", F.row_number().over(order)).where("last <= needed").select(*KEY, "option")


def available(calls: DataFrame, have: DataFrame, profiles: DataFrame, negatives: int, seed: int) -> DataFrame:
    """uuid, message_index, option, is_answer, position, letter.

    calls: uuid, message_index, func.  have: uuid, function_name.  Wrong options are the record's other tools,
    by hash if they are too many, and distractors() if too few.  No question where the call's tool is not among the record's.
    """
    most = max(1, negatives)
    have = have.select("uuid", "function_name").distinct()
    ok = calls.select(*KEY, "func").join(have.withColumnRenamed("function_name", "func"), ["uuid", "func"], "left_semi")
    own = ok.join(have, "uuid").where("function_name <> func").select(*KEY, "func", F.col("function_name").alias("option"))
    w = Window.partitionBy(*KEY).orderBy(X.rank_key(seed, F.col("uuid"), F.col("message_index"), F.col("option")), "option")
    base = own.withColumn("r", F.row_number().over(w)).where(F.col("r") <= most).select(*KEY, "option")
    filled = base.groupBy(*KEY).agg(F.count(F.lit(1)).alias("filled"))
    asked = ok.join(filled, KEY, "left").select(*KEY, "func", (F.lit(most) - F.coalesce("filled", F.lit(0))).cast("int").alias("needed")).where("needed > 0")
    wrong = base.unionByName(distractors(asked, have, profiles, seed)).withColumn("is_answer", F.lit(False))
    right = ok.join(wrong.select(*KEY).distinct(), KEY, "left_semi").select(*KEY, F.col("func").alias("option"), F.lit(True).alias("is_answer"))
    return mcq.shuffled(wrong.unionByName(right), KEY, seed)


def parameter_sets(properties: DataFrame) -> DataFrame:
    """function_name, option, is_answer for each function with a required property.

    properties: function_name, param, required.  Wrong: the required ones less one, or with an optional one; if there are none, single properties.
    """
    own = properties.groupBy("function_name").agg(F.array_sort(F.collect_set(F.when(F.col("required"), F.col("param")))).alias("r"), F.array_sort(F.collect_set("param")).alias("p")).where(F.size("r") > 0)
    text = lambda x: F.array_join(F.array_sort(x), ", ")
    less = F.when(F.size("r") > 1, F.transform("r", lambda x: text(F.array_remove(F.col("r"), x)))).otherwise(F.array().cast("array<string>"))
    more = F.transform(F.array_except("p", "r"), lambda x: text(F.array_append(F.col("r"), x)))
    both = own.select("function_name", text(F.col("r")).alias("right"), "p", F.array_distinct(F.concat(less, more)).alias("w"))
    wrong = both.select("function_name", "right", F.when(F.size("w") > 0, F.col("w")).otherwise(F.array_remove("p", F.col("right"))).alias("w")).where(F.size("w") > 0)
    return wrong.select("function_name", F.explode("w").alias("option"), F.lit(False).alias("is_answer")).unionByName(wrong.select("function_name", F.col("right").alias("option"), F.lit(True).alias("is_answer")))


def params(calls: DataFrame, properties: DataFrame, negatives: int, seed: int) -> DataFrame:
    sets = calls.select(*KEY, "func").join(parameter_sets(properties).withColumnRenamed("function_name", "func"), "func")
    w = Window.partitionBy(*KEY, "is_answer").orderBy(X.rank_key(seed, F.col("uuid"), F.col("message_index"), F.col("option")), "option")
    few = sets.withColumn("r", F.row_number().over(w)).where(F.col("is_answer") | (F.col("r") <= negatives))
    return mcq.shuffled(few.select(*KEY, "option", "is_answer"), KEY, seed)


def strategies(negatives: int, seed: int, args: DataFrame, key: list[str] = KEY) -> DataFrame:
    """uuid, message_index, attempt, strategy: 8 * negatives draws for each call, a half from the pool, a quarter each of the two that drop.

    Fixed values: the strategies and their weights.
    """
    names = F.array(*map(F.lit, ("pool", "pool", "drop_required", "drop_any")))
    tries = args.select(*key).distinct().select(*key, F.explode(F.sequence(F.lit(0), F.lit(8 * negatives - 1))).alias("attempt"))
    draw = F.conv(F.substring(X.rank_key(f"{seed}strategy", *(F.col(c) for c in key), F.col("attempt")), 1, 8), 16, 10).cast("long")
    return tries.withColumn("strategy", F.get(names, F.pmod(draw, F.lit(4)).cast("int")))


def param_values(args: DataFrame, pool_: DataFrame, negatives: int, seed: int) -> DataFrame:
    """uuid, message_index, option, is_answer, position, letter.

    args: uuid, message_index, func, param, value (JSON text), p_type, required.  pool_: as for pool.substitutes.
    A wrong option leaves one argument out (a required one, or any) or takes one or two other values from
    the pool; how often each is tried follows strategies().
    """
    picks = pool.substitutes(args, pool_, seed, 2 * negatives).select(*KEY, "param", F.col("other").alias("value"), "pick")
    own = args.groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("param", "value"))).alias("a"), F.array_sort(F.collect_list("param")).alias("names"), F.array_sort(F.collect_list(F.when(F.col("required"), F.col("param")))).alias("needed"))
    text = lambda m: F.array_join(F.transform(F.array_sort(F.map_keys(m)), lambda k: F.concat(k, F.lit("="), F.element_at(m, k))), "; ")
    # of each parameter the other values in the order of their draw: at most 2 * negatives
    others = picks.groupBy(*KEY, "param").agg(F.transform(F.array_sort(F.collect_list(F.struct("pick", "value"))), lambda x: x["value"]).alias("o")).groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("param", "o"))).alias("others"))
    tries = strategies(negatives, seed, args).join(own, KEY).join(others, KEY, "left")
    number = lambda salt: F.conv(F.substring(X.rank_key(f"{seed}{salt}", F.col("uuid"), F.col("message_index"), F.col("attempt")), 1, 8), 16, 10).cast("long")
    choice = lambda xs, salt: F.get(xs, F.pmod(number(salt), F.greatest(F.size(xs), F.lit(1))).cast("int"))
    tries = tries.select(*KEY, "attempt", "strategy", "a", "others", choice(F.col("needed"), "r").alias("req"), choice(F.col("names"), "a").alias("one"), choice(F.col("names"), "b").alias("two"), F.pmod(number("k"), F.lit(2)).alias("both"), number("v").alias("draw"))
    gone = F.when(F.col("strategy") == "drop_required", F.col("req")).when(F.col("strategy") == "drop_any", F.col("one"))
    other = lambda k: F.get(F.element_at(F.col("others"), k), F.pmod(F.col("draw"), F.greatest(F.size(F.element_at(F.col("others"), k)), F.lit(1))).cast("int"))
    changed = F.transform_values("a", lambda k, v: F.when((k == F.col("one")) | ((F.col("both") == 1) & (k == F.col("two"))), F.coalesce(other(k), v)).otherwise(v))
    dropped = F.map_filter("a", lambda k, v: k != gone)
    option = F.when(F.col("strategy") == "pool", text(changed)).when(gone.isNotNull() & (F.size("a") > 1), text(dropped))
    made = tries.select(*KEY, "attempt", option.alias("option"), text(F.col("a")).alias("right")).where("option <> '' and option <> right")
    first = made.groupBy(*KEY, "option", "right").agg(F.min("attempt").alias("attempt"))
    few = first.withColumn("r", F.row_number().over(Window.partitionBy(*KEY).orderBy("attempt"))).where(F.col("r") <= negatives)
    rows = few.select(*KEY, "option", F.lit(False).alias("is_answer")).unionByName(few.select(*KEY, F.col("right").alias("option"), F.lit(True).alias("is_answer")).distinct())
    return mcq.shuffled(rows, KEY, seed)


def rows(options: DataFrame, calls: DataFrame, mode: str) -> DataFrame:
    """The seven columns of a question from its options."""
    wording = {"available": F.lit(X.QUESTION_AVAILABLE), "params": F.format_string(X.QUESTION_PARAMS.replace("{}", "%s"), "func"), "param_values": F.format_string(X.QUESTION_VALUES.replace("{}", "%s"), "func")}[mode]
    one = options.groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "option"))), lambda x: x["option"]).alias("options"), F.max(F.when(F.col("is_answer"), F.col("option"))).alias("answer"))
    return one.join(calls.select(*KEY, "func"), KEY).select(F.lit(mode).alias("mode"), wording.alias("question"), "options", "answer", F.col("func").alias("function_name"), F.col("uuid").alias("record_uuid"), "message_index")


def build(records: DataFrame, catalog: DataFrame, mode: str, negatives: int = 9, seed: int = 42, pool_: DataFrame | None = None, max_samples: int | None = None) -> DataFrame:
    """Questions of one mode on all calls of records.

    catalog: function_name, definition (JSON text).  pool_: level_rank, func, param, p_type, value (JSON text);
    without one there are no questions on values.  max_samples keeps the first ones in the order of record and message.
    """
    calls = C.calls(C.messages(records)).select(*KEY, "func", "arguments")
    if mode == "available":
        about = F.coalesce(F.get_json_object("definition", "$.function.description"), F.get_json_object("definition", "$.description"), F.lit("No description provided."))
        profiles = catalog.select("function_name", X.profile(F.col("function_name"), about).alias("tokens"))
        options = available(calls, T.available_names(records), profiles, negatives, seed)
    elif mode == "params":
        options = params(calls, T.properties(catalog), negatives, seed)
    elif mode == "param_values":
        if pool_ is None:
            return rows(params(calls.limit(0), T.properties(catalog), negatives, seed), calls, mode)
        args = T.with_schema(T.arguments(calls), T.properties(catalog)).withColumn("value", fidelity.canonical(F.to_json("value")))
        options = param_values(args, pool_, negatives, seed)
    else:
        raise ValueError(f"no mode {mode}")
    out = rows(options, calls, mode)
    return out.orderBy("record_uuid", "message_index").limit(max_samples) if max_samples else out


#: Strategies by name: the way to add one's own.
BUILDERS = {"available": available, "params": params, "param_values": param_values}

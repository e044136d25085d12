"""Queries over whole trajectory records (see lenses.trajectories), each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.functions import fidelity
from toolloom.functions import records as R
from toolloom.functions import text as X
from toolloom.operators import batch, catalog, obfuscate, pool, prompt, questions
from toolloom.operators import trajectories as T
from toolloom.plans import lenses as L
from toolloom.plans.queries import ALIAS, MARKED, MESSAGES, SEED, query
from toolloom.session import scratch, ship
from toolloom.sources import files

TOOLS = "own AS (SELECT DISTINCT conv_id, o, 'tool_' || CAST((conv_id + o) % 7 AS VARCHAR) AS name, CASE o WHEN 3 THEN 2 ELSE o END AS position FROM conversations, (VALUES (0), (1), (3)) AS v(o))"
SAID = f"{MESSAGES}, asked AS (SELECT CAST(uuid AS VARCHAR) AS uuid, CAST(message_index AS INT) AS message_index, func, role, message_index AS turn FROM msg WHERE is_call)"
MENTIONS = f"{SAID}, {TOOLS}, ment AS (SELECT 0 AS origin, name AS function_name FROM own UNION ALL SELECT 1, func FROM asked UNION ALL SELECT 2, 'srv_' || CAST(conv_id % 3 AS VARCHAR) FROM (SELECT DISTINCT conv_id FROM conversations))"
ARGS = f"{SAID}, arg AS (SELECT uuid, message_index, func, 'half' AS param, CAST(turn // 2 AS VARCHAR) AS value, 'number' AS p_type, true AS required FROM asked UNION ALL SELECT uuid, message_index, func, 'turn', CAST(turn AS VARCHAR), 'integer', true FROM asked UNION ALL SELECT uuid, message_index, func, 'who', '\"' || role || '\"', 'string', false FROM asked)"
ABOUT = f"{TOOLS}, def AS (SELECT name AS function_name, arg_min('Tool ' || substr(name, 6) || ' as of ' || CAST(conv_id AS VARCHAR), conv_id * 10 + position) AS about FROM own GROUP BY name)"


def _catalog(spark, d) -> DataFrame:
    t = L.trajectories(spark, d)
    found = T.definitions(t.withColumn("uuid", F.col("order_key")))
    return T.first_definitions(found, ["uuid", "position"])


def _calls(spark, d) -> DataFrame:
    return catalog.calls(catalog.messages(L.trajectories(spark, d))).select("uuid", "message_index", "func", "arguments")


def _args(spark, d) -> DataFrame:
    return T.with_schema(T.arguments(_calls(spark, d)), T.properties(_catalog(spark, d))).withColumn("value", F.to_json("value"))


@query(f"WITH {MENTIONS} SELECT origin, function_name, count(*) AS n FROM ment GROUP BY 1, 2")
def record_mentions(spark, d):
    return T.mentions(L.trajectories(spark, d)).groupBy("origin", "function_name").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {ABOUT} SELECT function_name, about FROM def")
def record_definitions(spark, d):
    return _catalog(spark, d).select("function_name", F.get_json_object("definition", "$.function.description").alias("about"))


@query(f"WITH {ARGS} SELECT uuid, message_index, func, param, value, p_type, required FROM arg")
def record_arguments(spark, d):
    return _args(spark, d).select("uuid", "message_index", "func", "param", "value", "p_type", "required")


@query(f"WITH {SAID} SELECT (SELECT count(DISTINCT conv_id) FROM conversations) AS records, count(*) AS calls, 3 * count(*) AS arguments FROM asked")
def record_totals(spark, d):
    calls = _calls(spark, d)
    return T.totals(L.trajectories(spark, d).select(F.col("messages").alias("line")), calls, T.arguments(calls))


@query("SELECT f AS function_name, p AS param, k AS position, t AS declared, r AS required FROM (SELECT DISTINCT 'tool_' || CAST((conv_id + o) % 7 AS VARCHAR) AS f FROM conversations, (VALUES (0), (1), (3)) AS v(o)), (VALUES ('half', 0, 'number', true), ('turn', 1, 'integer', true), ('who', 2, 'string', false)) AS x(p, k, t, r)")
def catalog_properties(spark, d):
    # positions as the variant keeps keys: in order
    return T.properties(_catalog(spark, d)).select("function_name", "param", F.col("position").cast("int").alias("position"), "declared", "required")


@query(f"WITH {ARGS} SELECT 'function' AS level, func, param, CAST(NULL AS VARCHAR) AS p_type, count(*) AS observed, bool_or(required) AS required, min(p_type) AS type FROM arg GROUP BY func, param UNION ALL SELECT 'param', NULL, param, NULL, count(*), bool_or(required), min(p_type) FROM arg GROUP BY param UNION ALL SELECT 'type', NULL, NULL, p_type, count(*), bool_or(required), min(p_type) FROM arg GROUP BY p_type")
def pool_entries(spark, d):
    return pool.entries(_pool_args(spark, d)).drop("level_rank")


def _pool_args(spark, d) -> DataFrame:
    return _args(spark, d).select("func", "param", "p_type", F.lit("all").alias("cluster"), "value", F.pmod(F.col("uuid").cast("long"), F.lit(4)).alias("source"), (F.col("uuid").cast("long") * 1000 + F.col("message_index")).alias("ord"), "required")


@query(f"WITH {ARGS}, a AS (SELECT param, value, CAST(uuid AS BIGINT) % 2 AS s, min(CAST(uuid AS BIGINT) * 1000 + message_index) AS f, count(*) AS n FROM arg GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY param, s ORDER BY f, value) AS k FROM a), kept AS (SELECT * FROM r WHERE k <= 3), m AS (SELECT param, value, min(s * 1000000 + k) AS o, sum(n) AS occurrences FROM kept GROUP BY 1, 2), z AS (SELECT *, row_number() OVER (PARTITION BY param ORDER BY o, value) AS value_rank FROM m) SELECT z.param, value, CAST(value_rank AS INT) AS value_rank, CAST(occurrences AS BIGINT) AS occurrences, (SELECT count(*) FROM kept WHERE kept.param = z.param) AS merged_count FROM z WHERE value_rank <= 3")
def pool_merged(spark, d):
    args = _pool_args(spark, d)
    runs = [pool.pool(args.where(F.pmod(F.floor("ord") / 1000, F.lit(2)).cast("int") == s), 3).withColumn("snapshot", F.lit(s)) for s in (0, 1)]
    return pool.merge(runs[0].unionByName(runs[1]), 3).where("level = 'param'").select("param", "value", "value_rank", "occurrences", "merged_count")


@query("SELECT CAST(conv_id AS VARCHAR) AS uuid, arg_max(text, turn) FILTER (WHERE role = 'user') AS said FROM conversations GROUP BY 1")
def last_user_message(spark, d):
    return L.trajectories(spark, d).select("uuid", prompt.last_user_message(F.col("messages")).alias("said"))


@query(f"WITH {SAID} SELECT uuid, message_index, 'half=' || CAST(turn // 2 AS VARCHAR) || '; turn=' || CAST(turn AS VARCHAR) || '; who=\"' || role || '\"' AS option, '{{\"half\": ' || CAST(turn // 2 AS VARCHAR) || ', \"turn\": ' || CAST(turn AS VARCHAR) || ', \"who\": \"' || role || '\"}}' AS canonical FROM asked")
def argument_texts(spark, d):
    ship(spark)
    return _calls(spark, d).select("uuid", "message_index", fidelity.format_arguments("arguments").alias("option"), fidelity.canonical("arguments").alias("canonical"))


@query(f"WITH {MENTIONS}, x AS (SELECT DISTINCT function_name, sha1('|' || function_name || '|0') AS h FROM ment), al AS (SELECT function_name, {ALIAS} AS alias FROM x), t AS (SELECT DISTINCT conv_id, 'tool_' || CAST(conv_id % 7 AS VARCHAR) AS f FROM conversations) SELECT 3 AS origin, alias AS function_name, count(*) AS n FROM t JOIN al ON al.function_name = f GROUP BY 1, 2 UNION ALL SELECT origin, alias, count(*) FROM ment JOIN al USING (function_name) GROUP BY 1, 2")
def masked_records(spark, d):
    t = L.trajectories(spark, d)
    done = obfuscate.obfuscate(t, catalog.build_aliases(T.mentions(t).select("function_name")))
    names = T.mentions(done).select("origin", "function_name").unionByName(done.select(F.lit(3).alias("origin"), F.col("target_tools").alias("function_name")))
    return names.groupBy("origin", "function_name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(conv_id AS VARCHAR) AS uuid, 0 AS leaks FROM (SELECT DISTINCT conv_id FROM conversations)")
def masked_leak_audit(spark, d):
    """Names of the alias map that masked tools, calls, targets and metadata still hold."""
    t = L.trajectories(spark, d)
    aliases = catalog.build_aliases(T.mentions(t).select("function_name"))
    done = obfuscate.obfuscate(t, aliases).select("uuid", F.concat_ws(" ", "available_tools", F.to_json(F.transform(F.from_json("messages", catalog.MESSAGES), lambda m: m["function_call"]["name"])), "target_tools", "metadata").alias("text"))
    left = catalog.leaks(done, aliases, "text").groupBy("uuid").agg(F.count(F.lit(1)).alias("leaks"))
    return done.select("uuid").join(left, "uuid", "left").select("uuid", F.coalesce("leaks", F.lit(0)).cast("int").alias("leaks"))


PLACE = "CAST(row_number() OVER (PARTITION BY uuid, message_index ORDER BY md5('42s|' || uuid || '|' || CAST(message_index AS VARCHAR) || '|' || option), option) - 1 AS INT)"


@query(f"WITH {SAID}, o AS (SELECT uuid, message_index, option, a AS is_answer FROM asked, (VALUES ('half, turn', true), ('half', false), ('turn', false), ('half, turn, who', false)) AS v(option, a)) SELECT uuid, message_index, option, is_answer, {PLACE} AS position FROM o")
def params_questions(spark, d):
    return questions.params(_calls(spark, d), T.properties(_catalog(spark, d)), 9, SEED).select("uuid", "message_index", "option", "is_answer", F.col("position").cast("int").alias("position"))


@query(f"WITH {SAID}, {TOOLS}, o AS (SELECT uuid, message_index, name AS option, name = func AS is_answer FROM asked JOIN own ON CAST(own.conv_id AS VARCHAR) = uuid) SELECT uuid, message_index, option, is_answer, {PLACE} AS position FROM o")
def available_questions(spark, d):
    t = L.trajectories(spark, d)
    c = _catalog(spark, d)
    profiles = c.select("function_name", X.profile(F.col("function_name"), F.get_json_object("definition", "$.function.description")).alias("tokens"))
    return questions.available(_calls(spark, d), T.available_names(t), profiles, 2, SEED).select("uuid", "message_index", "option", "is_answer", F.col("position").cast("int").alias("position"))


@query(f"WITH {SAID}, o AS (SELECT uuid, message_index, func, option FROM asked, (VALUES ('half, turn'), ('half'), ('turn'), ('half, turn, who')) AS v(option)) SELECT 'params' AS mode, 'When calling ' || func || ', which parameters must be provided? (Select all that apply)' AS question, string_agg(option, ' | ' ORDER BY md5('42s|' || uuid || '|' || CAST(message_index AS VARCHAR) || '|' || option), option) AS options, 'half, turn' AS answer, func AS function_name, uuid AS record_uuid, message_index FROM o GROUP BY uuid, message_index, func")
def question_rows(spark, d):
    """The driver of question modes, its rows written as JSON lines and read back."""
    path = scratch(spark, "questions")
    files.write_questions(questions.build(L.trajectories(spark, d), _catalog(spark, d), "params"), path)
    rows = spark.read.schema("mode string, question string, options array<string>, answer string, function_name string, record_uuid string, message_index int").json(path)
    return rows.withColumn("options", F.array_join("options", " | "))


DRAW = "CAST('0x' || substr(md5('42strategy|' || uuid || '|' || CAST(message_index AS VARCHAR) || '|' || CAST(attempt AS VARCHAR)), 1, 8) AS BIGINT)"


@query(f"WITH {SAID}, t AS (SELECT uuid, message_index, unnest(range(0, 16)) AS attempt FROM asked) SELECT uuid, message_index, CAST(attempt AS INT) AS attempt, (['pool', 'pool', 'drop_required', 'drop_any'])[{DRAW} % 4 + 1] AS strategy FROM t")
def strategy_draws(spark, d):
    return questions.strategies(2, SEED, _calls(spark, d)).select("uuid", "message_index", "attempt", "strategy")


@query(f"WITH {ABOUT} SELECT function_name, '- half (number) [required]: of the turn' || chr(10) || '- turn (integer) [required]' || chr(10) || '- who (string)' AS summary, '  - ' || function_name || chr(10) || '      ' || about AS head FROM def")
def schema_summaries(spark, d):
    """Summaries of schemas with their properties in the order of names, and the first two lines of a tool's section."""
    ship(spark)
    c = _catalog(spark, d).withColumn("definition", F.to_json(F.try_parse_json("definition")))
    head = F.array_join(F.slice(F.split(R.tool_section(F.concat(F.lit("["), "definition", F.lit("]"))), "\n"), 1, 2), "\n")
    return c.select("function_name", R.summary()("definition").alias("summary"), head.alias("head"))


@query(f"WITH {SAID}, {ABOUT}, u AS (SELECT CAST(conv_id AS VARCHAR) AS uuid, arg_max(text, turn) FILTER (WHERE role = 'user') AS said FROM conversations GROUP BY 1) SELECT uuid, message_index, 'Tool:' || chr(10) || func || chr(10) || chr(10) || 'Description:' || chr(10) || about || chr(10) || chr(10) || 'Conversation:' || chr(10) || CASE WHEN length(coalesce(said, '')) <= 40 THEN coalesce(said, '') ELSE substr(said, 1, 37) || '...' END AS middle FROM asked JOIN def ON function_name = func LEFT JOIN u USING (uuid)")
def prompt_texts(spark, d):
    """Prompts for the calls whose function the catalog knows; what stands between the opening line and the schema."""
    t = L.trajectories(spark, d)
    calls, known = _calls(spark, d), _catalog(spark, d)
    tasks = T.prompt_tasks(calls, T.arguments(calls), known).join(t.select("uuid", prompt.last_user_message(F.col("messages")).alias("said")), "uuid")
    text = prompt.prompt(F.col("func"), F.get_json_object("definition", "$.function.description"), F.coalesce("said", F.lit("")), F.col("definition"), F.col("arguments"), prompt.Limits(context=40))
    return tasks.select("uuid", "message_index", F.regexp_extract(text, r"(?s)(Tool:\n.*)\n\nParameters:", 1).alias("middle"))


@query("SELECT CASE n WHEN 0 THEN 800 ELSE greatest(CAST(floor(800 * 0.7) AS INT), 200) END AS context, CASE n WHEN 0 THEN 1600 ELSE 1120 END AS schema, n FROM (VALUES (0), (1)) AS v(n)")
def prompt_limits(spark, d):
    one = prompt.Limits()
    return spark.createDataFrame([(x.context, x.schema, n) for n, x in enumerate((one, one.shrink()))], "context int, schema int, n int")


CALL_TEXT = "'  assistant (function_call: ' || func || ') @msg=' || CAST(message_index AS VARCHAR) || ':' || chr(10) || '    {' || chr(10) || '      \"half\": ' || CAST(message_index // 2 AS VARCHAR) || ',' || chr(10) || '      \"turn\": ' || CAST(message_index AS VARCHAR) || ',' || chr(10) || '      \"who\": \"' || role || '\"' || chr(10) || '    }'"
ASKED_TEXT = "'    [MCQ:params|msg=' || CAST(message_index AS VARCHAR) || ']' || chr(10) || '    Question:' || chr(10) || '      Which of ' || func || '?' || chr(10) || '    Options:' || chr(10) || '      A. x' || chr(10) || '      B. y' || chr(10)"


@query(rf"WITH {MARKED}, p AS (SELECT uuid, message_index, CASE WHEN is_call THEN {ASKED_TEXT} || {CALL_TEXT} ELSE CASE WHEN marker THEN '  [[原文回答]]' || chr(10) ELSE '' END || '  ' || role || ':' || chr(10) || regexp_replace(trim(content, ' ' || chr(10) || chr(9) || chr(13)), '(?m)^(.*\S)', '    \1', 'g') END AS part FROM marked) SELECT CAST(uuid AS VARCHAR) AS uuid, rtrim('=== Record | uuid=' || CAST(uuid AS VARCHAR) || ' ===' || chr(10) || 'Messages:' || chr(10) || string_agg(part, chr(10) ORDER BY message_index), ' ' || chr(10) || chr(9) || chr(13)) || chr(10) AS text FROM p GROUP BY uuid")
def assembled_records(spark, d):
    """Whole records with their questions as text; tools and metadata are left out here to keep the SQL short."""
    t = L.trajectories(spark, d).drop("available_tools", "metadata", "target_tools")
    calls = _calls(spark, d)
    q = F.to_json(F.struct(F.lit("params").alias("mode"), F.concat(F.lit("Which of "), "func", F.lit("?")).alias("question"), F.array(F.lit("x"), F.lit("y")).alias("options"), F.lit("x").alias("answer"), F.col("uuid").alias("record_uuid"), "message_index"))
    asked = batch.valid_questions(calls.select(q.alias("line"), F.monotonically_increasing_id().alias("order_key")))
    return batch.assembled(t, asked)


@query("WITH f AS (SELECT p_partkey % 3 AS k, p_partkey AS n FROM part) SELECT 'd' || CAST(k AS VARCHAR) AS dir, 'f' || CAST(n AS VARCHAR) AS prefix, array_to_string(list_sort(list_concat(CASE WHEN n % 2 = 0 THEN ['available'] ELSE [] END, CASE WHEN n % 5 = 0 THEN ['params'] ELSE [] END)), ',') AS missing FROM f")
def assembly_jobs(spark, d):
    """Which question files each conversation file lacks; files of other kinds beside them count for nothing."""
    p = spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit("d"), (F.col("p_partkey") % 3).cast("string")).alias("dir"), F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("f"), F.col("p_partkey").alias("n"))
    at = lambda root, end: F.concat(F.lit(f"file:/{root}/"), "dir", F.lit("/"), "f", F.lit(end)).alias("path")
    said = p.select(at("in", ".jsonl")).union(p.select(at("in", "_mcq_assembled.jsonl"))).union(p.select(at("in", "_api_x.jsonl")))
    asked = p.where("n % 2 <> 0").select(at("q", "_api_available.jsonl")).union(p.where("n % 5 <> 0").select(at("q", "_api_params.jsonl"))).union(p.select(at("q", "_api_param_values.jsonl")))
    return batch.jobs(batch.placed(said, "file:///in"), batch.placed(asked, "file:///q")).select("dir", "prefix", F.array_join("missing", ",").alias("missing"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 5 <> 0")
def jsonl_round_trip(spark, d):
    """Rows written as JSON lines, with broken and blank lines among them, and read leniently."""
    path = scratch(spark, "lines")
    c = spark.read.parquet(f"{d}/customer.parquet")
    line = F.to_json(F.struct("c_custkey", "c_name"))
    c.select(F.when(F.col("c_custkey") % 10 == 0, F.substring(line, 1, 9)).when(F.col("c_custkey") % 5 == 0, "  ").otherwise(line).alias("value")).write.mode("overwrite").text(path)
    return files.read_jsonl(spark, path).select(F.get_json_object("line", "$.c_custkey").cast("long").alias("c_custkey"), F.get_json_object("line", "$.c_name").alias("c_name"))


@query("SELECT CAST(n_nationkey AS INT) AS position, n_name FROM nation")
def json_list_round_trip(spark, d):
    """One JSON list in a file, item by item: one row for each of the 25 nations."""
    path = scratch(spark, "list")
    n = spark.read.parquet(f"{d}/nation.parquet")
    n.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.struct(x["n_name"].alias("n_name")))).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return files.read_json_array(spark, path).select(F.col("position").cast("int").alias("position"), F.try_variant_get("value", "$.n_name", "string").alias("n_name"))


@query(f"WITH x AS (SELECT DISTINCT event_type AS function_name, sha1('|' || event_type || '|0') AS h FROM events) SELECT function_name, {ALIAS} AS alias FROM x")
def alias_file_round_trip(spark, d):
    path = scratch(spark, "aliases")
    files.write_alias_map(catalog.build_aliases(L.calls(spark, d).select(F.col("func").alias("function_name"))), path)
    return files.read_alias_map(spark, path)


@query(f"WITH {ABOUT} SELECT function_name, about FROM def")
def catalog_file_round_trip(spark, d):
    path = scratch(spark, "catalog")
    ship(spark)
    files.write_catalog(_catalog(spark, d), path)
    return files.read_catalog(spark, path).select("function_name", F.get_json_object("definition", "$.function.description").alias("about"))


@query("SELECT event_type AS function_name, count(*) AS count FROM events GROUP BY 1")
def counts_file_round_trip(spark, d):
    path = scratch(spark, "counts")
    files.write_counts(catalog.usage(L.calls(spark, d).select(F.col("func").alias("function_name"), F.col("event_id").alias("ord")), "ord"), path)
    return spark.read.option("header", "true").schema("function_name string, count long").csv(path)


@query(f"WITH {ARGS}, a AS (SELECT param, value, min(CAST(uuid AS BIGINT) * 1000 + message_index) AS f, count(*) AS occurrences FROM arg GROUP BY 1, 2), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY param ORDER BY f, value) AS INT) AS value_rank FROM a) SELECT param, value, value_rank, occurrences FROM r WHERE value_rank <= 5")
def pool_file_round_trip(spark, d):
    path, args = scratch(spark, "pool"), _pool_args(spark, d)
    files.write_pool(pool.pool(args, 5), pool.entries(args), pool.summary(0, 1, 0, 0, d, None, 5, ""), path)
    return files.read_pool(spark, path).where("level = 'param'").select("param", "value", "value_rank", "occurrences")


@query("SELECT CAST(r_regionkey AS INT) AS shard, r_name AS name FROM region")
def convert_folder(spark, d):
    """Parquet shards of a folder to JSON lines, the first row of each."""
    path = scratch(spark, "shards")
    r = spark.read.parquet(f"{d}/region.parquet").select(F.col("r_regionkey").cast("int").alias("shard"), F.col("r_name").alias("name"), F.lit(0).alias("k"))
    r.unionByName(r.withColumn("k", F.lit(1))).repartition(1).sortWithinPartitions("shard", "k").write.partitionBy("k").mode("overwrite").parquet(f"{path}/in")
    files.convert(spark, f"{path}/in/k=0", f"{path}/out", ["shard", "name"], limit=5)
    return files.read_jsonl(spark, f"{path}/out").select(F.get_json_object("line", "$.shard").cast("int").alias("shard"), F.get_json_object("line", "$.name").alias("name"))

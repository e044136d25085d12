"""Queries over the given tables, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toolloom.functions import text as X
from toolloom.operators import assemble, catalog, mcq, pool, questions, sampling
from toolloom.plans import lenses as L

SEED = 42
#: Names up to which a record's decoys are listed from a literal; mcq.nearest and questions.distractors serve larger catalogs.
DECOYS = 1000
_queries: dict = {}
_sql: dict[str, str] = {}

CALLS = """calls AS (SELECT user_id AS uuid, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS message_index, event_type AS func,
 CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value AS amount, event_id, ts FROM events)"""
CLUSTER = """CASE WHEN k < 0 THEN 'number:negative' WHEN k = 0 THEN 'number:zero' ELSE 'number:positive' END || ':' ||
 CASE WHEN length(CAST(abs(k) AS VARCHAR)) <= 1 THEN 'single_digit' WHEN length(CAST(abs(k) AS VARCHAR)) <= 2 THEN 'two_digits' WHEN length(CAST(abs(k) AS VARCHAR)) <= 4 THEN 'four_digits' WHEN length(CAST(abs(k) AS VARCHAR)) <= 8 THEN 'eight_digits' ELSE 'huge' END"""
CATALOG = """cat AS (SELECT replace(lower(p_type), ' ', '-') || '-' || replace(lower(p_brand), ' ', '-') || '-' || replace(lower(p_name), ' ', '-') AS function_name, p_name || ' ' || p_type AS description, p_partkey AS ord FROM part)"""
MESSAGES = """msg AS (SELECT conv_id AS uuid, turn AS message_index, role, text AS content, (role = 'assistant' AND turn % 4 IN (1, 2)) AS is_call,
 CASE WHEN role = 'assistant' AND turn % 4 IN (1, 2) THEN 'tool_' || CAST(conv_id % 7 AS VARCHAR) END AS func FROM conversations)"""
SYL = "substr('bcdfglnrstv', CAST(floor(CAST('0x' || substr(h, {a}, 2) AS INT) % 55 / 5) AS INT) + 1, 1) || substr('aeiou', CAST('0x' || substr(h, {a}, 2) AS INT) % 55 % 5 + 1, 1)"
ALIAS = f"'func_' || {SYL.format(a=1)} || {SYL.format(a=3)} || {SYL.format(a=5)} || right(h, 3)"
TOKENS = "list_distinct(regexp_extract_all(lower({}), '[a-z0-9]+'))"


def query(sql: str | None = None):
    def add(f):
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    from toolloom.plans import trajectories  # noqa: F401  it adds its own

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_sql)


def _mentions(spark, d) -> DataFrame:
    return L.calls(spark, d).select(F.col("func").alias("function_name"), F.col("event_id").alias("ord"))


@query("SELECT function_name, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, min(ord), function_name) AS rank FROM (SELECT event_type AS function_name, event_id AS ord FROM events) GROUP BY function_name")
def tool_usage_stats(spark, d):
    return catalog.usage(_mentions(spark, d), "ord")


@query("SELECT * FROM (SELECT function_name, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, min(ord), function_name) AS rank FROM (SELECT event_type AS function_name, event_id AS ord FROM events) GROUP BY function_name) WHERE rank <= 3")
def tool_usage_topn(spark, d):
    return catalog.usage(_mentions(spark, d), "ord").where("rank <= 3")


@query(f"WITH {CATALOG} SELECT function_name, arg_min(description, ord) AS definition FROM cat GROUP BY function_name")
def tool_catalog_first_seen(spark, d):
    return catalog.first_seen(L.catalog(spark, d).withColumnRenamed("description", "definition"), "ord")


@query("SELECT count(DISTINCT user_id) AS records, count(*) AS calls, count(json_extract_string(props, '$.k')) AS arguments, count(DISTINCT event_type) AS names FROM events")
def run_totals(spark, d):
    return L.calls(spark, d).agg(F.count_distinct("uuid").alias("records"), F.count(F.lit(1)).alias("calls"), F.count("k").alias("arguments"), F.count_distinct("func").alias("names"))


@query(f"WITH {CATALOG}, x AS (SELECT DISTINCT function_name, sha1('|' || function_name || '|0') AS h FROM cat) SELECT function_name, {ALIAS} AS alias FROM x")
def alias_map(spark, d):
    return catalog.build_aliases(L.catalog(spark, d).select("function_name"))


@query(f"WITH {CATALOG}, x AS (SELECT DISTINCT function_name, sha1('|' || function_name || '|0') AS h FROM cat) SELECT function_name, CASE WHEN function_name IN (SELECT function_name FROM cat WHERE ord <= 10) THEN 'kept_' || md5(function_name) ELSE {ALIAS} END AS alias FROM x")
def alias_extend_existing(spark, d):
    c = L.catalog(spark, d)
    old = c.where("ord <= 10").select("function_name").distinct().withColumn("alias", F.concat(F.lit("kept_"), F.md5("function_name")))
    return catalog.build_aliases(c.select("function_name"), old)


@query(f"WITH x AS (SELECT DISTINCT event_type AS function_name, sha1('|' || event_type || '|0') AS h FROM events), a AS (SELECT function_name, {ALIAS} AS alias FROM x) SELECT alias, alias || ' (' || function_name || ')' AS label FROM a")
def alias_inverse_label(spark, d):
    m = catalog.build_aliases(_mentions(spark, d).select("function_name"))
    return catalog.label(m.select("alias"), m, "alias").select("alias", "label")


@query(f"WITH x AS (SELECT DISTINCT event_type AS function_name, sha1('|' || event_type || '|0') AS h FROM events), a AS (SELECT function_name, {ALIAS} AS alias FROM x WHERE function_name <> 'click'), {CALLS} SELECT event_id, coalesce(alias, func) AS func FROM calls LEFT JOIN a ON func = function_name")
def obfuscate_calls(spark, d):
    c = L.calls(spark, d)
    m = catalog.build_aliases(c.where("func <> 'click'").select(F.col("func").alias("function_name")))
    return catalog.apply_alias(c.select("event_id", "func"), m, "func")


@query("WITH n AS (SELECT unnest(['the', 'une', 'nicht', 'para']) AS function_name), w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Za-z0-9_-]+'))) AS function_name FROM documents) SELECT doc_id, function_name FROM w WHERE function_name IN (SELECT function_name FROM n)")
def obfuscate_leak_audit(spark, d):
    names = spark.createDataFrame([("the",), ("une",), ("nicht",), ("para",)], "function_name string")
    return catalog.leaks(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), names, "text").select("doc_id", "function_name")


@query(f"WITH {CALLS} SELECT uuid, message_index, func, k FROM calls")
def calls_extract(spark, d):
    return L.calls(spark, d).select("uuid", "message_index", "func", "k")


@query(f"WITH {CALLS}, a AS (SELECT uuid, message_index, func, k, {CLUSTER} AS cluster FROM calls) SELECT uuid, message_index, func, 'k' AS param, 'integer' AS p_type, cluster, CAST(k AS VARCHAR) AS value FROM a UNION ALL SELECT uuid, message_index, func, 'half', 'integer', cluster, CAST(k // 2 AS VARCHAR) FROM a")
def call_args_long(spark, d):
    return L.two_args(spark, d).select("uuid", "message_index", "func", "param", "p_type", "cluster", "value")


@query("WITH v AS (SELECT 'c_acctbal' AS param, c_acctbal AS v FROM customer UNION ALL SELECT 'l_discount', l_discount FROM lineitem UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem) SELECT param, CASE WHEN v = 0 THEN 'number:zero' WHEN abs(v) < 1 THEN 'number:fraction' WHEN abs(v) < 10 THEN 'number:small' WHEN abs(v) < 100 THEN 'number:medium' WHEN abs(v) < 1000 THEN 'number:large' ELSE 'number:huge' END AS cluster, count(*) AS n FROM v GROUP BY 1, 2")
def arg_clusters(spark, d):
    r = lambda t, c: spark.read.parquet(f"{d}/{t}.parquet").select(F.lit(c).alias("param"), F.col(c).alias("v"))
    v = r("customer", "c_acctbal").unionByName(r("lineitem", "l_discount")).unionByName(r("lineitem", "l_quantity"))
    return v.groupBy("param", X.cluster_float(F.col("v")).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""WITH v AS (SELECT 'url' AS param, url AS v FROM pages UNION ALL SELECT 'path', substr(url, 8) FROM pages UNION ALL SELECT 'p_name', p_name FROM part UNION ALL SELECT 'key', CAST(p_partkey AS VARCHAR) FROM part UNION ALL SELECT 'source', source FROM documents UNION ALL SELECT 'priority', o_orderpriority FROM orders)
SELECT param, CASE WHEN starts_with(lower(v), 'http://') OR starts_with(lower(v), 'https://') THEN 'string:url' WHEN starts_with(lower(v), 'file://') OR starts_with(lower(v), 's3://') OR contains(v, '/') OR contains(v, '\') THEN 'string:path_or_uri'
 WHEN len(regexp_extract_all(v, '\S+')) >= 6 THEN 'string:long_text' WHEN regexp_full_match(v, '\p{Nd}+') THEN 'string:numeric' WHEN regexp_matches(v, '\p{Nd}') AND regexp_matches(v, '\p{L}') THEN 'string:alnum' ELSE 'string:general' END AS cluster, count(*) AS n FROM v GROUP BY 1, 2""")
def string_classes(spark, d):
    r = lambda t, n, c: spark.read.parquet(f"{d}/{t}.parquet").select(F.lit(n).alias("param"), c.alias("v"))
    v = r("pages", "url", F.col("url"))
    for more in (r("pages", "path", F.expr("substr(url, 8)")), r("part", "p_name", F.col("p_name")), r("part", "key", F.col("p_partkey").cast("string")), r("documents", "source", F.col("source")), r("orders", "priority", F.col("o_orderpriority"))):
        v = v.unionByName(more)
    return v.groupBy("param", X.classify_string(F.col("v")).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CALLS} SELECT 'function' AS level, func, 'k' AS param, CAST(NULL AS VARCHAR) AS p_type, count(*) AS observed FROM calls GROUP BY func UNION ALL SELECT 'param', NULL, 'k', NULL, count(*) FROM calls UNION ALL SELECT 'type', NULL, NULL, 'integer', count(*) FROM calls")
def pool_observed(spark, d):
    return pool.observed(L.call_args(spark, d))


@query(f"WITH {CALLS}, a AS (SELECT func, {CLUSTER} AS cluster, k, min(event_id) AS f, count(*) AS occurrences FROM calls GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY func, cluster ORDER BY f, CAST(k AS VARCHAR)) AS value_rank FROM a) SELECT func, 'k' AS param, cluster, CAST(k AS VARCHAR) AS value, occurrences, value_rank FROM r WHERE value_rank <= 20")
def pool_values_capped(spark, d):
    return pool.values(L.call_args(spark, d), ["func", "param"], 20)


@query(f"WITH {CALLS}, a AS (SELECT func, {CLUSTER} AS cluster, event_id % 4 AS source, count(*) AS n, count(DISTINCT k) AS d FROM calls GROUP BY 1, 2, 3) SELECT func, 'k' AS param, cluster, CAST(sum(n) AS BIGINT) AS occurrences, CAST(sum(least(d, 20)) AS BIGINT) AS merged_count FROM a GROUP BY func, cluster")
def pool_merged_count(spark, d):
    return pool.cluster_counts(L.call_args(spark, d), ["func", "param"], 20)


@query(f"WITH {CATALOG}, s AS (SELECT DISTINCT function_name, string_split(function_name, '-') AS p, string_split(function_name, '_') AS u FROM cat) SELECT CASE WHEN len(p) >= 3 THEN p[1] || '-' || p[2] || '-' || p[3] WHEN len(p) = 2 THEN function_name WHEN len(u) >= 2 THEN u[1] || '_' || u[2] ELSE function_name END AS family, count(*) AS n FROM s GROUP BY 1")
def families(spark, d):
    return L.catalog(spark, d).select("function_name").distinct().groupBy(X.family(F.col("function_name")).alias("family")).agg(F.count(F.lit(1)).alias("n"))


PROFILE = f"{CATALOG}, prof AS (SELECT function_name, unnest(list_distinct(list_concat({TOKENS.format('description')}, {TOKENS.format(chr(39).join(['replace(function_name, ', '-', ', ', ' ', ')']))}))) AS token FROM (SELECT function_name, arg_min(description, ord) AS description FROM cat GROUP BY function_name))"


def _profiles(spark, d) -> DataFrame:
    c = catalog.first_seen(L.catalog(spark, d).withColumnRenamed("description", "definition"), "ord")
    return c.select("function_name", X.profile(F.col("function_name"), F.col("definition")).alias("tokens"))


@query(f"WITH {PROFILE} SELECT function_name, token FROM prof")
def profiles_tokens(spark, d):
    return _profiles(spark, d).select("function_name", F.explode("tokens").alias("token"))


@query(f"WITH {PROFILE}, t AS (SELECT function_name, list(token) AS tokens FROM prof GROUP BY 1), s AS (SELECT a.function_name, b.function_name AS other, len(list_intersect(a.tokens, b.tokens)) AS score FROM t a JOIN t b ON a.function_name <> b.function_name), r AS (SELECT *, row_number() OVER (PARTITION BY function_name ORDER BY score DESC, other DESC) AS rank FROM s) SELECT * FROM r WHERE rank <= 5")
def semantic_neighbours_topk(spark, d):
    return mcq.nearest(_profiles(spark, d), 5)


@query("WITH c AS (SELECT DISTINCT event_type AS f FROM events), h AS (SELECT DISTINCT user_id AS uuid, event_type AS f FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) < 10), u AS (SELECT DISTINCT user_id AS uuid FROM events) SELECT uuid, f AS function_name FROM u, c WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.uuid = u.uuid AND h.f = c.f)")
def decoy_pool_antijoin(spark, d):
    c = L.calls(spark, d).select("uuid", F.col("func").alias("function_name"), "k")
    names = sorted(r["function_name"] for r in c.select("function_name").distinct().limit(DECOYS + 1).collect())
    if len(names) > DECOYS:
        raise ValueError("more names than a record's decoys can be listed from")
    have = c.where("k < 10").groupBy("uuid").agg(F.collect_set("function_name").alias("have"))
    lacks = c.select("uuid").distinct().join(have, "uuid", "left").select("uuid", F.array_except(F.array(*map(F.lit, names)), F.coalesce("have", F.array().cast("array<string>"))).alias("lacks"))
    return lacks.select("uuid", F.explode("lacks").alias("function_name"))


@query("SELECT * FROM (VALUES ('get_lineitem', 'l_linenumber, l_orderkey', true), ('get_lineitem', 'l_linenumber', false), ('get_lineitem', 'l_orderkey', false), ('get_lineitem', 'l_linenumber, l_orderkey, l_partkey', false), ('get_lineitem', 'l_linenumber, l_orderkey, l_quantity', false), ('get_order', 'o_orderkey', true), ('get_order', 'o_custkey, o_orderkey', false), ('get_order', 'o_orderdate, o_orderkey', false), ('get_nation', 'n_name, n_nationkey', true), ('get_nation', 'n_name', false), ('get_nation', 'n_nationkey', false), ('get_nation', 'n_name, n_nationkey, n_regionkey', false)) AS t(function_name, option, is_answer)")
def params_mcq_options(spark, d):
    return mcq.param_options(L.schemas(spark))


FAMILY = "CASE WHEN len(string_split(f, '-')) >= 3 THEN array_to_string(string_split(f, '-')[1:3], '-') WHEN len(string_split(f, '-')) = 2 THEN f WHEN len(string_split(f, '_')) >= 2 THEN array_to_string(string_split(f, '_')[1:2], '_') ELSE f END"
DRAWN = "md5('42|' || CAST(uuid AS VARCHAR) || '|' || CAST(message_index AS VARCHAR) || '|' || option)"
SHUFFLED = """SELECT uuid, message_index, option, is_answer, CAST(position AS INT) AS position, chr(CAST(65 + position AS INT)) AS letter FROM (SELECT *, row_number() OVER (PARTITION BY uuid, message_index ORDER BY md5('42s|' || CAST(uuid AS VARCHAR) || '|' || CAST(message_index AS VARCHAR) || '|' || option), option) - 1 AS position FROM opt)"""
AVAILABLE = f"""WITH {CALLS}, fam AS (SELECT f, {FAMILY} AS family, list_distinct(regexp_extract_all(lower(replace(f, '_', ' ')), '[a-z0-9]+')) AS tokens FROM (SELECT DISTINCT func AS f FROM calls)),
have AS (SELECT DISTINCT uuid, func AS option FROM calls WHERE k % 2 = 0), ok AS (SELECT uuid, message_index, func FROM calls WHERE EXISTS (SELECT 1 FROM have WHERE have.uuid = calls.uuid AND option = func)),
base AS (SELECT * FROM (SELECT uuid, message_index, option, row_number() OVER (PARTITION BY uuid, message_index ORDER BY {DRAWN}, option) AS r FROM ok JOIN have USING (uuid) WHERE option <> func) WHERE r <= 3),
need AS (SELECT ok.*, 3 - coalesce(n, 0) AS needed FROM ok LEFT JOIN (SELECT uuid, message_index, count(*) AS n FROM base GROUP BY 1, 2) USING (uuid, message_index)),
cand AS (SELECT uuid, message_index, needed, b.f AS option, a.family = b.family AS kin, len(list_intersect(a.tokens, b.tokens)) AS score FROM need JOIN fam a ON a.f = func JOIN fam b ON b.f <> func WHERE needed > 0 AND NOT EXISTS (SELECT 1 FROM have WHERE have.uuid = need.uuid AND have.option = b.f)),
kin AS (SELECT *, kin AND row_number() OVER (PARTITION BY uuid, message_index, kin ORDER BY {DRAWN}, option) <= greatest(1, CAST(round_even(needed * 0.3, 0) AS INT)) AS near FROM cand),
tier AS (SELECT *, CASE WHEN near THEN 0 ELSE 1 END AS t, count(*) FILTER (WHERE near) OVER (PARTITION BY uuid, message_index) AS k FROM kin),
place AS (SELECT *, CASE WHEN t = 0 THEN row_number() OVER (PARTITION BY uuid, message_index, t ORDER BY {DRAWN}, option) ELSE row_number() OVER (PARTITION BY uuid, message_index, t ORDER BY score DESC, option DESC) END AS p FROM tier),
choice AS (SELECT *, CASE WHEN t = 0 THEN 0 WHEN p <= greatest(0, needed - k - 1) THEN 1 ELSE 2 END AS c FROM place),
decoy AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uuid, message_index ORDER BY c, CASE WHEN c < 2 THEN p END, {DRAWN}, option) AS l FROM choice) WHERE l <= needed),
wrong AS (SELECT uuid, message_index, option FROM base UNION ALL SELECT uuid, message_index, option FROM decoy),
opt AS (SELECT *, false AS is_answer FROM wrong UNION ALL SELECT uuid, message_index, func, true FROM ok WHERE EXISTS (SELECT 1 FROM wrong WHERE wrong.uuid = ok.uuid AND wrong.message_index = ok.message_index)) """


@query(AVAILABLE + SHUFFLED)
def available_mcq(spark, d):
    c = L.calls(spark, d)
    names = c.select(F.col("func").alias("function_name")).distinct()
    prof = names.select("function_name", X.tokens(F.replace("function_name", F.lit("_"), F.lit(" "))).alias("tokens"))
    tools = c.where("k % 2 = 0").select("uuid", F.col("func").alias("function_name"))
    return questions.available(c.select("uuid", "message_index", "func"), tools, prof, 3, SEED)


ARGS2 = f"{CALLS}, args AS (SELECT uuid, message_index, func, 'k' AS param, CAST(k AS VARCHAR) AS value FROM calls UNION ALL SELECT uuid, message_index, func, 'half', CAST(k // 2 AS VARCHAR) FROM calls)"


@query(f"WITH {ARGS2} SELECT uuid, message_index, CAST(NULL AS VARCHAR) AS dropped, string_agg(param || '=' || value, '; ' ORDER BY param) AS option FROM args GROUP BY 1, 2 UNION ALL SELECT a.uuid, a.message_index, b.param, string_agg(a.param || '=' || a.value, '; ' ORDER BY a.param) FROM args a JOIN args b ON a.uuid = b.uuid AND a.message_index = b.message_index AND a.param <> b.param GROUP BY 1, 2, 3")
def drop_argument_variants(spark, d):
    return mcq.drop_variants(L.two_args(spark, d))


def _drawn(spark, d, most=3) -> DataFrame:
    a = L.call_args(spark, d)
    # the pool is capped by its keys, levels and clusters; the three levels are made from one pass
    once = a.groupBy("func", "param", "p_type", "cluster", "value").agg(F.min("ord").alias("ord"))
    own = lambda keys, level: pool.values(once, keys, 8).select(F.lit(level).alias("level_rank"), *(F.col(c) if c in keys else F.lit(None).cast("string").alias(c) for c in ("func", "param", "p_type")), "value")
    p = own(["func", "param"], 0).unionByName(own(["param"], 1)).unionByName(own(["p_type"], 2))
    return pool.drawn(a.select("uuid", "message_index", "func", "param", "p_type", "value"), p, SEED, most)


PICKS = f"{CALLS}, a AS (SELECT func, {CLUSTER} AS cluster, k, min(event_id) AS f FROM calls GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY func, cluster ORDER BY f, CAST(k AS VARCHAR)) AS value_rank FROM a), p AS (SELECT func, CAST(k AS VARCHAR) AS other FROM r WHERE value_rank <= 8), s AS (SELECT c.uuid, c.message_index, 'k' AS param, CAST(c.k AS VARCHAR) AS value, p.other FROM calls c JOIN p ON p.func = c.func AND p.other <> CAST(c.k AS VARCHAR)), t AS (SELECT *, row_number() OVER (PARTITION BY uuid, message_index, param ORDER BY md5('42|' || CAST(uuid AS VARCHAR) || '|' || CAST(message_index AS VARCHAR) || '|' || param || '|' || other), other) AS pick FROM s), picks AS (SELECT * FROM t WHERE pick <= 3)"


@query(f"WITH {PICKS} SELECT uuid, message_index, param, value, other, pick FROM picks")
def pool_substitution_variants(spark, d):
    # a call has k once; outer, as else Spark draws twice to filter the calls
    each = _drawn(spark, d).select("uuid", "message_index", "param", "value", F.posexplode_outer("others").alias("place", "other")).where("other is not null")
    return each.select("uuid", "message_index", "param", "value", "other", (F.col("place") + 1).alias("pick"))


VALUES = f"""WITH {PICKS}, b AS (SELECT uuid, message_index, 'half=' || CAST(k // 2 AS VARCHAR) AS h, 'k=' || CAST(k AS VARCHAR) AS x FROM calls),
w AS (SELECT uuid, message_index, h AS option FROM b UNION SELECT uuid, message_index, x FROM b UNION SELECT uuid, message_index, h || '; k=' || other FROM b JOIN picks USING (uuid, message_index)),
ranked AS (SELECT w.*, row_number() OVER (PARTITION BY uuid, message_index ORDER BY {DRAWN}, option) AS r FROM w JOIN b USING (uuid, message_index) WHERE option <> h || '; ' || x),
opt AS (SELECT uuid, message_index, option, false AS is_answer FROM ranked WHERE r <= 4 UNION ALL SELECT uuid, message_index, h || '; ' || x, true FROM b) """


@query(VALUES + SHUFFLED)
def param_values_mcq(spark, d):
    a = L.halved(_drawn(spark, d)).withColumn("others", F.when(F.col("param") == "k", F.col("others")))
    return mcq.value_options(a, 4, SEED)


@query("SELECT CAST(n_nationkey + 3 AS INT) AS position, CASE WHEN n_nationkey + 3 < 26 THEN chr(CAST(n_nationkey + 3 + 65 AS INT)) ELSE 'Option' || CAST(n_nationkey + 4 AS VARCHAR) END AS letter FROM nation")
def mcq_letters(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet").select((F.col("n_nationkey") + 3).cast("int").alias("position"))
    return n.select("position", X.letter(F.col("position")).alias("letter"))


@query("SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def convert_limit(spark, d):
    return sampling.first_rows(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 100).select("o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('23|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 50")
def convert_sample(spark, d):
    return sampling.sample(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey"), ["o_orderkey"], 50, 23)


MARKED = f"{MESSAGES}, w AS (SELECT *, (NOT is_call AND role = 'assistant' AND coalesce(content, '') <> '') AS is_text FROM msg), x AS (SELECT *, max(CASE WHEN is_call THEN message_index END) OVER b AS lc, max(CASE WHEN is_text THEN message_index END) OVER b AS lt FROM w WINDOW b AS (PARTITION BY uuid ORDER BY message_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), marked AS (SELECT *, is_text AND lc IS NOT NULL AND lc > coalesce(lt, -1) AS marker FROM x)"


@query(f"WITH {MARKED} SELECT uuid, message_index, role, is_call, marker FROM marked")
def messages_with_markers(spark, d):
    return assemble.with_markers(L.messages(spark, d)).select("uuid", "message_index", "role", "is_call", "marker")


def _blocks(spark, d) -> DataFrame:
    m = L.messages(spark, d).where("is_call")
    modes = spark.createDataFrame([(m_, i) for i, m_ in enumerate(assemble.MODES)], "mode string, mode_rank int")
    block = assemble.question_block(F.col("mode"), F.col("message_index"), F.concat(F.lit("Which "), "func", F.lit("?")), F.lit("A. x\nB. y"), F.lit("x"), False)
    return m.join(F.broadcast(modes)).select("uuid", "message_index", "mode_rank", F.lit(0).alias("ord"), block.alias("block"))


@query(f"WITH {MESSAGES} SELECT uuid, message_index, mode_rank, '[MCQ:' || mode || '|msg=' || CAST(message_index AS VARCHAR) || ']' || chr(10) || 'Question:' || chr(10) || '  Which ' || func || '?' || chr(10) || 'Options:' || chr(10) || '  A. x' || chr(10) || '  B. y' AS block FROM msg, (VALUES ('available', 0), ('params', 1), ('param_values', 2)) AS m(mode, mode_rank) WHERE is_call")
def mcq_injection_order(spark, d):
    return _blocks(spark, d).select("uuid", "message_index", "mode_rank", "block")


INDENTED = r"regexp_replace(trim(content, ' '), '(?m)^(.*\S)', '    \1', 'g')"
ASSEMBLED = rf"""WITH {MARKED}, blk AS (SELECT uuid, message_index, mode_rank, '[MCQ:' || mode || '|msg=' || CAST(message_index AS VARCHAR) || ']' || chr(10) || 'Question:' || chr(10) || '  Which ' || func || '?' || chr(10) || 'Options:' || chr(10) || '  A. x' || chr(10) || '  B. y' AS block FROM msg, (VALUES ('available', 0), ('params', 1), ('param_values', 2)) AS m(mode, mode_rank) WHERE is_call), parts AS (SELECT uuid, message_index, mode_rank, regexp_replace(block, '(?m)^(.*\S)', '    \1', 'g') AS part FROM blk
 UNION ALL SELECT uuid, message_index, 9, CASE WHEN is_call THEN '  assistant (function_call: ' || func || ') @msg=' || CAST(message_index AS VARCHAR) || ':' ELSE CASE WHEN marker THEN '  [[原文回答]]' || chr(10) ELSE '' END || '  ' || role || ':' END || chr(10) || {INDENTED} FROM marked)
SELECT uuid, '=== Record | uuid=' || CAST(uuid AS VARCHAR) || ' ===' || chr(10) || 'Messages:' || chr(10) || string_agg(part, chr(10) ORDER BY message_index, mode_rank) || chr(10) AS text FROM parts GROUP BY uuid"""


@query(ASSEMBLED)
def assembled_text(spark, d):
    return assemble.assembled(L.messages(spark, d), _blocks(spark, d))


@query("SELECT doc_id, CASE WHEN length(text) <= 80 THEN text ELSE substr(text, 1, 77) || '...' END AS short FROM documents")
def prompt_truncate(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", X.truncate(F.col("text"), 80).alias("short"))


@query(r"SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(trim('  k = ' || p_name || '  ;v=  ' || p_brand || ' '), '\s+', ' ', 'g'), '\s*=\s*', '=', 'g'), '\s*;\s*', '; ', 'g') AS option FROM part")
def option_normalize(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet")
    return p.select("p_partkey", X.normalize_option(F.concat(F.lit("  k = "), "p_name", F.lit("  ;v=  "), "p_brand", F.lit(" "))).alias("option"))


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 THEN props END AS block FROM events")
def json_block_extract(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\nDone."))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("It is "), "props", F.lit(" so."))).otherwise("none")
    return e.select("event_id", X.json_block(text).alias("block"))


def _refused(spark, d) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", (F.col("event_id") % 5).alias("m"))
    q = F.when(F.col("m") == 0, "").otherwise("Which?")
    options = F.when(F.col("m") == 1, F.array().cast("array<string>")).when(F.col("m") == 2, F.array(F.lit("a=2"), F.lit("a=3"))).otherwise(F.array(F.lit("a = 1"), F.lit("a=2")))
    answer = F.when(F.col("m") == 3, "a=2").otherwise("a =1")
    return e.select("event_id", X.payload_reason(q, options, answer, F.lit("a=1")).alias("reason"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'invalid_question' WHEN 1 THEN 'invalid_options' WHEN 2 THEN 'canonical_missing' WHEN 3 THEN 'answer_mismatch' END AS reason FROM events")
def payload_validate(spark, d):
    return _refused(spark, d)


@query("WITH r AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'invalid_question' WHEN 1 THEN 'invalid_options' WHEN 2 THEN 'canonical_missing' WHEN 3 THEN 'answer_mismatch' END AS reason FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY event_id) AS n, count(*) OVER (PARTITION BY reason) AS total FROM r WHERE reason IS NOT NULL) SELECT reason, max(total) AS failures, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS samples FROM k WHERE n <= 5 GROUP BY reason")
def failure_summary(spark, d):
    r = _refused(spark, d).where("reason is not null")
    total = r.groupBy("reason").agg(F.count(F.lit(1)).alias("failures"))
    five = r.withColumn("n", F.row_number().over(Window.partitionBy("reason").orderBy("event_id"))).where("n <= 5").groupBy("reason").agg(F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")), ",").alias("samples"))
    return total.join(five, "reason")

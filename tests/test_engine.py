import hashlib
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from toolloom.functions import text as X
from toolloom.operators import assemble, catalog, mcq, pool
from toolloom.plans import queries as Q
from toolloom.sources import files

SF = "/root/testdata/sf0.001"


def plain(df):
    def one(v):
        if v is None or v != v:
            return "~"
        if isinstance(v, float):
            return repr(int(v)) if v == int(v) else f"{v:.9g}"
        return str(v)

    return sorted(tuple(map(one, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    return c


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert plain(Q.queries()[name](spark, SF).toPandas()) == plain(duck.sql(Q.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", ["available_mcq", "param_values_mcq"])
def test_questions_hold_one_answer_and_distinct_options(spark, name):
    rows = Q.queries()[name](spark, SF).toPandas()
    for _, own in rows.groupby(["uuid", "message_index"]):
        assert own["is_answer"].sum() == 1 and own["option"].is_unique and len(own) >= 2
        assert sorted(own["position"]) == list(range(len(own)))


def test_questions_repeat_under_another_partitioning(spark):
    a = plain(Q.queries()["available_mcq"](spark, SF).toPandas())
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert a == plain(Q.queries()["available_mcq"](spark, SF).toPandas())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_string_classes(spark):
    want = {"https://x": "url", "a/b": "path_or_uri", "one two three four five six": "long_text", "007": "numeric", "a1": "alnum", "abc": "general", "": "general"}
    rows = spark.createDataFrame([(k,) for k in want], "v string").select("v", X.classify_string(F.col("v")).alias("c")).collect()
    assert {r["v"]: r["c"] for r in rows} == {k: "string:" + v for k, v in want.items()}


def test_clusters(spark):
    cases = [("integer", "integer", "0", "number:zero:single_digit"), ("integer", "integer", "-7", "number:negative:single_digit"), ("integer", "integer", "12345", "number:positive:eight_digits"), ("integer", "integer", "12345678901234567890123", "number:positive:huge"), ("number", "number", "0.5", "number:fraction"), ("number", "number", "999.5", "number:large"), ("integer", "string", "5", "number:other"), ("string", "integer", "3", "string:non_str"), ("boolean", "boolean", "true", "boolean"), ("integer", "boolean", "true", "number:positive:single_digit"), ("array", "array", "[]", "array:any"), ("unknown", "null", "null", "unknown")]
    rows = spark.createDataFrame([c[:3] for c in cases], "t string, r string, v string").select(X.cluster_label(F.col("t"), F.col("r"), F.col("v"), F.lit(False), F.lit(None).cast("string")).alias("c")).collect()
    assert [r["c"] for r in rows] == [c[3] for c in cases]


def test_families(spark):
    want = {"a-b-c-d": "a-b-c", "a-b": "a-b", "a_b_c": "a_b", "abc": "abc"}
    rows = spark.createDataFrame([(k,) for k in want], "v string").select("v", X.family(F.col("v")).alias("f")).collect()
    assert {r["v"]: r["f"] for r in rows} == want


def test_alias_collisions_go_to_the_next_attempt(spark):
    names = spark.createDataFrame([("a",), ("b",)], "function_name string")
    first = {r["function_name"]: r["alias"] for r in catalog.build_aliases(names).collect()}
    held = spark.createDataFrame([("old", first["a"])], "function_name string, alias string")
    again = {r["function_name"]: r["alias"] for r in catalog.build_aliases(names, held).collect()}
    assert again["old"] == first["a"] and again["b"] == first["b"] and again["a"] not in first.values() and len(again) == 3


def test_lenient_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('\n{bad\n[1,2]\n{"uuid": "u", "messages": "[{\\"role\\": \\"user\\", \\"content\\": \\"hi\\"}, {\\"role\\": \\"assistant\\", \\"function_call\\": {\\"name\\": \\"f\\", \\"arguments\\": \\"{}\\"}}]"}\n')
    rec = files.records(files.read_jsonl(spark, str(tmp_path)))
    assert [(r["uuid"], r["message_index"], r["func"]) for r in catalog.calls(catalog.messages(rec)).collect()] == [("u", 1, "f")]


def test_marker_before_the_first_answer_only(spark):
    rows = [("u", 0, "assistant", "{}", True), ("u", 1, "function", "r", False), ("u", 2, "assistant", "one", False), ("u", 3, "assistant", "two", False)]
    m = assemble.with_markers(spark.createDataFrame(rows, "uuid string, message_index long, role string, content string, is_call boolean"))
    assert [r["marker"] for r in m.orderBy("message_index").collect()] == [False, False, True, False]


def test_options_of_one_required_name_alone_make_no_question(spark):
    c = spark.createDataFrame([("f", ["a"], ["a"])], "function_name string, properties array<string>, required array<string>")
    assert mcq.param_options(c).count() == 0


def test_letters_and_json_and_options(spark):
    r = spark.range(1).select(X.letter(F.lit(26)).alias("l"), X.json_block(F.lit('a {"b": {}} c')).alias("j"), X.normalize_option(F.lit(" a = 1 ;b=2")).alias("o"), X.truncate(F.lit("abcdef"), 5).alias("t")).first()
    assert tuple(r) == ("Option27", '{"b": {}}', "a=1; b=2", "ab...")


def test_stream_counts(spark):
    from toolloom.streaming.usage import usage_by_window

    events = spark.readStream.schema(spark.read.parquet(f"{SF}/events.parquet").schema).option("pathGlobFilter", "events*").parquet(SF)
    q = usage_by_window(events.withColumnRenamed("event_type", "function_name")).writeStream.outputMode("complete").format("memory").queryName("usage").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(count) from usage").first()[0] == spark.read.parquet(f"{SF}/events.parquet").count()
    assert math.isfinite(pool.CAP)


def nodes(plan):
    """A finished plan's nodes, as (name, metrics of rows)."""
    kind = plan.getClass().getSimpleName()
    found = {k: m.get().value() for k in ("numOutputRows", "shuffleRecordsWritten") if (m := plan.metrics().get(k)).isDefined()}
    yield kind, found
    inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else [plan.children().apply(i) for i in range(plan.children().size())]
    for x in inner:
        yield from nodes(x)


def run_nodes(df):
    df.collect()
    return list(nodes(df._jdf.queryExecution().executedPlan()))


def test_values_questions_hold_one_row_a_call_until_drawn(spark):
    """F1 of round 3: each argument met all values of three levels before the draw."""
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    done = run_nodes(Q.queries()["param_values_mcq"](spark, SF))
    assert all(m["numOutputRows"] <= n for kind, m in done if "Join" in kind and "numOutputRows" in m)
    assert not any(kind in ("SortMergeJoinExec", "CartesianProductExec") for kind, _ in done)


@pytest.mark.parametrize("most", [32_000_000, -1])
def test_substitutes_of_each_level_by_brute_force(spark, monkeypatch, most):
    """Levels that are broadcast or not; values of one kind alone, nulls and repeated arguments."""
    monkeypatch.setattr(pool, "BROADCAST_BYTES", most)
    args = [("u", i, f, p, t, v) for i, (f, p, t, v) in enumerate([("f", "a", "integer", "1"), ("f", "a", "integer", "9"), ("g", "a", "integer", "7"), ("h", "b", "integer", "5"), (None, "a", "integer", "1"), ("h", "c", "string", "x"), ("f", "a", "integer", None), ("f", None, "integer", "1")])]
    args += [("u", 1, "f", "a", "integer", "2"), (None, 0, "f", "a", "integer", "3")]
    held = [(0, "f", "a", None, v) for v in "1234"] + [(0, "g", "a", None, "7"), (0, "f", "a", None, None)] + [(1, None, "a", None, v) for v in "17"] + [(1, None, "b", None, "5")] + [(2, None, None, "integer", v) for v in "568"] + [(2, None, None, "integer", "6")]
    own = spark.createDataFrame(held, "level_rank int, func string, param string, p_type string, value string")
    got = pool.substitutes(spark.createDataFrame(args, "uuid string, message_index long, func string, param string, p_type string, value string"), own, 42, 3)
    want, groups = set(), {}
    for u, m, f, p, t, v in args:
        for level, key in enumerate([(f, p, None), (None, p, None), (None, None, t)]):
            others = {x for r, *k, x in held if r == level and tuple(k) == key and None not in (x, v) and x != v} if not any(a is None for a, used in zip((f, p, t), ((1, 1, 0), (0, 1, 0), (0, 0, 1))[level]) if used) else set()
            if others:
                groups.setdefault((u, m, p), {}).setdefault(level, set()).update(others)
                break
    for (u, m, p), by in groups.items():
        draw = lambda x: (hashlib.md5("|".join(str(y) for y in (42, u, m, p, x) if y is not None).encode()).hexdigest(), x)  # noqa: B023, E731
        want |= {(u, m, p, x, min(by), i + 1) for i, x in enumerate(sorted(by[min(by)], key=draw)[:3])}
    assert {(r["uuid"], r["message_index"], r["param"], r["other"], r["level_rank"], r["pick"]) for r in got.collect()} == want and {x[4] for x in want} == {0, 1, 2}


def test_substitutions_exchange_no_more_rows_than_calls(spark):
    """F2 of round 3: what was exchanged were the arguments times the values of the pool."""
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    done = run_nodes(Q.queries()["pool_substitution_variants"](spark, SF))
    assert 0 < max(m.get("shuffleRecordsWritten", 0) for _, m in done) <= n

"""Whole trajectory records: tables, masking, questions, assembly and files, against plain Python."""

import json
import os

import pytest

from pyspark.sql import functions as F
from toolloom.functions import records as R
from toolloom.operators import batch, catalog, mcq, obfuscate, pool, questions
from toolloom.operators import trajectories as T
from toolloom.sources import files


def tool(name, about="", properties=None, required=()):
    return {"function": {"name": name, "description": about, "parameters": {"type": "object", "properties": properties or {}, "required": list(required)}}}


P = {"city": {"type": "string", "description": "where"}, "days": {"type": ["null", "integer"]}, "unit": {"enum": ["c", "f"]}}
TOOLS = [tool("weather-api-day", "Weather of a day", P, ["city", "days"]), tool("weather-api-week", "Weather of a week", P, ["city"]), tool("mail_send", "Send mail", {"to": {"type": "string"}}, ["to"]), tool("search", "Search the web")]
DECLARED = "<|im_system|>tool_declare<|im_middle|>" + json.dumps([TOOLS[0]]) + "<|im_end|>"


def record(uuid, calls, tools=(0, 2), **more):
    said = [{"role": "system", "content": DECLARED}, {"role": "user", "content": f"ask {uuid}"}]
    for name, args in calls:
        said += [{"role": "assistant", "content": "", "function_call": {"name": name, "arguments": args}}, {"role": "function", "name": name, "content": '{"b": 1, "a": "é"}'}, {"role": "assistant", "content": " so it is "}]
    meta = {"mcp_servers": [{"remote_server_response": {"tools": [{"name": "mail_send"}, {"name": ""}]}}]}
    return {"uuid": uuid, "question": f" ask {uuid} ", "available_tools": json.dumps([TOOLS[i] for i in tools]), "messages": json.dumps(said, ensure_ascii=False), "target_tools": "mail_send", "metadata": json.dumps(meta)} | more


RECORDS = [
    record("r1", [("weather-api-day", '{"city": "Köln", "days": 3}'), ("mail_send", '{"to": "a@b"}')]),
    record("r2", [("weather-api-day", {"city": "Rom", "days": 2, "unit": "c"}), ("search", "[1]")], (0, 0, 1)),
    record("r3", [("mail_send", '"{\\"to\\": \\"x\\"}"'), ("nothing", "{}")], (2, 3), available_tools="no list"),
]


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("conv")
    (path / "sub").mkdir()
    (path / "sub" / "a.jsonl").write_text("\n".join([json.dumps(RECORDS[0], ensure_ascii=False), "", "{broken", json.dumps(RECORDS[1], ensure_ascii=False)]) + "\n")
    (path / "b.jsonl").write_text(json.dumps(RECORDS[2], ensure_ascii=False) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def records(spark, lines):
    return files.records(files.read_jsonl(spark, f"file://{lines}")).cache()


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([(t["function"]["name"], json.dumps(t)) for t in TOOLS], "function_name string, definition string")


def test_mentions_and_definitions(records):
    rows = sorted((r["uuid"], r["origin"], r["position"], r["function_name"]) for r in T.mentions(records).collect())
    assert [x for x in rows if x[0] == "r2"] == [("r2", 0, 0, "weather-api-day"), ("r2", 0, 1, "weather-api-day"), ("r2", 0, 2, "weather-api-week"), ("r2", 1, 2, "weather-api-day"), ("r2", 1, 5, "search"), ("r2", 2, 0, "mail_send")]
    assert [x[1] for x in rows if x[0] == "r3"] == [1, 1, 2]
    first = {r["function_name"]: json.loads(r["definition"]) for r in T.first_definitions(T.definitions(records), ["uuid", "position"]).collect()}
    assert set(first) == {"weather-api-day", "mail_send", "weather-api-week"} and first["mail_send"] == TOOLS[2]


def test_arguments_and_types(spark, records, known):
    calls = catalog.calls(catalog.messages(records)).select("uuid", "message_index", "func", "arguments")
    args = T.with_schema(T.arguments(calls), T.properties(known))
    rows = sorted((r["uuid"], r["func"], r["param"], r["v"], r["runtime"], r["p_type"], r["required"], r["has_enum"]) for r in args.withColumn("v", F.to_json("value")).collect())
    assert rows == [("r1", "mail_send", "to", '"a@b"', "string", "string", True, False), ("r1", "weather-api-day", "city", '"Köln"', "string", "string", True, False), ("r1", "weather-api-day", "days", "3", "integer", "integer", True, False), ("r2", "weather-api-day", "city", '"Rom"', "string", "string", True, False), ("r2", "weather-api-day", "days", "2", "integer", "integer", True, False), ("r2", "weather-api-day", "unit", '"c"', "string", "string", False, True), ("r3", "mail_send", "to", '"x"', "string", "string", True, False)]
    assert T.prompt_tasks(calls, args, known).count() == 4
    total = T.totals(spark.createDataFrame([("a",), ("",), ("{",)], "line string"), calls, args).first()
    assert (total["records"], total["calls"], total["arguments"]) == (2, 6, 7)


def test_masking_leaves_no_name(spark, records):
    names = ["weather-api-day", "weather-api-week", "mail_send", "search", "nothing"]
    aliases = spark.createDataFrame([(n, f"func_x{i}") for i, n in enumerate(names)], "function_name string, alias string")
    out = obfuscate.obfuscate(records, aliases).collect()
    for r in out:
        text = json.dumps(r.asDict(), ensure_ascii=False, default=str)
        assert not [n for n in names if f'"{n}' in text or f'\\"{n}' in text], text
    one = next(r for r in out if r["uuid"] == "r1")
    system = json.loads(one["messages"])[0]["content"]
    assert system.startswith("<|im_system|>tool_declare<|im_middle|>[{") and json.loads(system[len("<|im_system|>tool_declare<|im_middle|>") : -len("<|im_end|>")])[0]["function"]["name"] == "func_x0"
    assert R.masked_declaration("no marks", {"a": "b"}) == "no marks" and R.masked_declaration(DECLARED, {}) == DECLARED


def test_summary_and_tool_blocks():
    assert R.schema_summary(json.dumps(TOOLS[0])) == "- city (string) [required]: where\n- days (['null', 'integer']) [required]\n- unit (any)"
    assert R.schema_summary(json.dumps(TOOLS[0]), 12) == "- city (s..."
    assert R.schema_summary('{"parameters": {"type": "object"}}') == '{"type": "object"}'
    assert R.tool_blocks(json.dumps([TOOLS[3], {"x": 1}]))[0].startswith("  - search\n      Search the web\n      Parameters:\n")
    assert R.tool_blocks("no list") == []


def test_questions_of_each_mode(spark, records, known):
    rows = {(r["record_uuid"], r["message_index"]): r for r in questions.build(records, known, "available", 2).collect()}
    assert set(rows) == {("r1", 2), ("r1", 5), ("r2", 2)}
    for r in rows.values():
        assert r["answer"] == r["function_name"] and len(r["options"]) == 3 and len(set(r["options"])) == 3 and r["answer"] in r["options"]
    assert {"mail_send", "weather-api-week"} <= set(rows["r1", 2]["options"])  # the family's other tool comes before others
    sets = {r["record_uuid"]: r for r in questions.build(records, known, "params", 9).where("function_name = 'weather-api-day'").collect()}
    assert sorted(sets["r1"]["options"]) == ["city", "city, days", "city, days, unit", "days"] and sets["r1"]["answer"] == "city, days"
    calls = catalog.calls(catalog.messages(records)).select("uuid", "message_index", "func", "arguments")
    args = T.with_schema(T.arguments(calls), T.properties(known)).withColumns({"value": F.to_json("value"), "cluster": F.lit("c"), "source": F.lit(0), "ord": F.monotonically_increasing_id()})
    values = {r["record_uuid"]: r for r in questions.build(records, known, "param_values", 6, pool_=pool.pool(args)).where("function_name = 'weather-api-day'").collect()}
    assert values["r1"]["answer"] == 'city="Köln"; days=3'
    assert set(values["r1"]["options"]) - {values["r1"]["answer"]} <= {'city="Köln"', "days=3", 'city="Rom"; days=3', 'city="Köln"; days=2', 'city="Rom"; days=2', 'city="a@b"; days=3', 'city="x"; days=3'} | {f'city="{c}"; days=2' for c in ("a@b", "x")}
    assert questions.build(records, known, "available", 2, max_samples=1).count() == 1 and questions.build(records, known, "param_values", 2).count() == 0
    share = questions.strategies(500, 1, spark.createDataFrame([("a", 0)], "uuid string, message_index int")).groupBy("strategy").count().collect()
    assert {r["strategy"]: round(r["count"] / 4000, 1) for r in share} == {"pool": 0.5, "drop_required": 0.2, "drop_any": 0.3} or all(abs(r["count"] / 4000 - (0.5 if r["strategy"] == "pool" else 0.25)) < 0.03 for r in share)


def test_nearest_fills_up(spark):
    rows = spark.createDataFrame([("a", ["x", "all"]), ("b", ["x", "all"]), ("c", ["y", "all"]), ("d", ["z", "all"])], "function_name string, tokens array<string>")
    for most in (100, 0):  # by an index that is broadcast, and by a join
        got = {}
        for r in mcq.nearest(rows, 2, most).orderBy("function_name", "rank").collect():
            got.setdefault(r["function_name"], []).append((r["other"], r["score"]))
        assert got == {"a": [("b", 2), ("d", 1)], "b": [("a", 2), ("d", 1)], "c": [("d", 1), ("b", 1)], "d": [("c", 1), ("b", 1)]}


def test_pool_entries_and_merge(spark):
    args = spark.createDataFrame([("f", "p", "unknown", "c", "1", 0, 0, False), ("f", "p", "integer", "c", "1", 1, 1, True), ("g", "p", "integer", "c", "2", 1, 2, False)], "func string, param string, p_type string, cluster string, value string, source int, ord long, required boolean")
    rows = {(r["level"], r["func"], r["param"], r["p_type"]): (r["observed"], r["required"], r["type"]) for r in pool.entries(args).collect()}
    assert rows == {("function", "f", "p", None): (2, True, "integer"), ("function", "g", "p", None): (1, False, "integer"), ("param", None, "p", None): (3, True, "integer"), ("type", None, None, "integer"): (2, True, "integer")}
    one = pool.pool(args)
    both = pool.merge(one.withColumn("snapshot", F.lit(0)).unionByName(pool.pool(args.where("func = 'g'")).withColumn("snapshot", F.lit(1))))
    assert {(r["level"], r["func"], r["value"]): (r["value_rank"], r["occurrences"], r["merged_count"]) for r in both.where("level = 'param'").collect()} == {("param", None, "1"): (1, 2, 3), ("param", None, "2"): (2, 2, 3)}


def test_files_round_trip(spark, records, known, tmp_path):
    to = f"file://{tmp_path}"
    files.write_catalog(known, f"{to}/meta")
    assert json.loads("\n".join(open(f"{tmp_path}/meta/{n}").read() for n in os.listdir(f"{tmp_path}/meta") if n.startswith("part"))) == {t["function"]["name"]: t for t in TOOLS}
    assert files.read_catalog(spark, f"{to}/meta").count() == 4
    aliases = spark.createDataFrame([("a\"é", "func_b"), ("c", "func_d")], "function_name string, alias string")
    files.write_alias_map(aliases, f"{to}/alias")
    assert sorted(map(tuple, files.read_alias_map(spark, f"{to}/alias").collect())) == [('a"é', "func_b"), ("c", "func_d")]
    args = spark.createDataFrame([("f", "p", "integer", "c", "1", 0, 0, False)], "func string, param string, p_type string, cluster string, value string, source int, ord long, required boolean")
    files.write_pool(pool.pool(args), pool.entries(args), pool.summary(1, 1, 1, 1, "in", None, 120, "2024"), f"{to}/pool")
    assert files.read_pool(spark, f"{to}/pool").count() == 3
    with pytest.warns(UserWarning):
        assert files.read_pool(spark, f"{to}/none").count() == 0
    records.select("uuid", "question").repartition(1).write.parquet(f"{to}/shards/x/s.parquet")
    files.convert(spark, f"{to}/shards", f"{to}/out", ["uuid"], limit=2)
    assert sorted(r["value"] for r in spark.read.option("recursiveFileLookup", "true").text(f"{to}/out").collect())[0].startswith('{"uuid":"r')
    assert spark.read.option("recursiveFileLookup", "true").text(f"{to}/out").count() == 2
    files.write_assembled(spark.createDataFrame([("u", "one\n"), ("v", "two\n")], "uuid string, text string"), f"{to}/asm", f"{to}/txt")
    files.render(spark, f"{to}/asm", f"{to}/again", 1)
    with pytest.raises(Exception, match="without text"):
        files.render(spark, f"{to}/alias", f"{to}/bad")
    files.copy_input(spark, f"{to}/asm", f"{to}/copy")
    assert os.path.isdir(f"{tmp_path}/copy/asm")
    assert files.default_path("d/x.parquet", "records") == "d/x.jsonl" and files.default_path("d/x.jsonl", "questions", "params") == "d/x_api_params.jsonl"


def test_assembly_of_a_folder(spark, lines, records, known, tmp_path):
    q = {m: questions.build(records, known, m, 2, pool_=None) for m in ("available", "params")}
    root = tmp_path / "q"
    (root / "sub").mkdir(parents=True)
    asked = {m: [r.asDict() for r in df.orderBy("record_uuid", "message_index").collect()] for m, df in q.items()}
    for m in R.MODES:
        (root / "sub" / f"a_api_{m}.jsonl").write_text("".join(json.dumps(x, ensure_ascii=False) + "\n" for x in asked.get(m, [])) + json.dumps({"mode": "other", "record_uuid": "r1", "message_index": 1}) + "\n")
    done = {(r["dir"], r["prefix"]): r for r in batch.assemble_folder(spark, f"file://{lines}", f"file://{root}", f"file://{tmp_path}/out", reveal=True).collect()}
    assert (done["sub", "a"]["status"], done["sub", "a"]["records"]) == ("done", 2) and done["", "b"]["status"] == "skipped" and done["", "b"]["missing"] == sorted(R.MODES)
    texts = {}
    for r in spark.read.option("recursiveFileLookup", "true").text(f"file://{tmp_path}/out").collect():
        texts[json.loads(r["value"])["uuid"]] = json.loads(r["value"])["text"]
    assert set(texts) == {"r1", "r2"}
    for rec in RECORDS[:2]:
        own: dict = {}
        for m in R.MODES:
            for x in asked.get(m, []):
                if x["record_uuid"] == rec["uuid"]:
                    own.setdefault(x["message_index"], []).append(x)
        assert texts[rec["uuid"]] == R.record_text(rec, own, True)
    text = texts["r1"]
    assert text.startswith("=== Record | uuid=r1 ===\nQuestion:\n  ask r1\nAvailable tools:\n  - weather-api-day\n      Weather of a day\n      Parameters:\n        {\n")
    assert "Messages:\n  system (tool_declare):\n    - function:\n" in text and '  assistant (function_call: mail_send) @msg=5:\n    {\n      "to": "a@b"\n    }\n' in text
    assert '  function[mail_send] @msg=6:\n    {\n      "a": "é",\n      "b": 1\n    }\n  [[原文回答]]\n  assistant:\n    so it is\n' in text
    assert text.index("[MCQ:available|msg=2]") < text.index("[MCQ:params|msg=2]") < text.index("@msg=2:") and "Answer: the answer is weather-api-day" in text


def test_generate_and_pretty(spark, lines, records, known, tmp_path):
    rows = batch.generate(spark, f"file://{lines}", known, f"file://{tmp_path}/gen", negatives=2).orderBy("mode")
    assert [(r["mode"], r["files"], r["questions"], r["error"]) for r in rows.collect()] == [("available", 2, 3, None), ("param_values", 2, 0, None), ("params", 2, 2, None)]
    assert tuple(batch.tallies(rows).first()) == (3, 0)
    text = batch.pretty(records, spark.createDataFrame([("weather-api-day", "tool of weather")], "alias string, function_name string"), 1).first()["text"]
    assert "call weather-api-day (tool of weather):" in text or "r3" in text

import json

import pytest
from pyspark.sql import functions as F

from toolloom.functions import fidelity
from toolloom.operators import obfuscate, prompt
from toolloom.sources import files


def test_json_rules(spark):
    rows = spark.createDataFrame([('{"b":2,"a":[1, 2]}',), ("[1]",), ("oops",), (None,), ("{}",)], "t string")
    got = rows.select(fidelity.format_arguments("t").alias("f"), fidelity.canonical("t").alias("c")).collect()
    assert [r["f"] for r in got] == ["a=[1, 2]; b=2", None, None, None, ""]
    assert [r["c"] for r in got] == ['{"a": [1, 2], "b": 2}', "[1]", None, None, "{}"]


def test_obfuscate_records(spark):
    tools = json.dumps([{"function": {"name": "x", "description": "é"}}, {"function": {"name": "z"}}], ensure_ascii=False)
    said = json.dumps([{"role": "assistant", "content": "x", "function_call": {"name": "x", "arguments": "{}"}}, {"role": "function", "name": "x"}])
    rows = spark.createDataFrame([("1", tools, said, "x"), ("2", "bad", None, '["x", "q"]'), ("3", None, None, "x, y")], "uuid string, available_tools string, messages string, target_tools string")
    out = {r["uuid"]: r for r in obfuscate.obfuscate(rows, spark.createDataFrame([("x", "A"), ("y", "B")], "function_name string, alias string")).collect()}
    assert out["1"]["available_tools"] == tools.replace('"x"', '"A"') and out["1"]["target_tools"] == "A"
    assert [m.get("name") or m["function_call"]["name"] for m in json.loads(out["1"]["messages"])] == ["A", "A"]
    assert json.loads(out["1"]["messages"])[0]["content"] == "x"
    assert out["2"]["available_tools"] == "bad" and out["2"]["target_tools"] == '["A", "q"]' and out["3"]["target_tools"] == "x, y"


def test_prompts(spark):
    m = json.dumps([{"role": "user", "content": "a"}, {"role": "user", "content": "b"}, {"role": "assistant", "content": "c"}])
    rows = spark.createDataFrame([(m,), ("[]",)], "m string").select(prompt.last_user_message(F.col("m")).alias("prompt"))
    assert [r["prompt"] for r in rows.collect()] == ["b", None]

    def client():
        def ask(p):
            if p is None:
                raise ValueError("no prompt")
            return p + "!"

        return ask

    assert [(r["reply"], r["error"]) for r in prompt.complete(rows, client).collect()] == [("b!", None), (None, "no prompt")]
    assert prompt.Limits(1000, 1000, 210).shrink() == prompt.Limits(700, 700, 200)


def test_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": "A", "n": 3, "y": "B"}')
    (tmp_path / "b.json").write_text('[{"k": 1}, 2]')
    assert sorted(map(tuple, files.read_alias_map(spark, str(tmp_path / "a.json")).collect())) == [("x", "A"), ("y", "B")]
    got = files.read_json_array(spark, str(tmp_path / "b.json")).select("position", F.to_json("value").alias("v")).collect()
    assert [tuple(r) for r in got] == [(0, '{"k":1}'), (1, "2")]
    with pytest.raises(Exception, match="no JSON list"):
        files.read_json_array(spark, str(tmp_path / "a.json")).collect()

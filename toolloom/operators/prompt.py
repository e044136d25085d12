"""Questions by a language model: limits, prompts, and a client called in partitions."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toolloom.functions import text as X
from toolloom.session import scratch, ship


@dataclass(frozen=True)
class Limits:
    """Characters of a prompt's parts."""

    context: int = 800
    schema: int = 1600
    description: int = 800

    def shrink(self) -> Limits:
        """Seven tenths, and 200, 400 and 200 at least."""
        return Limits(max(int(self.context * 0.7), 200), max(int(self.schema * 0.7), 400), max(int(self.description * 0.7), 200))


def last_user_message(messages: Column) -> Column:
    """Content of the last message of a user, from JSON text; null if there is none."""
    said = F.from_json(messages, "array<struct<role:string,content:string>>")
    return F.try_element_at(F.filter(said, lambda m: m["role"] == "user"), F.lit(-1))["content"]


def prompt(function: Column, description: Column, context: Column, schema: Column, arguments: Column, limits: Limits = Limits()) -> Column:
    head = F.lit("Write one multiple-choice question on the arguments of a tool call.")
    parts = [("Tool", function), ("Description", X.truncate(description, limits.description)), ("Conversation", X.truncate(context, limits.context)), ("Parameters", X.truncate(schema, limits.schema)), ("Correct arguments", arguments)]
    return F.concat_ws("\n\n", head, *(F.concat(F.lit(name + ":\n"), F.coalesce(v, F.lit(""))) for name, v in parts), F.lit('Answer with JSON: {"question": text, "options": [texts], "answer": text}.'))


def complete(tasks: DataFrame, client: Callable[[], Callable[[str], str]], column: str = "prompt", retries: int = 3) -> DataFrame:
    """tasks with `reply` and `error`.  `client` makes, once for each partition, a function from prompt to reply."""
    ship(tasks.sparkSession)

    def run(parts):
        ask = client()
        for pdf in parts:
            replies, errors = [], []
            for p in pdf[column]:
                reply = error = None
                for _ in range(retries):
                    try:
                        reply, error = ask(p), None
                        break
                    except Exception as e:  # a failed request is a result, not the end of the job
                        error = str(e)[:200]
                replies.append(reply)
                errors.append(error)
            yield pdf.assign(reply=pd.Series(replies, index=pdf.index, dtype=object), error=pd.Series(errors, index=pdf.index, dtype=object))

    from pyspark.sql.types import StringType, StructField, StructType

    return tasks.mapInPandas(run, StructType([*tasks.schema.fields, StructField("reply", StringType()), StructField("error", StringType())]))


PAYLOAD = "question string, options array<string>, answer string"


def judged(replies: DataFrame) -> DataFrame:
    """replies (reply, error, answer_text) with question, options, answer and reason (null: good; see text.payload_reason).

    A request that failed, and a reply without a JSON object, have reasons of their own, and `detail`, of at most 200 characters.
    """
    block = X.json_block(F.col("reply"))
    whole = F.schema_of_variant(F.try_parse_json(block)).startswith("OBJECT")
    rows = replies.withColumn("_p", F.when(whole, F.from_json(block, PAYLOAD)))
    reason = F.when(F.col("error").isNotNull(), "request_failed").when(F.col("_p").isNull(), "payload_not_dict").otherwise(X.payload_reason(F.col("_p.question"), F.col("_p.options"), F.col("_p.answer"), F.col("answer_text")))
    return rows.withColumns({"question": F.col("_p.question"), "options": F.col("_p.options"), "answer": F.col("_p.answer"), "reason": reason, "detail": F.substring(F.coalesce("error", "reply", F.lit("")), 1, 200)}).drop("_p")


def generate(tasks: DataFrame, client: Callable[[], Callable[[str], str]], limits: Limits = Limits(), retries: int = 3) -> tuple[DataFrame, DataFrame]:
    """Questions by a model for tasks, and the tasks that failed.

    tasks: uuid, message_index, func, description, said, schema, answer_text.  Each round asks for the tasks
    that are open, writes the replies down, and goes on with those that are refused, with shorter prompts.
    Returns question, options, answer, function_name, record_uuid, message_index; and uuid, message_index, reason, detail, attempts.
    """
    spark, open_, good = tasks.sparkSession, tasks, None
    columns = tasks.columns
    for attempt in range(1, retries + 1):
        text = prompt(F.col("func"), F.col("description"), F.col("said"), F.col("schema"), F.col("answer_text"), limits)
        path = scratch(spark, "replies")
        judged(complete(open_.withColumn("prompt", text), client, retries=1)).write.parquet(path)
        rows = spark.read.parquet(path)
        done = rows.where("reason is null").select("question", "options", "answer", F.col("func").alias("function_name"), F.col("uuid").alias("record_uuid"), "message_index")
        good = done if good is None else good.unionByName(done)
        failed = rows.where("reason is not null")
        if failed.isEmpty():
            break
        open_, limits = failed.select(*columns), limits.shrink()
    return good, failed.select("uuid", "message_index", "reason", "detail", F.lit(attempt).alias("attempts"))


def failures(failed: DataFrame, most: int = 5) -> DataFrame:
    """reason, failures and the first `most` samples (uuid:message_index and detail) of each reason."""
    key = F.struct("uuid", "message_index")
    first = failed.withColumn("_n", F.row_number().over(Window.partitionBy("reason").orderBy("uuid", "message_index")))
    samples = first.where(F.col("_n") <= most).groupBy("reason").agg(F.array_sort(F.collect_list(F.struct(key.alias("task"), F.col("detail")))).alias("samples"))
    return failed.groupBy("reason").agg(F.count(F.lit(1)).alias("failures")).join(samples, "reason")


def endpoint(base_url: str, model: str | None = None, api_key: str = "EMPTY", system: str | None = None, temperature: float = 0.4, max_tokens: int = 512, pause: float = 0.0, timeout: float = 60) -> Callable[[], Callable[[str], str]]:
    """A client of an endpoint for chat completions, for complete() and generate(); without a model the first that it lists."""

    def make():
        name = model or models(base_url, api_key, timeout)[0]

        def ask(text: str) -> str:
            said = [{"role": "system", "content": system}] if system else []
            body = {"model": name, "messages": [*said, {"role": "user", "content": text}], "temperature": temperature, "max_tokens": max_tokens}
            out = _call(f"{base_url.rstrip('/')}/chat/completions", api_key, timeout, body)["choices"][0]["message"]["content"]
            time.sleep(pause)
            return out

        return ask

    return make


def models(base_url: str, api_key: str = "EMPTY", timeout: float = 60) -> list[str]:
    """Names of the models that an endpoint lists."""
    return [m["id"] for m in _call(f"{base_url.rstrip('/')}/models", api_key, timeout)["data"]]


def _call(url: str, api_key: str, timeout: float, body: dict | None = None) -> dict:
    data = None if body is None else json.dumps(body).encode()
    with urllib.request.urlopen(urllib.request.Request(url, data, {"Authorization": f"Bearer {api_key}", "Content-Type": "application/json"}), timeout=timeout) as answer:
        return json.load(answer)


def signature() -> tuple[int, str]:
    """What stands where a signed request would carry its time and signature: seconds, and no signature."""
    return int(time.time()), ""

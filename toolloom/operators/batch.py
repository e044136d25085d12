"""Whole folders of conversation and question files: which belong together, their questions, and their assembled texts."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from toolloom.functions import records as R
from toolloom.operators import catalog as C
from toolloom.operators import questions as Q
from toolloom.session import ship
from toolloom.sources import files

RECORD = ("uuid", "record_uuid", "question", "available_tools", "messages", "target_tools", "question_quality_assessment", "response_quality_assessment", "metadata")


def placed(paths: DataFrame, root: str) -> DataFrame:
    """path, dir (below root) and name of each file."""
    rel = below(F.col("path"), root)
    return paths.select("path", F.regexp_replace(rel, r"/?[^/]+$", "").alias("dir"), F.regexp_extract(rel, r"([^/]+)$", 1).alias("name"))


def below(path: Column, root: str) -> Column:
    """A path as seen from a folder above it."""
    plain = re.sub("^file:/+", "/", root).rstrip("/") + "/"
    return F.replace(F.regexp_replace(path, "^file:/+", "/"), F.lit(plain), F.lit(""))


def conversations(paths: DataFrame) -> DataFrame:
    """Files that hold conversations: .json or .jsonl, no results of assembly, no question files."""
    stem = F.regexp_replace("name", r"\.[^.]+$", "")
    ok = F.col("name").rlike(r"\.jsonl?$") & ~F.col("name").endswith("_mcq_assembled.jsonl") & ~stem.contains("_api_")
    return paths.where(ok).withColumn("prefix", stem)


def jobs(conversation_files: DataFrame, question_files: DataFrame) -> DataFrame:
    """dir, prefix, path, missing (question modes without a file) of each conversation file; both as from placed()."""
    want = conversations(conversation_files).select("dir", "prefix", "path", F.explode(F.array(*map(F.lit, R.MODES))).alias("mode")).withColumn("name", F.concat("prefix", F.lit("_api_"), "mode", F.lit(".jsonl")))
    have = question_files.select("dir", "name", F.col("path").alias("questions"))
    both = want.join(have, ["dir", "name"], "left")
    return both.groupBy("dir", "prefix", "path").agg(F.array_sort(F.collect_list(F.when(F.col("questions").isNull(), F.col("mode")))).alias("missing"))


def valid_questions(lines: DataFrame) -> DataFrame:
    """order_key, uuid, message_index, mode, mode_rank, q (JSON text) of question lines with a record, a message and a known mode."""
    j = lambda path: F.get_json_object("line", path)
    rows = lines.select("order_key", j("$.record_uuid").alias("uuid"), j("$.message_index").try_cast("int").alias("message_index"), F.lower(j("$.mode")).alias("mode"), F.col("line").alias("q"))
    return rows.where(F.col("uuid").isNotNull() & F.col("message_index").isNotNull() & F.col("mode").isin(*R.MODES)).withColumn("mode_rank", F.array_position(F.array(*map(F.lit, R.MODES)), F.col("mode")).cast("int"))


def by_record(questions: DataFrame, *more: str) -> DataFrame:
    """uuid (and `more`), asked: a record's questions as JSON texts by message, mode and place in their files."""
    one = F.struct("message_index", "mode_rank", "order_key", "q")
    return questions.groupBy(*more, "uuid").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: F.struct(x["message_index"].alias("message_index"), x["q"].alias("q"))).alias("asked"))


def assembled_column(record: Column, asked: Column, reveal: bool, show_function: bool) -> Column:
    """Text of a record (a struct of RECORD) with its questions (see by_record)."""

    @pandas_udf(StringType())
    def run(rows: pd.DataFrame, questions: pd.Series) -> pd.Series:
        out = []
        for r, qs in zip(rows.to_dict("records"), questions):
            own: dict[int, list] = {}
            for x in qs if qs is not None else []:
                own.setdefault(int(x["message_index"]), []).append(json.loads(x["q"]))
            out.append(R.record_text({k: v for k, v in r.items() if v is not None}, own, reveal, show_function))
        return pd.Series(out, index=rows.index, dtype=object)

    return run(record, asked)


def assembled(records: DataFrame, questions: DataFrame, reveal: bool = False, show_function: bool = False, more: tuple[str, ...] = ()) -> DataFrame:
    """uuid and text of each record (and `more`, by which records and questions belong together besides the uuid)."""
    ship(records.sparkSession)
    both = records.join(by_record(questions, *more), [*more, "uuid"], "left")
    row = F.struct(*(F.col(c) if c in records.columns else F.lit(None).cast("string").alias(c) for c in RECORD))
    return both.select(*more, "uuid", assembled_column(row, F.col("asked"), reveal, show_function).alias("text"))


def assemble_folder(spark: SparkSession, conversation_root: str, question_root: str, to: str, reveal: bool = False, show_function: bool = False) -> DataFrame:
    """Assemble all files that have the questions of all modes, one folder (dir, prefix) of JSON lines for each under `to`.

    Returns a row for each conversation file: dir, prefix, status (done or skipped), missing, records, questions.
    """
    listed = jobs(placed(files.discover(spark, conversation_root, "*.json*"), conversation_root), placed(files.discover(spark, question_root, "*_api_*.jsonl"), question_root))
    ready = listed.where(F.size("missing") == 0).select("dir", "prefix")

    def own(lines: DataFrame, root: str) -> DataFrame:
        rel = below(F.col("order_key.file"), root)
        name = F.regexp_extract(rel, r"([^/]+)$", 1)
        return lines.select("*", F.regexp_replace(rel, r"/?[^/]+$", "").alias("dir"), name.alias("name"))

    said = own(files.read_jsonl(spark, conversation_root), conversation_root).withColumn("prefix", F.regexp_replace("name", r"\.[^.]+$", "")).join(ready, ["dir", "prefix"], "left_semi")
    texts = said.select("dir", "prefix", *(F.get_json_object("line", f"$.{c}").alias(c) for c in RECORD)).withColumn("uuid", F.coalesce("uuid", "record_uuid"))
    asked = own(files.read_jsonl(spark, question_root), question_root).where(F.col("name").rlike(r"_api_(available|params|param_values)\.jsonl$"))
    asked = valid_questions_in(asked).join(ready, ["dir", "prefix"], "left_semi")
    assembled(texts, asked, reveal, show_function, ("dir", "prefix")).select(F.to_json(F.struct("uuid", "text"), {"ignoreNullFields": "false"}).alias("value"), F.concat_ws("/", F.when(F.col("dir") != "", F.col("dir")), "prefix").alias("job")).write.partitionBy("job").mode("overwrite").text(to)
    n, m = texts.groupBy("dir", "prefix").agg(F.count(F.lit(1)).alias("records")), asked.groupBy("dir", "prefix").agg(F.count(F.lit(1)).alias("questions"))
    return listed.join(n, ["dir", "prefix"], "left").join(m, ["dir", "prefix"], "left").select("dir", "prefix", F.when(F.size("missing") == 0, "done").otherwise("skipped").alias("status"), "missing", "records", "questions")


def valid_questions_in(lines: DataFrame) -> DataFrame:
    """As valid_questions, with dir and prefix."""
    prefix = F.regexp_replace("name", r"_api_(available|params|param_values)\.jsonl$", "")
    j = valid_questions(lines.select("line", F.struct("order_key", "dir", prefix.alias("prefix")).alias("order_key")))
    return j.select("order_key.dir", "order_key.prefix", F.col("order_key.order_key").alias("order_key"), "uuid", "message_index", "mode", "mode_rank", "q")


def generate(spark: SparkSession, root: str, catalog: DataFrame, to: str, modes: tuple[str, ...] = R.MODES, negatives: int = 9, seed: int = 42, pool_: DataFrame | None = None, max_files: int | None = None) -> DataFrame:
    """Questions of each mode for the files of a folder, as JSON lines under `to`; a row for each mode: mode, files, questions, error.

    A mode that fails is a row with its error; the others go on.
    """
    chosen = files.discover(spark, root)
    chosen = chosen.limit(max_files) if max_files else chosen
    lines = files.read_jsonl(spark, root).join(chosen.select(F.col("path").alias("_p")), F.regexp_replace("order_key.file", "^file:/+", "/") == F.regexp_replace("_p", "^file:/+", "/"), "left_semi")
    records, n = files.records(lines), chosen.count()
    tally = []
    for mode in modes:
        try:
            files.write_questions(Q.build(records, catalog, mode, negatives, seed, pool_), f"{to}/{mode}")
            tally.append((mode, n, spark.read.text(f"{to}/{mode}").count(), None))
        except Exception as e:  # the other modes go on; the row tells
            tally.append((mode, n, None, str(e)[:200]))
    return spark.createDataFrame(tally, "mode string, files long, questions long, error string")


def tallies(results: DataFrame) -> DataFrame:
    """One row: succeeded and failed, of rows with a column `error`."""
    return results.agg(F.count(F.when(F.col("error").isNull(), 1)).alias("succeeded"), F.count("error").alias("failed"))


def pretty(records: DataFrame, aliases: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """uuid, text for readers, with `alias (original)` for names of the map; `most` keeps the first lines by order_key."""
    ship(records.sparkSession)
    rows = records.orderBy("order_key").limit(most) if most else records
    if aliases is None:
        own = rows.withColumn("_names", F.lit(None).cast("map<string,string>"))
    else:
        used = C.messages(rows).select("uuid", F.explode(F.array("func", "name")).alias("alias")).unionByName(Q.T.available_names(rows).select("uuid", F.col("function_name").alias("alias"))).distinct()
        names = used.join(aliases, "alias").groupBy("uuid").agg(F.map_from_entries(F.collect_list(F.struct("alias", "function_name"))).alias("_names"))
        own = rows.join(names, "uuid", "left")

    @pandas_udf(StringType())
    def run(record: pd.DataFrame, names: pd.Series) -> pd.Series:
        return pd.Series([R.pretty_text(r, dict(n) if n is not None else {}) for r, n in zip(record.to_dict("records"), names)], index=record.index, dtype=object)

    return own.select("uuid", run(F.struct("uuid", "question", "available_tools", "messages"), F.col("_names")).alias("text"))

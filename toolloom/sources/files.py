"""Readers and writers of trajectory files."""

from __future__ import annotations

import json
import re
import warnings

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from toolloom.functions import fidelity

FIELDS = ("uuid", "subset_name", "question", "available_tools", "messages", "target_tools", "question_quality_assessment", "response_quality_assessment", "metadata")


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet shards of a folder tree; only the columns asked for are read."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return df.select(*columns) if columns else df


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """line (text) and value (variant) of each line that holds a JSON object; other lines are passed over.

    `order_key` keeps files and lines in order, for rules by which the first wins.
    """
    rows = spark.read.option("recursiveFileLookup", "true").text(path)
    key = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    out = rows.select(F.col("value").alias("line"), F.try_parse_json("value").alias("value"), key.alias("order_key"))
    return out.where(F.col("value").isNotNull() & F.schema_of_variant("value").startswith("OBJECT"))


def records(lines: DataFrame) -> DataFrame:
    """The nine raw fields of trajectories as texts; nested values become JSON text."""
    return lines.select("order_key", *(F.get_json_object("line", f"$.{f}").alias(f) for f in FIELDS))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.option("ignoreNullFields", "false").mode("overwrite").json(path)


def write_texts(df: DataFrame, path: str, column: str = "text") -> None:
    """Blocks separated by a blank line."""
    df.select(F.assert_true(F.col(column).isNotNull(), F.lit("a record without text")).alias("ok"), column).select(column).write.option("lineSep", "\n\n").mode("overwrite").text(path)


def write_counts(df: DataFrame, path: str) -> None:
    """function_name,count with a header, in rank order; one row for each tool name."""
    df.orderBy("rank").select("function_name", "count").coalesce(1).write.option("header", "true").mode("overwrite").csv(path)


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """file, position and value (variant) of the items of files that hold one JSON list each; other files are an error."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v"))
    checked = whole.select("file", F.when(F.schema_of_variant("v").startswith("ARRAY"), F.col("v")).otherwise(F.raise_error(F.lit("a file that holds no JSON list"))).alias("v"))
    return checked.select("file", F.posexplode(F.col("v").try_cast("array<variant>")).alias("position", "value"))


def read_alias_map(spark: SparkSession, path: str) -> DataFrame:
    """function_name, alias from a JSON object; pairs that aren't texts are passed over."""
    whole = spark.read.text(path, wholetext=True)
    pairs = F.from_json("value", "map<string,variant>", {"mode": "FAILFAST"})
    rows = whole.select(F.explode(pairs).alias("function_name", "v"))
    return rows.where(F.schema_of_variant("v") == "STRING").select("function_name", F.col("v").cast("string").alias("alias"))


# --- whole-folder conversion and other file shapes


def convert(spark: SparkSession, path: str, to: str, columns: list[str] | None = None, limit: int | None = None, sample: int = 0, seed: int = 42) -> None:
    """Parquet shards of a folder tree to JSON lines, one folder for each shard (column `file`), so that none overwrites another.

    limit and sample are counted for each shard: first the limit, then a sample by hash of the rows kept.
    """
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    names = columns or rows.columns
    rows = rows.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.parquet$", 1).alias("file"), F.xxhash64(F.col("_metadata.file_path")).alias("_f"), F.monotonically_increasing_id().alias("_n"), *(F.col(f"`{c}`") for c in names))
    for k, order in ((limit, ["_n"]), (sample or None, [F.md5(F.concat_ws("|", F.lit(str(seed)), "_f", "_n").cast("binary")), "_n"])):
        if k is not None:
            w = Window.partitionBy("_f").orderBy(*order)
            rows = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
    out = rows.select("file", "_f", F.to_json(F.struct(*(F.col(f"`{c}`") for c in names)), {"ignoreNullFields": "false"}).alias("value"))
    # shards of one name in two folders stay apart
    out.select("value", F.concat_ws("-", "file", F.hex("_f")).alias("file")).write.partitionBy("file").mode("overwrite").text(to)


def discover(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """path of each file of a tree whose name fits, in order; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path").orderBy("path")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, position and value (variant) of a file's records: JSON lines by its suffix, else one JSON list."""
    if path.endswith(".jsonl"):
        rows = read_jsonl(spark, path)
        return rows.select(F.col("order_key.file").alias("file"), F.struct("order_key.block", "order_key.n").alias("position"), "value")
    return read_json_array(spark, path)


def read_json_dict(spark: SparkSession, path: str) -> DataFrame:
    """key and value (JSON text) of the pairs of a file that holds one JSON object, in their order; other files are an error."""
    whole = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    checked = whole.select(F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")).otherwise(F.raise_error(F.lit("a file that holds no JSON object"))).alias("v"))
    return checked.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(F.col("pos").alias("position"), "key", F.to_json("value").alias("value"))


def write_json_dict(pairs: DataFrame, path: str, key: str, value: str, text: bool = False) -> None:
    """One JSON object, indented by two, with the pairs in the order of their keys.  `text`: values are texts, not JSON."""
    last = pairs.agg(F.max(key)).first()[0]
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(F.col(c))), r"^\[|\]$", "")
    shown = quoted(value) if text else F.regexp_replace(fidelity.indented(F.col(value)), "\n", "\n  ")
    rows = pairs.select(F.lit(1).alias("at"), F.col(key).alias("k"), F.concat(F.lit("  "), quoted(key), F.lit(": "), shown, F.when(F.col(key) == last, "").otherwise(",")).alias("value"))
    ends = pairs.sparkSession.createDataFrame([(0, "", "{"), (2, "", "}")], "at int, k string, value string")
    rows.unionByName(ends).orderBy("at", "k").coalesce(1).select("value").write.mode("overwrite").text(path)


def write_alias_map(aliases: DataFrame, path: str) -> None:
    write_json_dict(aliases, path, "function_name", "alias", text=True)


def write_catalog(catalog: DataFrame, path: str) -> None:
    write_json_dict(catalog, path, "function_name", "definition")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return read_json_dict(spark, path).select(F.col("key").alias("function_name"), F.col("value").alias("definition"))


def write_questions(rows: DataFrame, path: str) -> None:
    """The seven columns of questions as JSON lines."""
    write_jsonl(rows.select("mode", "question", "options", "answer", "function_name", "record_uuid", "message_index"), path)


POOL = "level_rank int, level string, func string, param string, p_type string, cluster string, value string, value_rank int, occurrences long"


def write_pool(pool: DataFrame, entries: DataFrame, meta: dict, path: str) -> None:
    """A pool as a folder: values and entries as parquet, and one JSON line with the run's figures."""
    spark = pool.sparkSession
    pool.write.mode("overwrite").parquet(f"{path}/values")
    entries.write.mode("overwrite").parquet(f"{path}/entries")
    spark.createDataFrame([(json.dumps(meta, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def read_pool(spark: SparkSession, path: str | None) -> DataFrame:
    """The values of a pool; a folder that is not there, or holds something else, is an empty pool and a warning."""
    try:
        if path is None:
            raise ValueError("no path")
        return spark.read.schema(POOL).parquet(f"{path}/values") if spark.read.parquet(f"{path}/values").columns else spark.createDataFrame([], POOL)
    except (AnalysisException, Py4JJavaError, ValueError) as e:
        warnings.warn(f"no pool at {path}: {str(e)[:120]}", stacklevel=2)
        return spark.createDataFrame([], POOL)


def write_assembled(rows: DataFrame, path: str, texts: str | None = None, shown: str = "text") -> None:
    """uuid and text as JSON lines; with `texts`, column `shown` as blocks separated by a blank line."""
    write_jsonl(rows.select("uuid", "text"), path)
    if texts:
        write_texts(rows, texts, shown)


def render(spark: SparkSession, path: str, to: str, limit: int | None = None) -> None:
    """Texts of JSON lines as blocks; a line that is no object, or has no text, is an error."""
    rows = spark.read.text(path).where(F.trim("value") != "")
    rows = rows.limit(limit) if limit else rows
    v = F.try_parse_json("value")
    text = F.try_variant_get(v, "$.text", "string")
    write_texts(rows.select(F.when(text.isNotNull(), text).otherwise(F.raise_error(F.concat(F.lit("a line without text: "), F.substring("value", 1, 80)))).alias("text")), to)


def copy_input(spark: SparkSession, path: str, to: str) -> None:
    """A file or folder as it is, byte for byte, in a folder."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    source, target = hadoop.Path(path), hadoop.Path(to)
    target.getFileSystem(conf).mkdirs(target)
    hadoop.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, True, conf)


def default_path(path: str, kind: str, mode: str = "") -> str:
    """Where a step writes unless told: kind is records, text, questions, prompted or assembled."""
    stem = re.sub(r"\.[^./]+$", "", path)
    return stem + {"records": ".jsonl", "text": ".txt", "questions": f"_api_{mode}.jsonl", "prompted": "_api_param_values_prompt.jsonl", "assembled": "_mcq_assembled.jsonl", "assembled_text": "_mcq_assembled.txt"}[kind]

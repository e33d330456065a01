"""Readers and writers: CSV, JSON, JSON lines, Parquet, named splits, snapshots; and the pairing of conversation turns."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from parley.functions.lexicons import NA_TOKENS
from parley.sources import json_array

RAW = T.StructType([T.StructField(n, T.StringType()) for n in ("instruction", "response", "category", "intent", "flags")])
MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
METADATA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("intent", "category", "sentiment", "urgency")]
    + [T.StructField("escalation", T.BooleanType()), T.StructField("complexity", T.StringType())]
)
CHAT = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE)), T.StructField("metadata", METADATA)])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = RAW, na_tokens=NA_TOKENS, line_breaks: bool = True) -> DataFrame:
    """With a header; quoted line breaks and doubled quotes are read; cells that say "no value" become null. Without
    ``line_breaks`` inside cells a file is cut into several tasks."""
    reader = spark.read.option("header", True).option("multiLine", line_breaks).option("quote", '"').option("escape", '"')
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select(*[F.when(~F.col(c).isin(*na_tokens), F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A file with one JSON array of objects, read by several tasks if it is large."""
    return json_array.read_array(spark, path, schema)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = CHAT) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_test(spark: SparkSession, path: str, schema: T.StructType = CHAT) -> DataFrame:
    """The JSON lines of a test split, which has to be there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        raise FileNotFoundError(f"no test split at {path}: make the splits first")
    return read_jsonl(spark, path, schema)


def write_json(df: DataFrame, path: str, indent: int = 4) -> int:
    """One file with one JSON array, and the number of its rows; written by the tasks."""
    return json_array.write_array(df, path, indent)


def scratch(spark: SparkSession) -> str:
    """The folder for intermediate files, from ``spark.checkpoint.dir``; a temporary one where that is unset and all is one
    process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='parley-')}"
        atexit.register(shutil.rmtree, path.removeprefix("file://"), ignore_errors=True)
    return path.rstrip("/")


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_splits(spark: SparkSession, paths: dict[str, str], schema: T.StructType = CHAT) -> DataFrame:
    """Named JSONL files as one table with a ``split`` column."""
    parts = [read_jsonl(spark, p, schema).withColumn("split", F.lit(name)) for name, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Types of the columns that the stages add, where a table is read from text.
KINDS = {"row_id": "bigint", "variant_no": "int", "is_augmented": "boolean", "escalation": "boolean", "quality_score": "double"}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV, JSON, JSON lines or Parquet table, by its suffix; a CSV or JSON table without row_id is numbered."""
    kind = path.rstrip("/").rsplit(".", 1)[-1]
    if kind not in ("csv", "json", "jsonl"):
        return spark.read.parquet(path)
    df = read_csv(spark, path, None) if kind == "csv" else read_json(spark, path) if kind == "json" else spark.read.json(path)
    df = df.withColumns({c: F.col(c).cast(t) for c, t in KINDS.items() if c in df.columns} | {c: F.col(c).cast("double") for c in df.columns if c.endswith("_score")})
    return df if "row_id" in df.columns else with_row_id(df)


def write_table(df: DataFrame, path: str) -> None:
    kind = path.rstrip("/").rsplit(".", 1)[-1]
    {"csv": write_csv, "json": write_json, "jsonl": write_jsonl}.get(kind, lambda df, path: df.write.mode("overwrite").parquet(path))(df, path)


def snapshot(df: DataFrame, path: str) -> None:
    """Kept as first written."""
    df.write.mode("ignore").parquet(path)


def row_text(df: DataFrame) -> Column:
    """A text that tells rows with different cells apart, whatever these hold: each cell, by its column's name, with its length;
    nulls are marked."""
    say = lambda c, t: F.to_json(F.col(f"`{c}`"), {"ignoreNullFields": "false"}) if t.startswith(("struct", "array", "map")) else F.col(f"`{c}`").cast("string")
    cells = [F.coalesce(F.concat(F.lit(f"{c}="), F.length(v).cast("string"), F.lit(":"), v), F.lit(f"{c}~")) for c, t in sorted(df.dtypes) for v in (say(c, t),)]
    return F.concat_ws("|", *cells)


def digest(df: DataFrame) -> DataFrame:
    """n_rows, version: a digest of a table's rows that does not depend on their order, nor on that of the columns. Two sums of
    parts of the rows' md5 are merged like counts, so repeated rows count and nothing is sorted or shuffled."""
    rows = df.select(F.md5(row_text(df)).alias("h"))
    part = lambda at: F.coalesce(F.sum(F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
    sums = rows.agg(F.count("*").alias("n_rows"), part(1).alias("a"), part(17).alias("b"))
    return sums.select("n_rows", F.md5(F.concat_ws("|", F.lit(",".join(sorted(df.columns))), F.col("n_rows").cast("string"), F.col("a").cast("string"), F.col("b").cast("string"))).alias("version"))


def versioned(df: DataFrame, path: str) -> tuple[str, bool]:
    """Keep a table under ``path`` by its content: the folder, and whether it is new. The same rows in any order are there
    already; another cell makes another version. A version whose writing was broken off is written again."""
    version = digest(df).first().version
    where = f"{path.rstrip('/')}/version={version}"
    marker = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{where}/_SUCCESS")
    if marker.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).exists(marker):
        return where, False
    df.write.mode("overwrite").parquet(where)
    return where, True


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """A number from 0 in the order of the input: the place inside the partition and the sizes of those before it, one row
    a partition; no global sort, no row leaves the JVM. For scans: the partitions have to be the same in both passes."""
    place = F.monotonically_increasing_id()
    sizes = df.select(F.shiftright(place, 33).alias("_part")).groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    rows = df.withColumn("_place", place).withColumn("_part", F.shiftright("_place", 33))
    number = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(before), "_part").withColumn(name, number).drop("_part", "_place", "_before")


# Fixed values of the test view: phrases put before user turns, and labels by row.
PHRASES = (
    "where is my parcel?", "where is my parcel", "thanks for the help!", "thanks, is it fixed?", "good but wrong", "good but wrong!", "I love my badge",
    "i want it", "i want it", "please help asap", "need it asap", "hello", "hello", "i have an issue", "update personal details", "illegal charge",
    "is it cancelled?", "unauthorized login", "a b c d e f g h i j k l m n o button", "a b c d e f g h i j k l m n o p q r s t u",
    "a b c d e f g h i j k l m n o p q r s t u", "cannot use  my account!!",
    "what is the status of {{Order Number}}??? I had difficulties with my purchase",
)
LABELS = (
    ("ORDER", "cancel_order"), ("ORDER", "place_order"), ("ORDER", "track_order"), ("REFUND", "get_refund"), ("ACCOUNT", "recover_password"),
    ("SHIPPING", "change_shipping_address"), ("FEEDBACK", "review"), ("SECURITY", "report_login"),
)
FLAGS = ("B", "BL", "BQZ", "BCEL", None, "", "BCELNZ")


def _case(number: str, values) -> str:
    say = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return f"CASE {number} " + " ".join(f"WHEN {i} THEN {say(v)}" for i, v in enumerate(values)) + " END"


#: Rows of a user turn and the assistant's answer; the same SQL text for Spark and DuckDB.
INTERACTIONS_SQL = f"""
SELECT row_id,
  CASE WHEN row_id % 5 = 0 THEN phrase ELSE concat(phrase, ' ', question) END AS instruction,
  response, {_case("label", [c for c, _ in LABELS])} AS category, {_case("label", [i for _, i in LABELS])} AS intent, {_case("flag", FLAGS)} AS flags
FROM (
  SELECT row_id, question, response, {_case("row_id % 23", PHRASES)} AS phrase,
    CAST(floor(row_id / 7) AS BIGINT) % 8 AS label, CAST(floor(row_id / 3) AS BIGINT) % 7 AS flag
  FROM (
    SELECT u.conv_id * 1000 + u.turn AS row_id, u.text AS question, a.text AS response
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'
  ) p
) q
"""


def over_turns(turns: DataFrame, sql: str) -> DataFrame:
    """The result of SQL text that reads ``conversations``, over ``turns``; the view goes once the text is analysed."""
    spark, view = turns.sparkSession, f"parley_turns_{uuid.uuid4().hex}"
    turns.createTempView(view)
    try:
        return spark.sql(sql.replace("conversations", view))
    finally:
        spark.catalog.dropTempView(view)


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, instruction, response, category, intent, flags from the turns of ``conversations``."""
    return over_turns(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"), INTERACTIONS_SQL)

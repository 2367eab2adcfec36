"""File sources: SRC-1 transcript CSVs, SRC-2 recording manifest, SRC-3 STT chunk lists,
SRC-5 prompt text, SRC-6 feature CSVs. All with fixed schemas; no inference."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.constants import FEATURES, FILE_ROLES
from parley.schemas import CHUNK_LIST, TURN


def _given(path: str) -> None:
    """FIL-6: an argument check."""
    if not path:
        raise ValueError("the path cannot be empty")


def file_name() -> Column:
    """The name of a row's file as it is; Spark states it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def only_calls(calls: list[str], prefix: str = "", suffix: str = "") -> str:
    """A pattern of file names that lets through the files of these calls, so that no other is opened."""
    plain = [re.sub(r"([][{}*?\\,^-])", r"\\\1", c) for c in calls]
    return prefix + "{" + ",".join(plain) + "}" + suffix


def read_transcripts(spark: SparkSession, path: str, glob: str | None = "*.csv", calls: list[str] | None = None) -> DataFrame:
    """SRC-1: one CSV per call (header, columns start, end, transcription, role); the file name
    without its suffix is the call key. Quoted fields may hold quotes (doubled), commas and line
    breaks. The files' role words become ours; other role words stay as they are. ``glob=None``
    scans every file (the agent-side stage). ``calls`` reads the CSVs of these calls, and opens no
    other file."""
    _given(path)
    glob = glob if calls is None else only_calls(calls, suffix=".csv")
    r = spark.read.schema(TURN).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.csv(path)
    key = F.regexp_replace(file_name(), r"\.[^.]*$", "")
    roles = F.create_map(*(F.lit(x) for pair in FILE_ROLES.items() for x in pair))
    role = F.coalesce(F.try_element_at(roles, F.lower(F.trim("role"))), F.col("role"))
    return df.select(key.alias("call_id"), F.col("start").alias("start_s"), F.col("end").alias("end_s"),
                     role.alias("role"), F.col("transcription").alias("text"))


def manifest(spark: SparkSession, path: str, glob: str = "*.wav", recursive: bool = False) -> DataFrame:
    """SRC-2: file listing with ``path, length, modified``; file contents are never read."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    _given(path)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def chunks_to_turns(df: DataFrame, json_col: str, key_cols: list[str]) -> DataFrame:
    """SRC-3: a JSON chunk list ``[{"timestamp": [start, end], "text": ...}, ...]`` per row ->
    ``(key..., seq, start_s, end_s, text)``; a missing end stays null (behaviour B20)."""
    parsed = df.select(*key_cols, F.posexplode(F.from_json(F.col(json_col), CHUNK_LIST)).alias("seq", "c"))
    return parsed.select(*key_cols, F.col("seq").cast("bigint").alias("seq"),
                         F.get(F.col("c.timestamp"), 0).alias("start_s"),
                         F.get(F.col("c.timestamp"), 1).alias("end_s"), F.col("c.text").alias("text"))


def chunk_problem(json_col: str) -> Column:
    """FIL-6 for chunk lists: rows that :func:`chunks_to_turns` can read nothing from."""
    c = F.col(json_col)
    return F.when(c.isNull(), F.lit("null_json")).when(F.from_json(c, CHUNK_LIST).isNull(), F.lit("bad_json"))


def read_prompt(spark: SparkSession, text: str | None = None, path: str | None = None) -> DataFrame:
    """SRC-5: a literal prompt, or the whole content of a text file (any file system that Spark
    reads), as a one-row table. Exactly one of the two is given."""
    if (text is None) == (path is None):
        raise ValueError("give either a text or a path")
    if path is not None:
        return spark.read.text(path, wholetext=True).select(F.col("value").alias("prompt"))
    return spark.createDataFrame([(text,)], "prompt string")


def read_features(spark: SparkSession, path: str, feature_names: list[str] = FEATURES, calls: list[str] | None = None,
                  tab_separated: bool = False) -> DataFrame:
    """SRC-6: feature files, one row per segment in order of time and no index column, so the row
    number is the segment: ``(call_id, seg, features...)``. Comma-separated files have a header;
    tab-separated ones have none. The call key is the file name without ``features_`` and its
    suffix. ``calls`` restricts to a subset, whose files alone are opened. One file is one call, and is
    read as a whole."""
    _given(path)
    sep, suffix = ("\t", ".tsv") if tab_separated else (",", ".csv")
    glob = f"*{suffix}" if calls is None else only_calls(calls, "{features_,}", suffix)
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob).select(
        F.regexp_replace(F.regexp_replace(file_name(), r"^features_", ""), rf"\{suffix}$", "").alias("call_id"),
        F.split(F.regexp_replace("value", r"(\r?\n)+\z", ""), r"\r?\n").alias("rows"))
    skipped = 0 if tab_separated else 1
    rows = files.select("call_id", F.posexplode("rows").alias("at", "row")).where((F.col("at") >= skipped) & (F.col("row") != ""))
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in feature_names])
    parsed = F.from_csv(F.col("row"), schema.simpleString()[len("struct<"):-1].replace(":", " "), {"sep": sep})
    return rows.select("call_id", (F.col("at") - skipped).alias("seg"), parsed.alias("f")).select("call_id", "seg", "f.*")

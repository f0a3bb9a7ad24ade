"""Readers of datasets, task files, trajectory folders and logs. All return lazy plans."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "map<string, array<string>>"
MESSAGES = "array<struct<role string, content array<struct<type string, text string, image string>>>>"
#: content may be a text instead of a list of items, so it is read as text and told apart after
_RAW_MESSAGES = "array<struct<role string, content string>>"


def prompts(spark: SparkSession, paths: str | Sequence[str], *columns: str, merge: bool = False) -> DataFrame:
    """Parquet files as one table by column name; nested keys such as ``extra_info.index`` may be named."""
    files = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.option("mergeSchema", str(merge).lower()).parquet(*files)
    return df.select(*columns) if columns else df


def supervised(spark: SparkSession, paths: str | Sequence[str], prompt: str = "prompt", response: str = "response", prompt_keys: Sequence[str] = (), response_keys: Sequence[str] = ()) -> DataFrame:
    """(prompt, response), each from a column or a path into it."""
    df = prompts(spark, paths)
    dig = lambda c, keys: F.col(".".join([c, *keys]))
    return df.select(dig(prompt, prompt_keys).alias("prompt"), dig(response, response_keys).alias("response"))


def preferences(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return prompts(spark, paths, "prompt", "chosen", "rejected")


def conversations(spark: SparkSession, paths: str | Sequence[str], messages: str = "messages", tools: str = "tools", thinking: str = "enable_thinking") -> DataFrame:
    """messages with tools and enable_thinking, null where a file has no such column."""
    df = prompts(spark, paths, merge=True)
    optional = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in (tools, thinking)]
    return df.select(messages, *optional)


LOADERS: dict[str, Callable[..., DataFrame]] = {}


def loader(name: str) -> Callable:
    """Registers a function (spark, ...) that gives a dataset; a name taken by another one raises ValueError."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if LOADERS.get(name, f) is not f:
            raise ValueError(f"loader {name} is already registered")
        LOADERS[name] = f
        return f

    return add


def load(spark: SparkSession, name: str, *needed: str, **options) -> DataFrame:
    """The dataset of a registered loader; it must be a DataFrame that has the needed columns."""
    if name not in LOADERS:
        raise ValueError(f"unknown loader {name}")
    df = LOADERS[name](spark, **options)
    if not isinstance(df, DataFrame):
        raise TypeError(f"loader {name} gave no DataFrame")
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"loader {name} lacks {missing}")
    return df


def catalog_stream(spark: SparkSession, path: str, schema: str | T.StructType, files: int = 16) -> DataFrame:
    """New files of a catalog folder as a stream; a micro-batch takes at most ``files`` of them, which bounds what waits."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).option("recursiveFileLookup", "true").parquet(path)


def searched(df: DataFrame, query: str, search: Callable[[list[str], int], list[list[dict]]], topk: int = 3) -> DataFrame:
    """Adds ``hits``, what a search service gives for each query: an array of (title, text, score), empty for null queries.

    search takes a list of queries; it is called in the tasks, once per Arrow batch.
    """
    kind = T.ArrayType(T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType()), T.StructField("score", T.DoubleType())]))

    def run(queries: pd.Series) -> pd.Series:
        asked = [q for q in queries if q]
        found = iter(search(asked, topk) if asked else [])
        return pd.Series([next(found)[:topk] if q else [] for q in queries])

    return df.withColumn("hits", F.pandas_udf(run, kind)(query))


def overlong(df: DataFrame, tokens: str, most: int) -> DataFrame:
    """Rows whose token list has at most ``most`` elements."""
    return df.filter(F.size(tokens) <= most)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``task_type, position, task_id`` of files ``{domain: [task ids]}``; repeats stay."""
    text = spark.read.text(path, wholetext=True)
    return manifest_rows(text, "value")


def manifest_rows(df: DataFrame, column: str) -> DataFrame:
    m = df.select(F.from_json(column, MANIFEST).alias("m"))
    return m.select(F.explode("m").alias("task_type", "ids")).select("task_type", F.posexplode("ids").alias("position", "task_id"))


def _named(spark: SparkSession, root: str, name: str) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return files.select(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("trajectory_id"), F.regexp_extract(path, r"([^/]+)/[^/]+/[^/]+$", 1).alias("parent"), F.col("value"))


def parse_messages(text: Column) -> Column:
    """Messages from JSON; a content that is a text becomes one item of type text, image_url becomes image."""
    raw = F.from_json(text, _RAW_MESSAGES)

    def one(m: Column) -> Column:
        c = m["content"]
        listed = F.from_json(c, T.ArrayType(T.StructType([T.StructField(x, T.StringType()) for x in ("type", "text", "image", "image_url")])))
        full = F.transform(listed, lambda i: F.struct(F.when(i["type"] == "image_url", "image").otherwise(i["type"]).alias("type"), i["text"].alias("text"), F.coalesce(i["image"], i["image_url"]).alias("image")))
        plain = F.array(F.struct(F.lit("text").alias("type"), c.alias("text"), F.lit(None).cast("string").alias("image")))
        return F.struct(m["role"].alias("role"), F.when(c.isNull(), F.lit(None)).when(F.ltrim(c).startswith("["), F.coalesce(full, plain)).otherwise(plain).alias("content"))

    return F.transform(raw, one)


def trajectories(spark: SparkSession, root: str) -> DataFrame:
    """``parent, trajectory_id, config, reward, messages`` of folders that hold a task config; other files may be missing."""
    config = _named(spark, root, "task_config.json").withColumnRenamed("value", "config")
    reward = _named(spark, root, "reward.txt").select("parent", "trajectory_id", F.trim("value").try_cast("double").alias("reward"))
    messages = _named(spark, root, "final_messages.json").select("parent", "trajectory_id", parse_messages(F.col("value")).alias("messages"))
    return config.join(reward, ["parent", "trajectory_id"], "left").join(messages, ["parent", "trajectory_id"], "left")


def trajectory_tree(spark: SparkSession, root: str) -> DataFrame:
    """``run, task, trajectory, reward, n_images`` of a tree run/task/trajectory."""
    # only names of the files are read, and of reward.txt, in a scan of its own, the text
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    keys = lambda path: [F.get(F.split(F.regexp_extract(path, r"([^/]+/[^/]+/[^/]+)/[^/]+$", 1), "/"), F.lit(i)).alias(k) for i, k in enumerate(("run", "task", "trajectory"))]
    images = F.count_if(F.col("path").rlike(r"/image_\d+\.png$"))
    counted = files.groupBy(*keys("path")).agg(images.alias("n_images"))
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "reward.txt").text(root, wholetext=True)
    reward = text.select(*keys(F.col("_metadata.file_path")), F.trim(F.regexp_replace("value", r"\s+$", "")).try_cast("double").alias("reward"))
    return counted.join(reward, ["run", "task", "trajectory"], "left").select("run", "task", "trajectory", "reward", "n_images")


def json_array(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def json_lines(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """JSON lines; broken lines and missing files are left out."""
    bad = "_broken"
    df = spark.read.schema(f"{schema}, {bad} string").option("columnNameOfCorruptRecord", bad).option("mode", "PERMISSIVE").option("ignoreMissingFiles", "true").json(paths)
    return df.filter(F.col(bad).isNull()).drop(bad)


def catalog_run(spark: SparkSession, source: str, run_id: str, **jdbc: str) -> DataFrame:
    """Rows of one run from a Parquet path, or with jdbc options from a table named source; the filter reaches either scan."""
    df = spark.read.format("jdbc").options(dbtable=source, **jdbc).load() if jdbc else spark.read.parquet(source)
    return df.filter(F.col("run_id") == run_id)


def newest_file(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, modificationTime`` of the newest file (contents aren't read)."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "modificationTime")
    return f.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"), F.max("modificationTime").alias("modificationTime"))


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, sha1`` of file contents, for telling changed files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", F.sha1("content").alias("sha1"))


def image_places(df: DataFrame, folder: str, path: str, n: int) -> DataFrame:
    """Of each folder's images, in order of their number: the last one (n = 1) or n equally spaced ones."""
    from tracemill.operators.trajectory import spaced_places

    images = F.array_sort(F.collect_list(F.struct(F.regexp_extract(path, r"image_(\d+)", 1).try_cast("int").alias("no"), F.col(path).alias("path"))))
    g = df.filter(F.col(path).rlike(r"image_\d+\.png$")).groupBy(folder).agg(images.alias("l"))
    return g.select(folder, F.explode(F.transform(spaced_places(F.size("l"), n), lambda i: F.get("l", i))).alias("x")).select(folder, "x.*")


def step_arrays(df: DataFrame, name: str = "file") -> DataFrame:
    """Per-step rows with ``step``, the number at the end of the file's name, for a numeric order."""
    return df.withColumn("step", F.regexp_extract(name, r"(\d+)\.\w+$", 1).try_cast("int"))


def load_batch(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """(rows, meta) as written by ``writers.save_batch``."""
    import json

    meta = "".join(r.value for r in spark.read.text(f"{path}/meta.json").collect())
    return spark.read.parquet(f"{path}/rows"), json.loads(meta)

"""Writers of datasets, samples, reports and metrics."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def dataset(df: DataFrame, folder: str, split: str) -> str:
    path = f"{folder}/{split}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def generations(df: DataFrame, folder: str, step: int, extras: dict[str, Sequence] | None = None) -> None:
    """JSON lines of one step, in a partition of its own; extras of another length than the rows are left out."""
    n = df.count()
    out = df
    for name, values in (extras or {}).items():
        if len(values) == n:
            more = df.sparkSession.createDataFrame(list(enumerate(values)), f"_row long, `{name}` string")
            out = out.join(more, "_row")
    out.withColumn("step", F.lit(step)).write.mode("append").partitionBy("step").json(folder)


def with_responses(prompts: DataFrame, samples: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """Prompts with ``responses``, each one's samples in order."""
    s = F.array_sort(F.collect_list(F.struct(order, text)))
    per = samples.groupBy(key).agg(F.transform(s, lambda x: x[text]).alias("responses"))
    return prompts.join(per, key, "left")


def chunks(df: DataFrame, folder: str) -> DataFrame:
    """Windows as one table of JSON; returns the manifest ``trajectory_id, num_chunks, split_dir`` of what was written.

    One table instead of a folder per trajectory, of which there may be many.
    """
    df.select("trajectory_id", "chunk_index", F.to_json("window").alias("messages")).write.mode("overwrite").json(folder)
    back = df.sparkSession.read.schema("trajectory_id string, chunk_index int, messages string").json(folder)
    return back.filter("messages is not null").groupBy("trajectory_id").agg(F.count("*").cast("int").alias("num_chunks")).withColumn("split_dir", F.lit(folder))


def episodes(df: DataFrame, folder: str) -> None:
    """Episodes as three tables: ``episodes`` (keys, task config, messages), ``rewards`` and ``frames`` (one row per image).

    df: run_id, trajectory_id, config, messages (JSON), reward, frames (array of binary). A run's rows go to a
    partition of their own; a run that is written again replaces its rows.
    """
    keys = ["run_id", "trajectory_id"]

    def put(out: DataFrame, name: str) -> None:
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{folder}/{name}")

    put(df.select(*keys, "config", "messages"), "episodes")
    put(df.select(*keys, "reward").filter("reward is not null"), "rewards")
    put(df.select(*keys, F.posexplode("frames").alias("step", "frame")), "frames")


def report(detail: DataFrame, summary: DataFrame, path: str) -> None:
    """Detail and summary rows as one CSV table; ``row_kind`` tells them apart."""
    both = detail.withColumn("row_kind", F.lit("detail")).unionByName(summary.withColumn("row_kind", F.lit("summary")), allowMissingColumns=True)
    both.write.mode("overwrite").option("header", "true").csv(path)


def regrouped(df: DataFrame, domain: str, task: str, *more: Column | str, name: str = "manifest") -> DataFrame:
    """``more..., name``: pairs as JSON ``{domain: [ids]}``, both in order. A domain's ids are one array."""
    per = df.groupBy(*more, domain).agg(F.array_sort(F.collect_list(task)).alias("ids"))
    entries = F.array_sort(F.collect_list(F.struct(domain, "ids")))
    return per.groupBy(*more).agg(F.to_json(F.map_from_entries(entries)).alias(name))


def metrics_long(values: dict[str, float], step: int, spark: SparkSession) -> DataFrame:
    """``step, key, value`` rows; nested dictionaries are flattened with ``/``."""

    def flat(d: dict, path: str = ""):
        for k, v in d.items():
            name = f"{path}/{k}" if path else str(k)
            yield from flat(v, name) if isinstance(v, dict) else [(name, float(v))]

    return spark.createDataFrame([(step, k, v) for k, v in flat(values)], "step int, key string, value double")


def track(df: DataFrame, folder: str, backends: Sequence[str] = ("parquet", "json", "console")) -> None:
    for b in backends:
        if b == "console":
            for r in df.orderBy("key").collect():  # one step's metrics
                print(f"step:{r.step} - {r.key}:{r.value}")
        else:
            df.write.mode("append").format(b).save(f"{folder}/{b}")


def sample_view(df: DataFrame, n: int, *columns: str) -> list[dict]:
    """The first n rows as dictionaries, for a view of samples."""
    return [json.loads(x) for x in df.select(*columns).orderBy(*columns).limit(n).toJSON().collect()]


def save_batch(df: DataFrame, meta: dict, path: str) -> None:
    """Rows as Parquet and meta as JSON."""
    df.write.mode("overwrite").parquet(f"{path}/rows")
    df.sparkSession.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta.json")

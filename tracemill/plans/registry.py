"""Registry of named queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name; a second registration of a name raises ValueError."""

    def __init__(self) -> None:
        self.runs: dict[str, Run] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Run], Run]:
        def add(run: Run) -> Run:
            if name in self.runs:
                raise ValueError(f"query {name} is already registered")
            self.runs[name] = run
            if sql:
                self.sql[name] = sql
            return run

        return add

    def both(self, name: str, spark_sql: str, duck_sql: str | None = None) -> None:
        """A query that is plain SQL over the tables; duck_sql where the dialects differ."""
        import re

        tables = "region nation customer supplier part orders lineitem events documents embeddings rollout_run trajectory_messages task_config task_manifest monitor_run monitor_seen checkpoint".split()
        used = [t for t in tables if re.search(rf"\b{t}\b", spark_sql)]

        @self.query(name, duck_sql or spark_sql)
        def run(spark: SparkSession, d: str) -> DataFrame:
            text = spark_sql
            for t in used:
                text = re.sub(rf"\b{t}\b(?!\.)", f"{{{t}}}", text)
            return spark.sql(text, **{t: spark.read.parquet(f"{d}/{t}.parquet") for t in used})


CORE = Registry()

"""A folder of Parquet tables with reads, conditional changes and all-or-nothing transactions.

A table is a list of parts, each a folder of Parquet files. Inserted rows are a new part; updates
and deletions write only the parts anew that hold rows to change. Each published version names
the parts of every table; publishing replaces the file ``CURRENT`` in one rename, so readers
see all tables of a transaction or none. Writers must not overlap.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class TableStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.folder).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(self.folder))

    def tables(self) -> dict[str, list[str]]:
        """The folders of each table's parts."""
        p = self._path(f"{self.folder}/CURRENT")
        if not self._fs.exists(p):
            return {}
        return json.loads("\n".join(r.value for r in self.spark.read.text(p.toString()).collect()))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(*self.tables()[name])

    def query(self, text: str, **args) -> DataFrame:
        """SQL over the tables, with bound values (never pasted into the text)."""
        names = self.tables()
        frames = {n: self.spark.read.parquet(*p) for n, p in names.items() if f"{{{n}}}" in text}
        return self.spark.sql(text, args=args or None, **frames)

    def _write(self, name: str, df: DataFrame) -> str:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def transaction(self, changes: Mapping[str, DataFrame | Callable[[DataFrame], DataFrame]]) -> None:
        """Writes all changed tables, then publishes them together. A function gets the present table."""
        fresh = {}
        for name, change in changes.items():
            df = change(self.read(name)) if callable(change) and not isinstance(change, DataFrame) else change
            fresh[name] = [self._write(name, df)]
        self._publish({**self.tables(), **fresh})

    def insert(self, name: str, rows: DataFrame) -> None:
        """Adds the rows as a part of its own; the other parts stay as they are."""
        names = self.tables()
        self._publish({**names, name: [*names.get(name, []), self._write(name, rows)]})

    def _parts_with(self, name: str, where: Column) -> dict[str, int]:
        """Rows that the condition holds for, by part; parts without any are left out."""
        part = F.regexp_extract(F.col("_metadata.file_path"), rf"({re.escape(name)}-[0-9a-f]{{32}})/[^/]+$", 1)
        rows = self.read(name).filter(where).groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
        return {f"{self.folder}/{r.part}": r.n for r in rows}

    def _rewrite(self, name: str, where: Column, change: Callable[[DataFrame], DataFrame]) -> int:
        touched, names = self._parts_with(name, where), self.tables()
        if touched:
            fresh = {p: self._write(name, change(self.spark.read.parquet(p))) for p in touched}
            self._publish({**names, name: [fresh.get(p, p) for p in names[name]]})
        return sum(touched.values())

    def update(self, name: str, where: Column, values: Mapping[str, Column]) -> int:
        """Sets columns where the condition holds; the number of rows it held for. Only parts with such rows are written anew."""
        return self._rewrite(name, where, lambda df: df.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()}))

    def delete(self, name: str, where: Column) -> int:
        """Takes the rows out for which the condition holds, and gives their number."""
        return self._rewrite(name, where, lambda df: df.filter(~F.coalesce(where, F.lit(False))))

    def compact(self, name: str) -> None:
        """One part of all parts."""
        self.transaction({name: lambda df: df})

    def _clean(self, *kept: Mapping[str, list[str]]) -> None:
        """Removes folders of no version in ``kept``."""
        known = {p.rpartition("/")[2] for names in kept for parts in names.values() for p in parts}
        for f in self._fs.listStatus(self._path(self.folder)):
            name = f.getPath().getName()
            if re.fullmatch(r".+-[0-9a-f]{32}", name) and not name.startswith(".") and name not in known:
                self._fs.delete(f.getPath(), True)

    def _publish(self, names: dict[str, list[str]]) -> None:
        """Moves CURRENT to these parts; folders stay that it or the version before it names, for readers under way."""
        before = self.tables()
        tmp = self._path(f"{self.folder}/.CURRENT-{uuid.uuid4().hex}")
        out = self._fs.create(tmp, True)
        out.write(bytearray(json.dumps(names).encode()))
        out.close()
        jvm = self.spark.sparkContext._jvm
        kind = jvm.org.apache.hadoop.fs.Options.Rename
        option = self.spark.sparkContext._gateway.new_array(kind, 1)
        option[0] = kind.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.folder).toUri(), self._conf).rename(tmp, self._path(f"{self.folder}/CURRENT"), option)
        self._clean(names, before)

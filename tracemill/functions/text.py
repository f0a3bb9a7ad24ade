"""Text expressions: hashing of rows, nested flattening, shards, message helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_md5(*columns: str) -> Column:
    """MD5 of the columns as text joined by ``|``, null as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def flatten_columns(df: DataFrame, sep: str = "/") -> DataFrame:
    """Nested structs as columns named by their path."""

    def walk(schema: T.StructType, path: tuple[str, ...]):
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here))

    return df.select(*walk(df.schema, ()))


def md5_shard(key: Column, shards: int) -> Column:
    """The 128-bit MD5 of key modulo shards, exactly: hex digits are folded from the left."""
    digits = F.split(F.md5(key), "")
    return F.aggregate(F.filter(digits, lambda x: x != ""), F.lit(0), lambda s, x: (s * 16 + F.instr(F.lit("0123456789abcdef"), x) - 1) % shards)


def segments(text: Column, keep_empty: bool = False) -> Column:
    """Text split around ``<image>`` and ``<video>``, which stay as segments of their own."""
    parts = F.split(text, r"(?=<image>|<video>)|(?<=<image>)|(?<=<video>)")
    return parts if keep_empty else F.filter(parts, lambda x: x != "")


def rename_image_items(content: Column) -> Column:
    """``image_url`` items become ``image`` items."""
    return F.transform(content, lambda i: F.struct(F.when(i["type"] == "image_url", "image").otherwise(i["type"]).alias("type"), i["text"].alias("text"), i["image"].alias("image")))


def history_text(actions: Column) -> Column:
    """``Step n: action`` lines, numbered from 1."""
    return F.array_join(F.transform(actions, lambda a, i: F.concat(F.lit("Step "), (i + 1).cast("string"), F.lit(": "), a)), "\n")


def merge_maps(left: Column, right: Column) -> Column:
    """Both maps; the right one's values win."""
    return F.map_concat(F.map_filter(left, lambda k, v: ~F.array_contains(F.map_keys(right), k)), right)


def task_kind(task_id: Column, kinds: dict[str, str], default: str) -> Column:
    """Prefix before ``_`` where there is one, else the kind of the first keyword that task_id holds."""
    out = F.when(F.instr(task_id, "_") > 1, F.substring_index(task_id, "_", 1))
    for word, kind in kinds.items():
        out = out.when(F.contains(F.lower(task_id), F.lit(word)), kind)
    return out.otherwise(default)

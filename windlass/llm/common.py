"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windlass.session import scratch_dir, table_path

TABLES = ("documents", "embeddings", "pages", "labels")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


ROWS_PER_FILE = 500_000


def write_table(df: DataFrame, tag: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and reread it.

    Used where two branches read the same derived rows, and to cut lineage in
    loops: the copy is on the shared file system, so a lost executor costs
    nothing but its running tasks. With ``rows``, a bound on the rows of a narrow
    table, it is written by a task per ``ROWS_PER_FILE`` instead of a small file
    per shuffle partition.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "llm", tag)
    if rows is not None:
        df = df.coalesce(math.ceil(rows / ROWS_PER_FILE) + 1)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def width(spark: SparkSession, rows: int, rows_per_partition: int) -> int:
    """Partitions for a keyed exchange: enough that one holds about
    ``rows_per_partition`` rows, and at least the session's shuffle width."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(rows / rows_per_partition), 1)


def whole_text(col: str):
    """The text column as a string, null as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def wrapped(docs: DataFrame, **columns) -> DataFrame:
    """Each row as one struct column ``row`` beside working columns, so that no
    name of the input can clash with them; ``unwrapped`` undoes it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *[c.alias(n) for n, c in columns.items()])


def unwrapped(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


SMALL_SIDE = 50_000


SPREAD = 32


def join_small(rows: DataFrame, few: DataFrame, on: list[str], spread: str | None = None) -> DataFrame:
    """Left join with a table that is expected to be small: its rows are counted,
    and it is broadcast only up to ``SMALL_SIDE`` of them. Beyond, with ``spread`` (a
    column of ``rows``), the rows of one key are dealt to ``SPREAD`` parts by its hash
    and each row of ``few`` goes to all of them, so that no key is one task."""
    few = write_table(few, "small")
    if few.count() <= SMALL_SIDE:
        return rows.join(F.broadcast(few), on, "left")
    if spread is None:
        return rows.join(few, on, "left")
    everywhere = few.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64(spread), F.lit(SPREAD)).cast("int"))
    return dealt.join(everywhere, [*on, "__part"], "left").drop("__part")


def one_row_each(rows: DataFrame, kept: DataFrame, on: list[str]) -> DataFrame:
    """Of ``wrapped`` rows, one for each key of ``kept``."""
    found = rows.join(kept, on, "left_semi")
    first = F.row_number().over(Window.partitionBy(*on).orderBy(F.lit(0)))
    return unwrapped(found.withColumn("nth", first).filter("nth = 1"))


class KnownValues(dict):
    """A worker's table of computed values, bounded in entries and in the length of its keys:
    long keys are computed each time and never held. When it is half full it becomes the
    old generation and a new one begins, so what is used often stays."""

    def __init__(self, compute, entries: int, longest: int = 64) -> None:
        super().__init__()
        self.compute, self.entries, self.longest = compute, entries, longest
        self.old: dict = {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries // 2:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found

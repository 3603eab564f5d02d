"""Words, fresh column names and written tables, shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NON_TOKEN_RUN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Rows of an Arrow batch. Documents are long, so the default of 10,000 would be tens of megabytes.
BATCH_ROWS = 3000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of `df` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else unchanged. Pure ASCII texts take the fast way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def split_words(text: Column, separators: str = SPACE_RUN) -> Column:
    """The maximal runs of other characters than the separators; none for null."""
    return F.coalesce(F.array_remove(F.split(text, separators), ""), F.array().cast("array<string>"))


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with columns that are computed once per row.

    They come out of a generator, through which filters are not pushed. As a plain projection they
    would be written out again wherever a later filter, join or lambda refers to them.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches that Python functions get; texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and go on from the written table: lineage ends here."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow_join(rows: DataFrame, table: DataFrame, on: str, most_bytes: int = 8 << 20) -> DataFrame:
    """Left join by one column, nulls equal to nulls; `table` (one row per value) is broadcast if its measured size is small."""
    there = table.withColumnRenamed(on, fresh(rows, "_on"))
    key = there.columns[table.columns.index(on)]
    size = table.select(F.sum(F.coalesce(F.octet_length(F.col(f"`{on}`").cast("string")), F.lit(0)) + 16 * len(table.columns))).first()[0] or 0
    joined = rows.join(F.broadcast(there) if size <= most_bytes else there, F.col(f"`{on}`").eqNullSafe(F.col(f"`{key}`")), "left")
    return joined.drop(key)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that `scratch_dir` named and that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file; executors need the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)

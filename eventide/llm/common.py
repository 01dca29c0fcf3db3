"""Helpers shared by the operators: table access and tables written to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import checkpoint_root

#: ASCII upper case and its lower case, for ``translate``: other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The bytes \x20 and \x09-\x0D, which separate words.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders that this process has made below the shared folder.
_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names."""
    _made.append(f"{checkpoint_root(spark)}/llm-{uuid.uuid4().hex}")
    return f"{_made[-1]}/{name}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all working tables of this process: results must be written by then, as lazy frames read them."""
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def made() -> int:
    """How many folders this process has made so far."""
    return len(_made)


def discard(spark: SparkSession, since: int) -> None:
    """Delete the working tables made since then, but the last one."""
    gone, _made[since:] = _made[since:-1], _made[since:][-1:]
    for folder in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.

    The lineage ends there: a lost executor costs the tasks it ran, not the job.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table that :func:`saved` wrote, once nothing lazy reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent().getParent()
        if path.getName().startswith("llm-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def lower_ascii(col):
    """A-Z to a-z; every other character as it is."""
    return F.translate(col, UPPER, LOWER)

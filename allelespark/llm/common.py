"""What the operators of this package share: reading, picking columns, tables that cut the lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns, cast; found by exact name, so other columns may have names that differ in case only."""
    names = df.columns
    plain = df.toDF(*(f"_{i}" for i in range(len(names))))
    return plain.select(*(F.col(f"_{names.index(c)}").cast(kind).alias(c) for c, kind in columns.items()))


def set_aside(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(df, back): columns whose names differ from needed ones in case only have other names until back() is called.

    An operator that hands all columns on can then name the needed ones; columns that it adds come after df's.
    """
    names = df.columns
    low = {n.lower() for n in needed}
    safe = [f"_aside_{i}" if n.lower() in low and n not in needed else n for i, n in enumerate(names)]
    old = dict(zip(safe, names, strict=True))
    return df.toDF(*safe), lambda out: out.toDF(*(old.get(c, c) for c in out.columns))


def positional(df: DataFrame, *without: str) -> tuple[DataFrame, list[str]]:
    """df with its columns named c0, c1, ..., and their names; columns called as one of `without` are left out.

    Names that an operator adds then clash with none of df's, whatever they are.
    """
    names = df.columns
    plain = df.toDF(*(f"c{i}" for i in range(len(names))))
    stay = [i for i, name in enumerate(names) if name not in without]
    return plain.select(*(F.col(f"c{i}").alias(f"c{k}") for k, i in enumerate(stay))), [names[i] for i in stay]


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    Only a local session, where driver and tasks share a disk, may do without spark.checkpoint.dir.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    return folder.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts the lineage and outlives an executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove kept() tables that nothing reads any more."""
    for table_ in tables:
        spark = table_.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table_.kept_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: A key with this share of all rows is hot, so this many keys are hot at most; its rows go to SALTS groups.
_HOT, _LEAST, SALTS = 1000, 1024, 64


def spread_join(rows: DataFrame, groups: DataFrame, key: str | Sequence[str], count: str, *by: str) -> DataFrame:
    """rows joined with groups (a kept() table, one row for each key) by `key`, so that no key fills one task.

    `count` is a group's number of rows.  Hot keys are few by definition and broadcast to mark their rows, which a
    hash of the columns `by` deals over salts; a hot key's group is copied to each salt.
    """
    keys = [key] if isinstance(key, str) else list(key)
    total, most = groups.agg(F.coalesce(F.sum(count), F.lit(0)), F.coalesce(F.max(count), F.lit(0))).first()
    least = max(-(-total // _HOT), _LEAST)
    is_hot = F.col(count) >= least
    if most < least:
        return rows.join(groups, keys)
    hot = groups.where(is_hot).select(*(F.col(k).alias(f"_hot_{k}") for k in keys))
    match = F.lit(True)
    for k in keys:
        match &= F.col(k) == F.col(f"_hot_{k}")
    salted = rows.join(F.broadcast(hot), match, "left")
    salted = salted.withColumn("_salt", F.when(F.col(f"_hot_{keys[0]}").isNotNull(), F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")).otherwise(0)).drop(*hot.columns)
    copied = groups.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return salted.join(copied, [*keys, "_salt"]).drop("_salt")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sha(words: Column) -> Column:
    return F.sha2(words, 256)

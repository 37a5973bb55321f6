"""Files in the shared folder that tasks write and other tasks read, through pyarrow's file systems.

Names are unique per attempt and only those that a successful task reports are read, so a lost executor leaves at
most unread files. The folder must be on a file system that pyarrow opens (file, hdfs, s3, gs).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marajo.session import checkpoint_root, remember


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a folder of its own in the shared folder; it is made when the first file is saved. A path without a scheme
    is in the file system that is Hadoop's default, as Spark takes it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/marajo-{name}-{uuid.uuid4().hex}")
    uri = remember(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return uri if "://" in uri else uri.replace("file:", "file://", 1)


def save(root: str, data: bytes, suffix: str = "") -> str:
    """Write a file under ``root`` and return its URI; it has its name only once it is whole."""
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(root)
    store.create_dir(folder, recursive=True)
    name = uuid.uuid4().hex + suffix
    with store.open_output_stream(f"{folder}/.{name}", compression=None) as out:
        out.write(data)
    store.move(f"{folder}/.{name}", f"{folder}/{name}")
    return f"{root.rstrip('/')}/{name}"


def load(uri: str) -> bytes:
    """The bytes of the file at ``uri``."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(path, compression=None) as held:
        return held.read()


def mapped(uri: str):
    """The bytes of the file at ``uri`` as a buffer; of a file system that is mounted they are mapped, so that the workers of a
    machine share them."""
    import pyarrow as pa
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    return pa.py_buffer(load(uri))


#: Bits of a set of values that may be too many to send: eight megabytes, whatever their number.
SET_BITS = 1 << 26


def _bit_of(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(SET_BITS))


def with_bitmap(df: DataFrame, values: DataFrame) -> DataFrame:
    """``df`` with ``_bits``: a bitmap of ``SET_BITS`` of the hashes of ``values`` (one column), the same for every row. It goes to
    every executor; no row of ``df`` is moved."""
    bits = values.select(_bit_of(F.col(values.columns[0])).alias("b"))
    words = bits.groupBy(F.floor(F.col("b") / 64).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("w"))
    every = df.sparkSession.range(SET_BITS // 64).withColumnRenamed("id", "i").join(words, "i", "left")
    one = every.agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("w", F.lit(0).cast("long")).alias("w")))).alias("bits"))
    return df.crossJoin(F.broadcast(one.select(F.col("bits.w").alias("_bits"))))


def maybe(value: Column) -> Column:
    """Whether ``value`` may be among the values of the row's ``_bits``: true if it is, and with a chance of about their number
    over ``SET_BITS`` if it isn't."""
    bit = _bit_of(value)
    return F.getbit(F.get("_bits", F.floor(bit / 64).cast("int")), (bit % 64).cast("int")) == 1


def possibly_in(df: DataFrame, column: str, values: DataFrame, negate: bool = False) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be in that of ``values`` (with ``negate`` those where it can't be), where they lie."""
    told = maybe(F.col(column))
    return with_bitmap(df, values.select(column)).where(~told if negate else told).select(*df.columns)

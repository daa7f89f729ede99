"""Stream readers and table sinks; the format is an argument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.schemas import RAW
from railwatch.sources.staging import path_exists


def read_topics(
    spark: SparkSession, servers: str, topics: Sequence[str], group: str | None = None,
    from_earliest: bool = True, streaming: bool = True,
) -> DataFrame:
    """Several message topics as one stream of ``value, source, partition, seq, ingestMillis``.

    ``seq`` is the offset in the partition; ``ingestMillis`` the message's own timestamp, by which several
    topics have a common order (``TIME_LINE``).  Needs the Kafka connector on the class path.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(topics),
        "startingOffsets": "earliest" if from_earliest or not streaming else "latest",
    }
    if group:
        options["groupIdPrefix"] = group
    return from_messages(reader.options(**options).load())


def from_messages(messages: DataFrame) -> DataFrame:
    """Rows of the columns that a message log has, in the columns of this package."""
    return messages.select(
        F.col("value").cast("string").alias("value"), F.col("topic").alias("source"),
        F.col("partition").cast("int").alias("partition"), F.col("offset").alias("seq"),
        F.unix_millis("timestamp").alias("ingestMillis"),
    )


def read_single_topic(spark: SparkSession, servers: str, topic: str, group: str, from_earliest: bool = True) -> DataFrame:
    """One control topic, e.g. policy updates, under its own consumer group."""
    return read_topics(spark, servers, [topic], f"{group}-{topic}", from_earliest)


def read_raw_stream(
    spark: SparkSession, path: str, file_format: str = "parquet", schema: T.StructType = RAW,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Raw rows from files as they arrive."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """A parquet table as a stream, stored as one file or as a folder of files."""
    reader = spark.readStream.schema(schema)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return reader.parquet(f"{folder}/{name}")
    return reader.option("pathGlobFilter", name).parquet(folder)


def write_topic(json_rows: DataFrame, servers: str, topic: str) -> None:
    """Send JSON rows to a message topic, at least once."""
    json_rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per micro-batch: a repeated batch replaces its own output and adds nothing."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _target(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def remove_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Take back the output of a micro-batch that nothing reads any more."""
    files, folder = _target(spark, f"{path}/batch_id={batch_id}")
    files.delete(folder, True)


def commit_sinks(spark: SparkSession, out: str, job: str, batch_id: int, sinks: dict[str, DataFrame]) -> None:
    """Write the outputs of one micro-batch below ``out``, then the mark that they are whole.

    Readers that follow the marks (:func:`read_committed`) see all outputs of a batch or none.  A repeated batch takes
    its mark back first, so nobody reads a folder while it is replaced.
    """
    files, mark = _target(spark, f"{out}/_commits/{job}/{batch_id}")
    files.delete(mark, False)
    for name, rows in sinks.items():
        write_batch(rows, f"{out}/{name}", batch_id)
    files.create(mark, True).close()


def committed(spark: SparkSession, out: str, job: str) -> list[int]:
    """The batches of a job whose outputs are whole."""
    files, folder = _target(spark, f"{out}/_commits/{job}")
    if not files.exists(folder):
        return []
    return sorted(int(f.getPath().getName()) for f in files.listStatus(folder))


def read_committed(spark: SparkSession, out: str, job: str, name: str, schema: T.StructType) -> DataFrame:
    """One output of a job with its ``batch_id``, of whole batches only."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    paths = [f"{out}/{name}/batch_id={b}" for b in committed(spark, out, job)]
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{out}/{name}").parquet(*paths)


def read_batches(spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    """All micro-batch folders with their ``batch_id``; empty when nothing was written."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).parquet(path)
    return rows if upto is None else rows.where(F.col("batch_id") <= upto)

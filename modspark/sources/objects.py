"""Readers for object events, text objects, media manifests and transcripts."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark import schemas
from modspark.operators.rows import explode_rows
from modspark.scratch import scratch_folder
from modspark.workers import ship_library

FILES_IN_FOLDER = 1_000
FILES_AT_ONCE = 50_000
_NO_ID = "__HIVE_DEFAULT_PARTITION__"


def parse_object_events(df: DataFrame, decode_keys: bool = True) -> DataFrame:
    """One row per record of event documents that carry a ``Records`` array."""
    records = explode_rows(df, [], "Records", "r")
    key = F.col("r.s3.object.key")
    if decode_keys:
        key = F.coalesce(F.try_url_decode(key), key)
    return records.select(
        F.col("r.s3.bucket.name").alias("bucket"),
        key.alias("key"),
        F.col("r.s3.object.size").alias("size"),
        F.col("r.s3.object.eTag").alias("etag"),
        F.col("r.s3.object.sequencer").alias("sequencer"),
        F.col("r.eventTime").alias("event_time"),
    )


def read_object_events(
    spark: SparkSession, path: str, streaming: bool = False, decode_keys: bool = True
) -> DataFrame:
    """Object-created events, every record of every document, from JSON files."""
    reader = spark.readStream if streaming else spark.read
    return parse_object_events(reader.schema(schemas.OBJECT_EVENTS).json(path), decode_keys)


def write_text_objects(df: DataFrame, folder: str, id_col: str, text_col: str) -> list[tuple[str, int]]:
    """One text file for each row, ended by a line break, with ``<id_col>=<id>`` in its path.  Gives the
    folders and how many files each holds, FILES_IN_FOLDER at most.

    On a disk that the machines share, the tasks write the files.  Spark's writer would make a folder for
    each, which a reader lists in a task of its own, and Hadoop starts a process (``chmod``) for every file
    and folder.  A task's files appear with one rename when all are written; what a lost attempt leaves has a
    hidden name that Spark's readers pass over.  Any other store gets Spark's writer.
    """
    spark = df.sparkSession
    root = _shared_disk(spark, folder)
    rows = df.select(F.col(id_col).cast("string").alias(id_col), F.col(text_col).alias("text"))
    if root is None:
        rows.write.partitionBy(id_col).text(folder)
        return [(folder, 0)]
    ship_library(spark)
    files = rows.withColumn("text", F.col("text").cast("binary"))
    written = files.mapInArrow(_write_files(root, id_col), "folder string, n long").collect()
    if not written:
        rows.select("text").limit(0).write.text(folder)
        return [(folder, 0)]
    return sorted((f"{folder}/{r['folder']}", r["n"]) for r in written)


def _shared_disk(spark: SparkSession, folder: str) -> str | None:
    """The path of a folder on a mounted disk; None in any other store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri()
    return place.getPath() if place.getScheme() == "file" else None


def _write_files(root: str, id_col: str):
    def write(batches):
        part = f"part-{TaskContext.get().partitionId():05d}"
        own, n = f"{root}/.{part}-{uuid.uuid4().hex}", 0
        for batch in batches:
            for row_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                at = f"{own}/{n // FILES_IN_FOLDER:05d}"
                if n % FILES_IN_FOLDER == 0:
                    os.makedirs(at)
                name = _NO_ID if row_id is None else quote(row_id, safe="")
                with open(f"{at}/{id_col}={name}-{n:09d}.txt", "wb") as f:
                    if text.is_valid:
                        f.write(text.as_buffer())
                    f.write(b"\n")
                n += 1
        if not n:
            return
        try:
            os.rename(own, f"{root}/{part}")
        except OSError:  # another attempt of this task was faster
            if not os.path.isdir(f"{root}/{part}"):
                raise
        starts = range(0, n, FILES_IN_FOLDER)
        yield pa.RecordBatch.from_pydict({
            "folder": [f"{part}/{s // FILES_IN_FOLDER:05d}" for s in starts],
            "n": [min(FILES_IN_FOLDER, n - s) for s in starts],
        })

    return write


def read_by_folders(
    spark: SparkSession, folders: list[tuple[str, int]], read: Callable[[list[str]], DataFrame]
) -> DataFrame:
    """What ``read`` gives for folders of so many files, kept as a table.  Some folders are read at a
    time, so that the driver never lists more than FILES_AT_ONCE files at once."""
    groups, size = [[]], 0
    for path, n in folders:
        if groups[-1] and size + n > FILES_AT_ONCE:
            groups.append([])
            size = 0
        groups[-1].append(path)
        size += n
    table = scratch_folder(spark, "read")
    # Spark reads some 32 small files in a task, each task would make a file of the table.
    tasks = 4 * spark.sparkContext.defaultParallelism
    for paths in groups:
        rows = read(paths)
        rows.coalesce(tasks).write.mode("append").parquet(table)
    return spark.read.schema(rows.schema).parquet(table)


def read_text_objects(spark: SparkSession, path: str | list[str], compressed: bool = True) -> DataFrame:
    """Whole UTF-8 text files, one row per file; the trailing newline is kept.  Spark gives no row for a
    file without any byte.

    Files named like compressed ones (``.gz``) are unpacked, for which Hadoop sets up its codecs at every
    file.  ``compressed=False`` takes all files as they are, in a fifth of the time.
    """
    if compressed:
        files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
        return files.select(F.col("_metadata.file_path").alias("file_uri"), F.col("value").alias("text"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("_metadata.file_path").alias("file_uri"), F.col("content").cast("string").alias("text"))


def list_media_objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Manifest of media files.  The content column is pruned, so no media byte is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("file_uri"), F.col("length").alias("size"), "modificationTime")
    )


def _transcript_columns() -> list[Column]:
    segments = F.transform(
        F.col("results.toxicity_detection"),
        lambda s: F.struct(
            s["start_time"].alias("start"),
            s["end_time"].alias("end"),
            s["text"].alias("text"),
            s["toxicity"].alias("toxicity"),
            s["categories"].alias("categories"),
        ),
    )
    return [F.col("jobName").alias("job_name"), F.col("status"), segments.alias("segments")]


def parse_transcripts(df: DataFrame, col: str) -> DataFrame:
    """(job_name, status, segments) out of a JSON string column; other columns are kept."""
    keep = [c for c in df.columns if c != col]
    doc = F.from_json(F.col(col), schemas.TRANSCRIPT)
    return (
        df.select(*keep, doc.alias("_doc"))
        .select(*keep, "_doc.*")
        .select(*keep, *_transcript_columns())
    )


def read_transcripts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Transcription result documents, one multi-line JSON document per file."""
    docs = spark.read.schema(schemas.TRANSCRIPT).option("multiLine", True).json(path)
    return docs.select(*_transcript_columns())

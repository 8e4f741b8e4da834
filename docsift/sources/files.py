"""File sources and sinks: document bytes, whole extracted texts, and the
CSV hand-over format with quoted multi-line text."""

from __future__ import annotations

import fnmatch
import math
import re
import zlib
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.text import basename
from docsift.functions.vectors import format_vector_text, parse_vector_text
from docsift.operators.store import DEFAULT_BROADCAST_BYTES, measured
from docsift.session import scratch_path
from docsift.sources.tables import spread

FOLDER_FILES = 1000                     # of one folder of landed texts
LISTED_ROWS = 10_000                    # files of one Arrow batch
BATCH_BYTES = 8 << 20                   # of contents in one Arrow batch, or one file
TASK_BYTES, TASK_FILES = 64 << 20, 20_000   # read by one task
# what a path's URI spells in hex
_NOT_IN_URI = re.compile("[\\x00-\\x20\"#%<>?\\[\\\\\\]^`{|}\\x7f-\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")

CHUNK_CSV_SCHEMA = T.StructType([
    T.StructField("File_Name", T.StringType()),
    T.StructField("SEC_Number", T.StringType()),
    T.StructField("Topic", T.StringType()),
    T.StructField("PDF_Link", T.StringType()),
    T.StructField("Chunk_No", T.IntegerType()),
    T.StructField("Chunk_Content", T.StringType()),
    T.StructField("Number_of_Words", T.IntegerType()),
    T.StructField("Total_Tokens_in_PDF", T.LongType()),
])
# the hand-over of embedded chunks: the vector as text, see functions.vectors.format_vector_text
EMBEDDED_CSV_SCHEMA = T.StructType([*CHUNK_CSV_SCHEMA.fields, T.StructField("Embeddings", T.StringType()),
                                    T.StructField("Embedding_Dimension", T.IntegerType())])

# padding is part of a text, and an empty text is not a missing one (``\\N``)
_CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
                "ignoreTrailingWhiteSpace": "false", "nullValue": "\\N"}


def read_document_bytes(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file: (path, file_name, length, content).  Files are
    listed and read whole by tasks; no driver fetch."""
    df = _read_files(spark, path, glob)
    return df.select("path", basename("path").alias("file_name"), "length", "content")


def read_markdown(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """Whole extracted-text files, one row per file: (path, file_name, text);
    the path is written as a URI."""
    df = _read_files(spark, path, f"*{suffix}" if suffix else None, uri=True)
    return df.select("path", basename("path").alias("file_name"), F.col("content").cast("string").alias("text"))


def file_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder as a task writes to it, and the folder's path there."""
    if local := re.match("(?:file:(?://)?)?(/.*)", path, re.DOTALL):
        return pafs.LocalFileSystem(), local[1]
    return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))    # Hadoop's names of the S3 scheme


def _shown(name: str, glob: str | None) -> bool:
    """Whether Spark's readers see a name: hidden ones are left out, folders too (``glob`` is for files)."""
    if name[:1] == "." or name.endswith("._COPYING_") or (name[:1] == "_" and "=" not in name and not name.startswith(("_metadata", "_common_metadata"))):
        return False
    return glob is None or any(fnmatch.fnmatchcase(name, g) for g in _globs(glob))


def _globs(glob: str) -> list[str]:
    """Hadoop's ``{a,b}`` and ``[^a]`` as plain patterns."""
    if part := re.search(r"\{([^{}]*)\}", glob):
        return [g for x in part[1].split(",") for g in _globs(glob[:part.start()] + x + glob[part.end():])]
    return [glob.replace("[^", "[!")]


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> tuple[DataFrame, int, int]:
    """(path, length) of the files below ``path`` as Spark's readers see them
    (no hidden ones, no empty ones), their number and their bytes.

    Tasks list the folders, level by level, into a table below the shared
    folder: the driver holds no file's name, however many there are.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    found = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(top)
    if not found:
        spark.read.format("binaryFile").load(path)      # raises Spark's own error
    schema = "path string, length long"             # a folder has no length
    level = spark.createDataFrame([(s.getPath().toString(), None if s.isDirectory() else s.getLen()) for s in found
                                   if s.isDirectory() or _shown(s.getPath().getName(), glob)], schema)
    at, levels = scratch_path(spark, "listing"), []

    def run(batches):
        for b in batches:
            for folder in b.column(0).to_pylist():
                store, base = file_store(folder)
                rows = [(folder + x.path[len(base):], x.size if x.is_file else None)
                        for x in store.get_file_info(pafs.FileSelector(base))
                        if _shown(x.base_name, glob if x.is_file else None) and (not x.is_file or x.size)]
                for lo in range(0, len(rows), LISTED_ROWS):
                    paths, sizes = zip(*rows[lo:lo + LISTED_ROWS])
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "length"])

    while True:
        levels.append(f"{at}/level-{len(levels):03d}")
        level.write.parquet(levels[-1])
        folders = spark.read.schema(schema).parquet(levels[-1]).where("length IS NULL").select("path")
        n = folders.count()
        if not n:
            break
        level = folders.repartition(min(n, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(run, schema)
    files = spark.read.schema(schema).parquet(*levels).where("length > 0")
    n, size = files.agg(F.count("length"), F.sum("length")).first()
    return files, n, size or 0


def _read_files(spark: SparkSession, path: str, glob: str | None, uri: bool = False) -> DataFrame:
    """(path, length, content) of the files that :func:`list_files` finds, dealt
    to tasks by their paths."""
    files, n, size = list_files(spark, path, glob)
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])

    def shown(name: str) -> str:
        return _NOT_IN_URI.sub(lambda c: "".join(f"%{x:02X}" for x in c[0].encode("utf-8")), name) if uri else name

    def run(batches):
        rows, held, top = [], 0, None
        for b in batches:
            for name in b.column(0).to_pylist():
                folder, _, own = name.rpartition("/")
                if folder != top:
                    (store, base), top = file_store(folder), folder
                with store.open_input_stream(f"{base}/{own}") as f:
                    content = f.read()
                rows.append((shown(name), len(content), content))
                held += len(content)
                if held >= BATCH_BYTES or len(rows) >= LISTED_ROWS:
                    yield _batch(rows, schema)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    width = max(min(n, spark.sparkContext.defaultParallelism), size // TASK_BYTES, n // TASK_FILES, 1)
    return files.repartition(width, "path").mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=schema.fieldNames())


def write_texts(df: DataFrame, path: str, key: str, text_col: str) -> None:
    """One whole-text file ``<key>=<value>.txt`` per key below ``path``, each
    text ended by a newline; texts of one key follow each other in its file.

    The task that reads a text writes its file straight to the shared folder;
    only rows of a key that comes several times meet in one task first.  A
    key's folder is told by its hash, some ``FOLDER_FILES`` keys a folder: no
    job-end step moves file after file, no reader lists a folder per key, none
    lists a folder that grows with the table, and a task that runs again
    writes the same files again, wherever it runs.
    """
    spark = df.sparkSession
    # a missing key is named as a partition folder of Spark's would be
    named = df.select(F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("name"), F.col(text_col).alias("text"))
    names = named.groupBy("name").count()
    n, most = names.agg(F.count("name"), F.max("count")).first()
    folders = max(1, math.ceil(n / FOLDER_FILES))

    def make(batches):
        for b in batches:
            for i in b.column(0).to_pylist():
                store, base = file_store(f"{path}/part-{i:05d}")
                store.create_dir(base, recursive=True)
            yield b

    def run(batches):
        store, base = file_store(path)
        at, out, n = None, None, 0
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1)):
                if name != at:
                    if out is not None:
                        out.close()
                    file = f"{base}/part-{zlib.crc32(name.encode('utf-8', 'surrogatepass')) % folders:05d}/{key}={quote(name, safe='')}.txt"
                    at, out, n = name, store.open_output_stream(file), n + 1
                out.write((text.as_py() or "").encode("utf-8") + b"\n")
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])

    def write(rows: DataFrame) -> None:
        rows.mapInArrow(run, "files long").agg(F.sum("files")).collect()

    spark.range(folders).mapInArrow(make, "id long").agg(F.count("id")).collect()
    if (most or 0) <= 1:
        write(spread(named))
        return
    several, _, nbytes = measured(names.where("count > 1").select("name"))
    together, width = named, int(spark.conf.get("spark.sql.shuffle.partitions"))
    if nbytes <= DEFAULT_BROADCAST_BYTES:
        write(spread(named).join(F.broadcast(several), "name", "left_anti"))
        together = named.join(F.broadcast(several), "name", "left_semi")
    write(together.repartition(width, "name").sortWithinPartitions("name"))


def write_chunks_csv(df: DataFrame, path: str) -> None:
    """CSV with header, every field quoted, quotes doubled (vector columns
    must be text-encoded first, see functions.vectors.format_vector_text)."""
    df.write.mode("errorifexists").options(**_CSV_OPTIONS).option("quoteAll", "true").csv(path)


def write_embedded_csv(df: DataFrame, path: str) -> None:
    """:func:`write_chunks_csv` of embedded chunks: the vector is printed so
    that it reads back bit by bit."""
    write_chunks_csv(df.withColumn("Embeddings", format_vector_text("Embeddings")), path)


def read_embedded_csv(spark: SparkSession, path: str, schema: T.StructType = EMBEDDED_CSV_SCHEMA) -> DataFrame:
    """Embedded chunks read back, ``Embeddings`` as array<float>."""
    rows = read_chunks_csv(spark, path, schema)
    return rows.withColumn("Embeddings", F.transform(parse_vector_text("Embeddings"), lambda x: x.cast("float")))


def read_chunks_csv(spark: SparkSession, path: str, schema: T.StructType = CHUNK_CSV_SCHEMA) -> DataFrame:
    """Read the CSV back with a declared schema (no inference, so text such
    as a leading-zero form number stays text)."""
    return spark.read.schema(schema).options(**_CSV_OPTIONS).csv(path)

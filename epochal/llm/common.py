"""Helpers that several training-data operators share: working folders, cut lineage, file access."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Working folders of this process, in the order of their making.
MADE: list[str] = []


#: Texts are long: more rows at a time than this would fill a Python worker.
BATCH_ROWS, _BATCH = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package, once for each Spark application, and keep the session's Arrow batches short.

    Functions of the Python stages are then found by name, and what they keep between tasks
    (tables of a tokenizer, memos) is built once in a worker.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_epochal_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="epochal-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._epochal_shipped = True


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, the store that driver and executors share.

    Only in a local session (tests) that has no such setting is one chosen here; elsewhere it is an error,
    as other machines don't see this one's folders.
    """
    ship_package(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="epochal-")
        spark.conf.set("spark.checkpoint.dir", base)
    MADE.append(f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}")
    return MADE[-1]


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    """Remove folders whose tables nobody reads any more."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back, which cuts its lineage."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system that holds ``uri`` (file, hdfs, s3, gs ...) and the path within it."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else f"file://{uri}")


class NewFile:
    """A file that is written under a name of its own attempt and takes its own by ``commit``; opened by its first bytes.

    Two attempts of one task never touch the same bytes, and readers follow a manifest that
    only successful tasks have written, so a lost executor leaves at worst an unread file.
    """

    def __init__(self, uri: str):
        self.uri, self.out = uri, None
        self.fs, self.path = file_system(uri)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"

    @property
    def opened(self) -> bool:
        return self.out is not None

    def write(self, data: bytes) -> None:
        if self.out is None:
            self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
            self.out = self.fs.open_output_stream(self.temporary)
        self.out.write(data)

    def commit(self) -> int:
        """Close and rename; returns the size."""
        self.out.close()
        self.fs.move(self.temporary, self.path)
        return self.fs.get_file_info(self.path).size

    def __enter__(self) -> NewFile:
        return self

    def __exit__(self, *_) -> None:
        if self.out is not None and not self.out.closed:
            self.out.close()


def commit_file(uri: str, write) -> int:
    """A :class:`NewFile` that ``write`` fills; returns its size."""
    with NewFile(uri) as out:
        write(out)
        return out.commit()


def id_remainder(column: str, modulus: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(modulus))


def with_fields(schema: StructType, **kinds: str) -> StructType:
    """A copy of ``schema`` with more fields at its end."""
    return StructType(list(schema.fields) + [StructType.fromDDL(f"`{n}` {k}").fields[0] for n, k in kinds.items()])


def unused(name: str, columns: list[str]) -> str:
    """``name``, or with as many ``_`` behind it as it takes to differ from every column."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name

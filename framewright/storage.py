"""Where intermediate tables and files go: the folder all executors share.

The cluster names that folder in ``spark.checkpoint.dir``.  Only a local master
without the setting (tests) gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; raises on a cluster that names none."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="framewright-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


class Intermediates:
    """The paths that :func:`new_path` gave out in a block."""

    def __init__(self) -> None:
        self.paths: set[str] = set()

    def keep(self, table_: DataFrame) -> None:
        """Keep what a written table reads.  Folders are told apart by their own names, which hold a random
        number: Spark writes the rest of a path (scheme, host, spaces) in its own way."""
        read = {part for f in table_.inputFiles() for part in f.split("/")}
        self.paths = {p for p in self.paths if p.rpartition("/")[2] not in read}


_OPEN: list[Intermediates] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[Intermediates]:
    """Deletes at the end what was written in the block below :func:`new_path` and not kept; for blocks
    whose results are written tables, since whatever is still to be computed needs its intermediates."""
    made = Intermediates()
    _OPEN.append(made)
    try:
        yield made
    finally:
        _OPEN.remove(made)
        hadoop = spark._jsc.hadoopConfiguration()
        for path in made.paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(hadoop).delete(at, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/framewright/{name}-{uuid.uuid4().hex}"
    for made in _OPEN:
        made.paths.add(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends
    there, every later reader sees the same rows, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to executors that cannot import it from a folder of their own."""
    context = spark.sparkContext
    if getattr(context, "_framewright_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="framewright-")) / "framewright.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._framewright_shipped = True


def open_out(uri: str) -> pa.NativeFile:
    """A new file in the shared folder, from any process that mounts or reaches it."""
    files, path = pafs.FileSystem.from_uri(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    return files.open_output_stream(path, compression=None)


def open_in(uri: str) -> pa.NativeFile:
    files, path = pafs.FileSystem.from_uri(uri)
    return files.open_input_file(path)


def file_uri(path: str) -> str:
    return path if "://" in path else "file://" + path.removeprefix("file:")

"""Session defaults and the shared folder for tables that cut a long lineage."""

from __future__ import annotations

import hashlib
import io
import uuid
import zipfile
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from pathlib import Path
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

_chosen_folders: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(master: str | None = None, **conf: object) -> SparkSession:
    builder = SparkSession.builder.appName("estrato")
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def use_shared_folder(spark: SparkSession, path: str) -> None:
    """Choose the shared folder of an application whose session leaves ``spark.checkpoint.dir`` unset."""
    _chosen_folders[spark.sparkContext.applicationId] = path


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else the one chosen for this application.

    Without either it is an error in every mode: no machine-local folder is made up.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or _chosen_folders.get(spark.sparkContext.applicationId)
    if not named:
        raise ValueError("spark.checkpoint.dir is not set; staged tables need a folder shared by all executors")
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/estrato/{app}/{label}-{uuid.uuid4().hex[:12]}"


def run_at_once(spark: SparkSession, works: Sequence[Callable[[], Result]], threads: int) -> list[Result]:
    """The results of works that do not depend on each other, in their order, up to ``threads`` of them at a time.

    Jobs of one work take the cores that the last tasks of another leave idle. Works begin in their order and inherit
    the caller's local properties; after a failure none begins, those under way end, and the failure is raised.
    """
    if threads == 1:
        return [work() for work in works]
    with ThreadPoolExecutor(threads) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(work)) for work in works]
        wait(begun, return_when=FIRST_EXCEPTION)
        for future in begun:
            future.cancel()
    failed = [future for future in begun if not future.cancelled() and future.exception()]
    return [future.result() for future in failed or begun]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and return the written table.

    For a frame that several later branches read: they scan files that survive a lost executor instead of
    repeating the joins above them, and the planner sees the real size.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file through the file system of ``path``; replaces an earlier one."""
    target, files = _file_system(spark, path)
    stream = files.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """One small file as text, None if it is not there; no job."""
    target, files = _file_system(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def switch_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the folder ``fresh`` in the place of ``path``; the old one is deleted after the switch."""
    old = f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:12]}"
    target, files = _file_system(spark, path)
    source, aside = _file_system(spark, fresh)[0], _file_system(spark, old)[0]
    if files.exists(target) and not files.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(source, target):
        raise OSError(f"cannot move {fresh} to {path}")
    files.delete(aside, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; asks the file system only, without a job."""
    target, files = _file_system(spark, path)
    return files.exists(target)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly inside ``path``; files below them are not listed."""
    target, files = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(target) if f.isDirectory())


def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Files directly inside ``path`` that Spark's readers see, by name with their sizes; none if it is not there."""
    target, files = _file_system(spark, path)
    if not files.exists(target):
        return {}
    seen = [f for f in files.listStatus(target) if f.isFile()]
    return {f.getPath().getName(): f.getLen() for f in seen if f.getPath().getName()[0] not in "_."}


def file_bytes(spark: SparkSession, files: set[str]) -> int:
    """Sizes of files named as ``DataFrame.inputFiles`` names them, from one listing of each of their folders."""
    jvm, total = spark.sparkContext._jvm, 0
    wanted: dict[str, set[str]] = {}
    for name in files:
        folder, _, own = name.rpartition("/")
        wanted.setdefault(folder, set()).add(own)
    for folder, names in wanted.items():
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder + "/"))
        system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        total += sum(f.getLen() for f in system.listStatus(target) if f.getPath().getName() in names)
    return total


def drop_staged(spark: SparkSession) -> None:
    """Delete every staged table of this application; call it when the frames that read them are done.

    The shipped package stays: executors may ask for it at any time of the application's life.
    """
    target, files = _file_system(spark, f"{shared_folder(spark)}/estrato/{spark.sparkContext.applicationId}")
    files.delete(target, True)


def _package_archive(package: Path) -> bytes:
    """The sources of ``package`` as a zip archive; the same sources give the same bytes at any time."""
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            entry = zipfile.ZipInfo(str(source.relative_to(package.parent)), date_time=(1980, 1, 1, 0, 0, 0))
            out.writestr(entry, source.read_bytes())
    return archive.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of all executors, once in an application's whole life.

    The sources travel as one archive through the shared folder, beside the staged tables and named by its content,
    so another application's archive of the same name holds the same bytes. Machines that have the package installed
    may use their own copy.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    if not package.is_dir():  # already running from an archive
        return
    content = _package_archive(package)
    name = f"{package.name}-{hashlib.sha256(content).hexdigest()[:16]}.zip"
    path = f"{shared_folder(spark)}/estrato-package/{app}/{name}"
    target, files = _file_system(spark, path)
    stream = files.create(target, True)
    stream.write(bytearray(content))
    stream.close()
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)

"""Versioned state in a shared folder: each version is a folder of its own, and
a small marker file, created only if it doesn't exist, says which folder is
version n. Readers always see a whole version, replacing is one creation, and of
several writers that try the same number one wins and the others take the next.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = "_versions"


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def exists(spark: SparkSession, path: str) -> bool:
    _, fs, at = _file_system(spark, path)
    return fs.exists(at)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of modification) of the files and folders directly under
    ``path``; a listing, nothing is opened."""
    _, fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(folder)]


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text`` unless it exists; whether this
    call created it. Local files are linked into place whole; other file systems
    create without overwriting, which HDFS and object stores do atomically."""
    jvm, fs, at = _file_system(spark, path)
    if fs.getScheme() == "file":
        local = fs.makeQualified(at).toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        whole = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(whole, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(whole, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(whole)
    try:
        out = fs.create(at, False)
    except Exception as e:      # py4j wraps the file system's refusal
        if "AlreadyExists" in str(e):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions under ``root``, ascending."""
    names = [name for name, _ in children(spark, f"{root}/{MARKS}")]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def note(spark: SparkSession, root: str, version: int) -> dict:
    """What the marker of ``version`` says."""
    _, fs, at = _file_system(spark, f"{root}/{MARKS}/{version}.json")
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def latest(spark: SparkSession, root: str) -> tuple[int, dict] | None:
    known = versions(spark, root)
    return (known[-1], note(spark, root, known[-1])) if known else None


def commit(spark: SparkSession, root: str, write: Callable[[str], None], extra: dict | None = None, first_only: bool = False) -> int | None:
    """Have ``write`` fill a new folder under ``root`` and make it the next
    version; its number. A writer that comes second takes the number after.
    With ``first_only`` it gives up (None) once any version exists."""
    folder = f"{root}/data-{uuid.uuid4().hex}"
    write(folder)
    text = json.dumps({"folder": folder} | (extra or {}))
    while True:
        known = versions(spark, root)
        if known and first_only:
            return None
        number = known[-1] + 1 if known else 0
        if create_once(spark, f"{root}/{MARKS}/{number}.json", text):
            return number


def save_table(df: DataFrame, root: str, extra: dict | None = None, first_only: bool = False) -> int | None:
    return commit(df.sparkSession, root, lambda folder: df.write.parquet(folder), extra, first_only)


def read_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one named."""
    if version is None:
        found = latest(spark, root)
        if found is None:
            raise FileNotFoundError(f"no version under {root}")
        return spark.read.parquet(found[1]["folder"])
    return spark.read.parquet(note(spark, root, version)["folder"])


def read_or_create(spark: SparkSession, root: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
    """(the newest version, whether this call created it): a first run stores
    what ``build`` gives, later runs read it. Of two first runs one is stored
    and both read that."""
    created = False
    if latest(spark, root) is None:
        created = save_table(build(), root, first_only=True) is not None
    return read_table(spark, root), created


EPOCH = "_epoch"


def save_epoch(df: DataFrame, root: str, epoch: int) -> bool:
    """Publish ``df`` as what epoch ``epoch`` of a stream changed; whether this
    call did. An epoch that is already published stays as it is, so a replay
    changes nothing; readers see an epoch whole or not at all."""
    spark = df.sparkSession
    mark = f"{root}/{MARKS}/{epoch}.json"
    if exists(spark, mark):
        return False
    folder = f"{root}/data-{uuid.uuid4().hex}"
    df.withColumn(EPOCH, F.lit(epoch).cast("long")).write.parquet(folder)
    return create_once(spark, mark, json.dumps({"folder": folder}))


def _epoch_rows(spark: SparkSession, root: str, key: list[str]) -> tuple[DataFrame, int]:
    """(the newest row of every key with its epoch, the newest epoch): the
    folded table and the epochs published after it."""
    folded = latest(spark, f"{root}/folded")
    through = folded[1]["through"] if folded else -1
    later = [e for e in versions(spark, root) if e > through]
    folders = [note(spark, root, e)["folder"] for e in later] + ([folded[1]["folder"]] if folded else [])
    if not folders:
        raise FileNotFoundError(f"no epoch under {root}")
    rows = spark.read.parquet(*folders)
    rest = [c for c in rows.columns if c not in key]
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), EPOCH).alias("_row"))
    return newest.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest]), max([through, *later])


def read_epochs(spark: SparkSession, root: str, key: list[str]) -> DataFrame:
    """The table the epochs make: of each key the row of its newest epoch."""
    return _epoch_rows(spark, root, key)[0].drop(EPOCH)


def compact_epochs(spark: SparkSession, root: str, key: list[str]) -> int:
    """Fold all published epochs into one table that readers take in their
    place; the last epoch in it. The epochs' folders stay for those who are
    reading them."""
    rows, through = _epoch_rows(spark, root, key)
    save_table(rows, f"{root}/folded", {"through": through})
    return through

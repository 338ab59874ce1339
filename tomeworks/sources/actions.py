"""Moving and copying files as a transaction: df.write.format("file_actions") over (source, dest).

A task stages each file under a name of its own attempt in a hidden job folder, by a hard link for a move where the file system
allows it, and tells the commit its manifest. The commit, which runs once, places the files of the attempts that count
where nothing lies, and only then removes what was moved. What failed or repeated attempts staged goes with the job folder, and an abort changes
nothing. The commit reads one manifest at a time and handles names only; contents are copied by the tasks.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .staging import staged

#: Files that the commit places at once.
AT_ONCE, THREADS = 1024, 16


@dataclass
class Attempt(WriterCommitMessage):
    manifest: str


def local(path: str) -> str:
    """A path of the mounted file system from the form that Spark gives it."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def stage(source: str, part: str, copy: bool) -> None:
    if not copy:
        try:
            os.link(source, part)
            return
        except FileNotFoundError:
            raise
        except OSError:  # another file system, or one without hard links
            pass
    shutil.copy2(source, part)


def place(part: str, dest: str, overwrite: bool) -> bool:
    """Puts a staged file in its place; False where something lies there that is to stay."""
    os.makedirs(os.path.dirname(dest), exist_ok=True)
    try:
        if not overwrite:
            os.link(part, dest)  # fails if there is a file, in one step
            os.remove(part)
            return True
        if os.path.isdir(dest):
            return False
        os.replace(part, dest)
        return True
    except FileExistsError:
        return False
    except OSError:  # another file system, or one without hard links
        if not overwrite:
            try:
                os.close(os.open(dest, os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return False
        near = f"{dest}.{uuid.uuid4().hex}.part"
        shutil.copy2(part, near)
        os.replace(near, dest)
        return True


class FileActionsWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.job = options["job"]
        self.copy, self.overwrite = (options.get(k, "false") == "true" for k in ("copy", "overwrite"))

    def write(self, iterator: Iterator) -> Attempt:
        attempt = os.path.join(self.job, "attempt-" + uuid.uuid4().hex)
        os.makedirs(attempt)
        manifest = attempt + ".jsonl"
        with open(manifest, "w", encoding="utf-8") as out:
            for n, row in enumerate(iterator):
                told = {"source": row["source"], "dest": row["dest"]}
                try:
                    source, dest = local(row["source"]), local(row["dest"])
                    if os.path.abspath(source) == os.path.abspath(dest) or (not self.copy and not os.path.exists(source) and os.path.exists(dest)):
                        told["status"] = "done"  # moved before
                    else:
                        told["part"] = os.path.join(attempt, str(n))
                        stage(source, told["part"], self.copy)
                except (OSError, AttributeError, TypeError) as e:  # a null has no path
                    told["status"] = f"failed: {e}"
                out.write(json.dumps(told) + "\n")
        return Attempt(manifest)

    def _finish(self, line: str) -> str:
        told = json.loads(line)
        if "status" not in told:
            source, dest = local(told["source"]), local(told["dest"])
            try:
                same = not self.copy and os.path.exists(dest) and os.path.exists(source) and os.path.samefile(source, dest)
                if not same and not place(told["part"], dest, self.overwrite):
                    told["status"] = "exists"
                else:
                    if not self.copy and os.path.exists(source):
                        os.remove(source)
                    told["status"] = "done"
            except OSError as e:
                told["status"] = f"failed: {e}"
        told.pop("part", None)
        return json.dumps(told)

    def commit(self, messages: list[Attempt | None]) -> None:
        with ThreadPoolExecutor(THREADS) as pool:
            for n, m in enumerate(x for x in messages if x is not None):
                with open(m.manifest, encoding="utf-8") as lines, open(os.path.join(self.job, f"status-{n}.json"), "w", encoding="utf-8") as out:
                    for some in batched(lines, AT_ONCE):
                        out.writelines(x + "\n" for x in pool.map(self._finish, some))

    def abort(self, messages: list[Attempt | None]) -> None:
        shutil.rmtree(self.job, ignore_errors=True)


class FileActions(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_actions"

    def writer(self, schema: StructType, overwrite: bool) -> FileActionsWriter:
        return FileActionsWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FileActions)


def perform(plan: DataFrame, source: str = "path", dest: str = "dest", copy: bool = False, overwrite: bool = False) -> DataFrame:
    """source, dest, status of each planned action, done at once: done, exists (nothing was replaced), or failed with the reason.

    The plan is written down first, since what it was read from changes. Of rows with one dest one is placed. A move that
    was made before counts as done, so a plan can be repeated. Paths are mounted on the executors and on the driver."""
    spark = plan.sparkSession
    plan = staged(plan.select(F.col(source).alias("source"), F.col(dest).alias("dest")))
    first = plan.where("dest is not null").first()
    if first is None:
        return plan.select(F.col("source").alias(source), F.col("dest").alias(dest), F.lit("failed: no destination").alias("status"))
    job = os.path.join(os.path.dirname(local(first["dest"])), ".tomeworks-" + uuid.uuid4().hex)
    os.makedirs(job)
    register(spark)
    try:
        plan.write.format("file_actions").options(job=job, copy=str(copy).lower(), overwrite=str(overwrite).lower()).mode("append").save()
        told = spark.read.schema("source string, dest string, status string").json(f"file:{job}/status-*.json")
        return staged(told).select(F.col("source").alias(source), F.col("dest").alias(dest), "status")
    finally:
        shutil.rmtree(job, ignore_errors=True)

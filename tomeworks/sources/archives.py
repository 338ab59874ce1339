"""Members of archives as rows: zip, tar, tar.gz, tgz, tar.bz2, tbz, tbz2 (7z needs a library that isn't here)."""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions.text import ARCHIVE, archive_stem, file_name


def inside(name: str) -> str:
    """The member's path below the folder; one that leads out of it is an error."""
    parts = [p for p in name.replace("\\", "/").split("/") if p not in ("", ".")]
    if ".." in parts or name.startswith("/"):
        raise ValueError(f"unsafe member name: {name}")
    return "/".join(parts)


def opened(path: str, content: bytes) -> Iterator[tuple[str, bytes]]:
    """Names and contents of the files in an archive, one at a time."""
    if path.lower().endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for n in z.namelist():
                if not n.endswith("/"):
                    yield n, z.read(n)
    elif path.lower().endswith(".7z"):
        raise ValueError("7z archives aren't supported")
    else:
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            for m in t:
                if m.isfile():
                    yield m.name, t.extractfile(m).read()


def each_member(path: str, content: bytes) -> Iterator[tuple[str | None, str | None, bytes | None, str | None]]:
    """member, its path below the folder, content, error; a broken archive ends with an error."""
    try:
        for name, data in opened(path, content):
            try:
                yield name, inside(name), data, None
            except ValueError as e:
                yield name, None, None, f"{type(e).__name__}: {e}"
    except Exception as e:  # any fault of the file is its own
        yield None, None, None, f"{type(e).__name__}: {e}"


def members(files: DataFrame) -> DataFrame:
    """archive, member, dest, content, error of (path, content) rows that are archives. A broken archive is one row with an error."""
    names = ["archive", "member", "dest", "content", "error"]

    def run(batches):
        for pdf in batches:
            for path, dest, content in zip(pdf["path"], pdf["dest"], pdf["content"], strict=True):
                for name, below, data, error in each_member(path, content):  # one member is held at a time
                    yield pd.DataFrame([(path, name, None if below is None else f"{dest}/{below}", data, error)], columns=names)

    name = file_name(F.col("path"))
    rows = files.where(F.col("path").rlike(ARCHIVE)).select("path", F.concat(F.regexp_replace("path", r"[^/]*$", ""), archive_stem(name)).alias("dest"), "content")
    return rows.mapInPandas(run, "archive string, member string, dest string, content binary, error string")


class ArchiveMembers:
    """archive_members(path, content): the members of one archive, to be joined laterally; analyze says by the arguments whether
    contents are among the columns (they are unless a third argument is false)."""

    @staticmethod
    def analyze(path: AnalyzeArgument, content: AnalyzeArgument, with_content: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not isinstance(path.dataType, StringType) or not isinstance(content.dataType, BinaryType):
            raise ValueError("archive_members takes a path and its content")
        if with_content is not None and not (with_content.isConstantExpression and isinstance(with_content.value, bool)):
            raise ValueError("the third argument is to be true or false")
        schema = StructType().add("member", StringType()).add("below", StringType())
        if with_content is None or with_content.value:
            schema = schema.add("content", BinaryType())
        return AnalyzeResult(schema=schema.add("error", StringType()))

    def eval(self, path: str, content: bytes, with_content: bool = True) -> Iterator[tuple]:
        if path is not None and content is not None and re.search(ARCHIVE, path):
            for member, below, data, error in each_member(path, content):
                yield (member, below, data, error) if with_content else (member, below, error)


def register(spark: SparkSession) -> None:
    """Makes archive_members known to SQL: SELECT ... FROM files, LATERAL archive_members(path, content)."""
    spark.udtf.register("archive_members", F.udtf(ArchiveMembers))


def expand(found: DataFrame) -> DataFrame:
    """archive, member, dest, status: the members written beside their archives, over what is there. A file is put in place by a
    rename, so that a task that is repeated does no harm."""

    def run(batches):
        import os

        for pdf in batches:
            status = []
            for dest, content, error in zip(pdf["dest"], pdf["content"], pdf["error"], strict=True):
                try:
                    if error is not None:
                        status.append(f"failed: {error}")
                        continue
                    path = dest.removeprefix("file:")
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    part = f"{path}.{os.getpid()}.part"
                    with open(part, "wb") as f:
                        f.write(content)
                    os.replace(part, path)
                    status.append("done")
                except OSError as e:
                    status.append(f"failed: {e}")
            yield pdf[["archive", "member", "dest"]].assign(status=status)

    return found.mapInPandas(run, "archive string, member string, dest string, status string")

"""Archive expansion: stored ``.zip`` files -> one row per member.

Spark lists and filters the archives by name before any content is read and
spreads them over tasks; a task opens one archive at a time and hands out its
members in batches of bounded size. The same helper backs a Python table
function. Member keys depend on the archive's whole path and the member, so
archives of one name in two folders do not overwrite each other.
"""

from __future__ import annotations

import hashlib
import io
import os
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from doclake.functions import keys as K
from doclake.functions.keys import CONTENT_TYPES, DEFAULT_CONTENT_TYPE, INCOMING_PREFIX
from doclake.sources.files import stored_key

MEMBER_DDL = ("zip_file string, original_filename string, extension string, content_type string, "
              "new_key string, size long, content binary, error_reason string")


def _member_key(zip_name: str, member: str, ext: str) -> str:
    """Deterministic unique name: a replayed archive gives the same keys."""
    h = hashlib.sha256(f"{zip_name}\x00{member}".encode()).hexdigest()
    return f"{INCOMING_PREFIX}{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}{ext}"


# what opening or reading an archive raises on bad data (a damaged stream, an
# encrypted member, an unknown compression method)
_UNREADABLE = (zipfile.BadZipFile, zlib.error, OSError, ValueError, RuntimeError, NotImplementedError, EOFError)
# members are handed on when they hold this many bytes
_BATCH_BYTES = 16 << 20


def expand_archive(zip_name: str, data: bytes, with_content: bool = True) -> Iterator[tuple]:
    """Members of one archive (directories skipped); a corrupt archive gives one row with an error reason, a member
    that cannot be read keeps its row with the reason and no content."""
    try:
        zf = zipfile.ZipFile(io.BytesIO(data))
    except _UNREADABLE as e:
        yield (zip_name, None, None, None, None, None, None, f"corrupt archive: {e}")
        return
    with zf:
        for info in zf.infolist():
            if info.is_dir():
                continue
            ext = os.path.splitext(info.filename)[1]
            body, reason = None, None
            if with_content:
                try:
                    body = zf.read(info)
                except _UNREADABLE as e:
                    reason = f"unreadable member: {e}"
            yield (zip_name, info.filename, ext, CONTENT_TYPES.get(ext.lower(), DEFAULT_CONTENT_TYPE),
                   _member_key(zip_name, info.filename, ext), info.file_size, body, reason)


def _expand_batches(with_content: bool):
    cols = [c.split()[0] for c in MEMBER_DDL.split(", ")]

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["zip_file"], pdf["content"]):
                rows, held = [], 0
                for row in expand_archive(name, bytes(data), with_content):
                    rows.append(row)
                    held += len(row[6] or b"") + 200
                    if held >= _BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=cols)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=cols)
    return fn


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Stored archives below ``folder`` (the name check ignores case) as (zip_file, content); ``zip_file`` is the
    path below the folder. Files of other names are not opened."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.[zZ][iI][pP]").load(folder))
    return files.select(stored_key(folder).alias("zip_file"), "content")


def archive_members(archives: DataFrame, with_content: bool = True) -> DataFrame:
    """(zip_file, content) rows -> member rows (see ``MEMBER_DDL``)."""
    return archives.select("zip_file", "content").mapInPandas(_expand_batches(with_content), MEMBER_DDL)


def members_per_archive(members: DataFrame) -> DataFrame:
    """Members extracted per archive (corrupt archives and unreadable members count 0)."""
    return members.groupBy("zip_file").agg(F.count(F.when(F.col("error_reason").isNull(), F.col("original_filename")))
                                           .cast("bigint").alias("extracted_count"))


def archive_moves(archives: DataFrame) -> DataFrame:
    """Where each processed archive is moved."""
    return archives.select("zip_file", K.archive_key(F.col("zip_file")).alias("archive_key"))


@udtf(returnType="original_filename string, extension string, content_type string, new_key string, size long")
class ArchiveMembers:
    """Table function form: ``SELECT * FROM archive_members(zip_file, content)``."""

    def eval(self, zip_name: str, content: bytes):
        for row in expand_archive(zip_name, bytes(content), with_content=False):
            if row[7] is None:
                yield row[1], row[2], row[3], row[4], row[5]


def register(spark: SparkSession) -> None:
    spark.udtf.register("archive_members", ArchiveMembers)

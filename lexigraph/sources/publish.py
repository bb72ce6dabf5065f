"""Files that are published together: tasks write them, one rename makes them seen.

publish() writes rows (file, value) as files of these relative names under a folder.  Tasks write into a folder beside it;
the commit puts that folder in the place of the old one, and a write that fails takes it away, so readers see all files of one
write or those of the one before.  A name that two rows have fails the write.  File systems without an atomic rename of folders leave a short gap."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..session import staged


class Written(WriterCommitMessage):
    def __init__(self, files: int):
        self.files = files


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    files, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    return files, path.rstrip("/")


def _beside(folder: str) -> str:
    return f"{folder.rstrip('/')}.{uuid.uuid4().hex}"


def _drop(staging: str) -> None:
    """Takes a staging folder away; it is renamed first, so that tasks that still write find no folder any more."""
    files, staged = _place(staging)
    if files.get_file_info(staged).type == fs.FileType.Directory:
        files.move(staged, f"{staged}.gone")
        files.delete_dir(f"{staged}.gone")


class FolderWriter(DataSourceWriter):
    """Tasks write below a staging folder that is there already and never make it, so that one that goes on after an abort
    leaves nothing."""

    def __init__(self, folder: str, staging: str | None = None):
        self.folder, self.staging = folder, staging or _beside(folder)

    def write(self, iterator: Iterator) -> Written:
        files, base = _place(self.staging)
        made: set[str] = set()
        n = 0
        for row in iterator:
            name, value = row[0], row[1]
            for parent in (f"{base}/{name[:at]}" for at, sign in enumerate(name) if sign == "/"):
                if parent not in made:
                    files.create_dir(parent, recursive=False)
                    made.add(parent)
            with files.open_output_stream(f"{base}/{name}") as out:  # a task that is tried again writes the same file
                out.write(bytes(value))
            n += 1
        return Written(n)

    def commit(self, messages: list[Written | None]) -> None:
        files, staged = _place(self.staging)
        _, target = _place(self.folder)
        files.create_dir(staged, recursive=True)
        old = None
        if files.get_file_info(target).type == fs.FileType.Directory:
            old = f"{staged}.old"
            files.move(target, old)
        files.move(staged, target)
        if old:
            files.delete_dir(old)

    def abort(self, messages: list[Written | None]) -> None:
        _drop(self.staging)


class Folder(DataSource):
    """Rows (file string, value binary) as the files of a folder."""

    @classmethod
    def name(cls) -> str:
        return "published_folder"

    def schema(self) -> str:
        return "file string, value binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return FolderWriter(self.options["folder"], self.options["staging"])


def publish(rows: DataFrame, folder: str) -> None:
    """Rows (file, value) as all the files of a folder; text gets a line's end."""
    value = F.col("value") if dict(rows.dtypes)["value"] == "binary" else F.concat("value", F.lit("\n")).cast("binary")
    # the names are looked at before anything is written, so the rows are worked out once for both
    rows = staged(rows.select("file", value.alias("value")), "published")
    twice = F.count("*").alias("n")
    if rows.groupBy("file").agg(twice).where("n > 1").limit(1).count():
        raise ValueError(f"two rows have one name under {folder}")
    rows.sparkSession.dataSource.register(Folder)
    staging = _beside(folder)
    files, base = _place(staging)
    files.create_dir(base, recursive=True)
    try:
        rows.write.format(Folder.name()).option("folder", folder).option("staging", staging).mode("append").save()
    except BaseException:
        _drop(staging)
        raise

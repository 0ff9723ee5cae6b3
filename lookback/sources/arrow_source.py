"""Arrow IPC ("feather") folders as a Spark data source.

A folder holds data files and a manifest, ``_manifest-{n}.json``: the names of the files
of version n and their schema.  Tasks write files of their own, named by run,
partition and attempt; ``commit``, once per job, puts the next manifest in place by one
rename and only then removes files that the new version doesn't name.  ``abort``
removes the run's files.  So readers see the old output or the new one, whenever
a task, an executor or the driver is lost; files of a lost attempt are named nowhere.
A folder without a manifest is all its ``*.arrow`` files.

Reading gives one partition for each file; with a schema that names some of the columns
only those are decoded.  Rows go from Spark to the file and back in Arrow batches.

Paths are opened by pyarrow's file systems; a scheme that it can't open raises.
"""

from __future__ import annotations

import contextlib
import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

NAME = "lookback_arrow"
_MANIFEST = "_manifest-"
# Python workers get this module's code with the job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_folder(uri: str):
    """(pyarrow file system, path in it) of a qualified path."""
    import pyarrow as pa
    import pyarrow.fs as pafs

    parts = urlsplit(uri)
    if parts.scheme == "file":
        return pafs.LocalFileSystem(), parts.path
    try:
        return pafs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, OSError) as e:
        raise ValueError(f"pyarrow can't open {parts.scheme}:// paths here: {e}") from e


def _names(fs, root: str) -> list[str]:
    import pyarrow.fs as pafs

    return sorted(i.path.rsplit("/", 1)[-1] for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)))


@dataclass
class Version:
    """What a folder holds: the number of its manifest (0 without one), data files, the schema if known."""

    number: int
    files: list[str]
    schema: T.StructType | None


def version(fs, root: str) -> Version:
    names = _names(fs, root)
    manifests = [n for n in names if n.startswith(_MANIFEST) and n.endswith(".json")]
    if not manifests:
        return Version(0, [n for n in names if n.endswith(".arrow")], None)
    with fs.open_input_file(f"{root}/{manifests[-1]}") as f:
        held = json.loads(f.read())
    return Version(held["version"], held["files"], T.StructType.fromJson(held["schema"]))


def folder_schema(fs, root: str) -> T.StructType:
    """The schema of a folder's rows."""
    import pyarrow.ipc as ipc
    from pyspark.sql.pandas.types import from_arrow_schema

    held = version(fs, root)
    if held.schema is not None:
        return held.schema
    if not held.files:
        raise ValueError(f"no Arrow files under {root}")
    with fs.open_input_file(f"{root}/{held.files[0]}") as f:
        return from_arrow_schema(ipc.open_file(f).schema)


@dataclass
class Written(WriterCommitMessage):
    """A task's file."""

    file: str
    rows: int


@dataclass
class FilePart(InputPartition):
    file: str


class ArrowFolder(DataSource):
    """Format ``lookback_arrow``; option ``path``: the folder, with its scheme."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return folder_schema(*open_folder(self.options["path"]))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FolderReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return FolderWriter(self.options["path"], schema, overwrite)


class FolderReader(DataSourceReader):
    def __init__(self, uri: str, schema: T.StructType) -> None:
        self.uri, self.columns = uri, schema.names

    def partitions(self) -> list[FilePart]:
        return [FilePart(f) for f in version(*open_folder(self.uri)).files]

    def read(self, partition: FilePart) -> Iterator:
        import pyarrow.ipc as ipc

        if partition is None or partition.file is None:  # a folder without files is read as one empty partition
            return
        fs, root = open_folder(self.uri)
        with fs.open_input_file(f"{root}/{partition.file}") as f:
            names = ipc.open_file(f).schema.names
            missing = [c for c in self.columns if c not in names]
            if missing:
                raise ValueError(f"{partition.file} has no columns {missing}")
            held = ipc.open_file(f, options=ipc.IpcReadOptions(included_fields=sorted(names.index(c) for c in self.columns)))
            for i in range(held.num_record_batches):
                yield held.get_batch(i).select(self.columns)


class FolderWriter(DataSourceArrowWriter):
    """Writes one version of a folder; ``overwrite`` leaves out the files of the version before."""

    def __init__(self, uri: str, schema: T.StructType, overwrite: bool) -> None:
        self.uri, self.fields, self.overwrite, self.run = uri, schema, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Written:
        import pyarrow.ipc as ipc
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        task = TaskContext.get()
        part = task.partitionId() if task else 0
        fs, root = open_folder(self.uri)
        fs.create_dir(root, recursive=True)
        name, rows, out = f"part-{part:05d}-{self.run}-{uuid.uuid4().hex[:12]}.arrow", 0, None  # each attempt its own
        with fs.open_output_stream(f"{root}/{name}") as stream:
            for batch in iterator:
                out = out or ipc.new_file(stream, batch.schema)
                out.write_batch(batch)
                rows += batch.num_rows
            out = out or ipc.new_file(stream, to_arrow_schema(self.fields))
            out.close()
        return Written(name, rows)

    def commit(self, messages: list) -> None:
        fs, root = open_folder(self.uri)
        fs.create_dir(root, recursive=True)
        old = version(fs, root)
        kept = [] if self.overwrite else [n for n in old.files if self.run not in n]  # without a manifest, all files are old ones
        files = kept + sorted(m.file for m in messages if m is not None)
        text = json.dumps({"version": old.number + 1, "files": files, "schema": self.fields.jsonValue()})
        tmp, final = f"{root}/.manifest-{self.run}", f"{root}/{_MANIFEST}{old.number + 1:010d}.json"
        with fs.open_output_stream(tmp) as f:
            f.write(text.encode())
        self.publish(fs, tmp, final)
        # From here on the new version counts; what it doesn't name may go, and stays unread if this is cut off.
        for name in _names(fs, root):
            gone = name.endswith(".arrow") and name not in files and (name in old.files or self.run in name)
            if gone or (name.startswith(_MANIFEST) and name < final.rsplit("/", 1)[-1]):
                with contextlib.suppress(OSError):
                    fs.delete_file(f"{root}/{name}")

    def publish(self, fs, tmp: str, final: str) -> None:
        fs.move(tmp, final)

    def abort(self, messages: list) -> None:
        fs, root = open_folder(self.uri)
        for name in _names(fs, root):
            if self.run in name:
                with contextlib.suppress(OSError):
                    fs.delete_file(f"{root}/{name}")


def write_folder(df: DataFrame, uri: str, mode: str) -> None:
    """Write ``df`` as the next version of the folder ``uri`` (with its scheme); modes as in ``sinks.MODES``."""
    import pyarrow.fs as pafs

    fs, root = open_folder(uri)
    if mode in ("error", "errorifexists", "ignore") and fs.get_file_info(root).type != pafs.FileType.NotFound:
        if mode == "ignore":
            return
        raise ValueError(f"{uri} exists")
    df.sparkSession.dataSource.register(ArrowFolder)
    df.write.format(NAME).mode("overwrite" if mode == "overwrite" else "append").option("path", uri).save()


def read_folder(spark: SparkSession, uri: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of the folder's newest version; of the columns of ``schema``, if one is given."""
    spark.dataSource.register(ArrowFolder)
    if schema is None:
        schema = folder_schema(*open_folder(uri))
    return spark.read.format(NAME).schema(schema).option("path", uri).load()

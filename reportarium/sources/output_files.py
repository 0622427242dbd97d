"""Report outputs as many small files: written under a commit, and read by their heads only.

``write_outputs`` puts one file per row into a folder of its task. Nothing is moved afterwards:
the driver lists the folders of the tasks that succeeded in one small file at the end, folders of
other attempts go, and a failed job leaves nothing. ``read_heads`` deals the files over tasks, many
to each, and reads of each file only as far as its first records reach, in steps of ``BUFFER``
bytes; texts then stay in their rows. Paths may be of any store that Arrow opens by its URI
(local and shared folders, object stores, HDFS); ``exports.read_outputs`` reads whole files
through Spark's own reader from any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportarium.functions.text import first_digits
from reportarium.operators.samples import SAMPLE_LINES

#: Bytes read of a file at a time, and files read by one task.
BUFFER, FILES = 1 << 14, 1000


def _sources():
    """The two data sources. All they need is nested here, so tasks receive them whole."""
    import csv
    import io
    import json
    import sys
    import uuid

    import pyarrow as pa
    from pyarrow import fs
    from pyspark.sql.datasource import (
        DataSource,
        DataSourceArrowWriter,
        DataSourceReader,
        InputPartition,
        WriterCommitMessage,
    )

    listing = "_files.json"

    def opened(path):
        store, root = fs.FileSystem.from_uri(path)
        return store, root.rstrip("/")

    def parts(store, folder, recursive=False):
        return store.get_file_info(fs.FileSelector(folder, recursive=recursive, allow_not_found=True))

    def committed(store, root):
        """Files of the batches that were committed; without any, all files below."""
        batches = [p.path for p in parts(store, root) if p.base_name.startswith("batch-")]
        if not batches:
            return [p.path for p in parts(store, root, True) if p.type == fs.FileType.File]
        found = []
        for batch in sorted(batches):
            if store.get_file_info(f"{batch}/{listing}").type == fs.FileType.File:
                with store.open_input_stream(f"{batch}/{listing}") as f:
                    for folder in json.loads(f.read()):
                        found += [p.path for p in parts(store, f"{batch}/{folder}")]
        return found

    class Files(InputPartition):
        def __init__(self, paths):
            self.paths = paths

    class HeadReader(DataSourceReader):
        def __init__(self, options):
            self.path = options["path"]
            self.records, self.files = int(options["records"]), int(options["files"])
            self.buffer = int(options["buffer"])

        def partitions(self):
            found = sorted(committed(*opened(self.path)))
            dealt = [Files(found[i : i + self.files]) for i in range(0, len(found), self.files)]
            return dealt or [Files([])]

        def head(self, store, path):
            """Lines up to the end of the header and so many records that are not blank."""
            with store.open_input_file(path) as raw:
                text = io.TextIOWrapper(
                    io.BufferedReader(raw, self.buffer), encoding="utf-8", errors="replace"
                )
                lines = []

                def taken():
                    for line in text:
                        lines.append(line)
                        yield line

                left = self.records + 1
                for record in csv.reader(taken(), delimiter="\t"):
                    left -= bool(record)
                    if not left:
                        break
                return "".join(lines), raw.tell()

        def read(self, partition):
            csv.field_size_limit(sys.maxsize)
            store, _ = opened(self.path)
            names = ["file_path", "text", "bytes_read"]
            rows, held = [], 0
            for path in partition.paths:
                rows.append((path, *self.head(store, path)))
                held += len(rows[-1][1])
                if held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    class Written(WriterCommitMessage):
        def __init__(self, folder):
            self.folder = folder

    class FileWriter(DataSourceArrowWriter):
        def __init__(self, options, overwrite):
            self.path, self.overwrite = options["path"], overwrite
            self.batch = f"batch-{uuid.uuid4().hex}"

        def write(self, iterator):
            store, root = opened(self.path)
            folder = f"task-{uuid.uuid4().hex}"
            store.create_dir(f"{root}/{self.batch}/{folder}", recursive=True)
            for batch in iterator:
                names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for name, text in zip(names, texts):
                    if not name or "/" in name:
                        raise ValueError(f"no name of a file: {name!r}")
                    with store.open_output_stream(f"{root}/{self.batch}/{folder}/{name}") as f:
                        f.write((text or "").encode())
            return Written(folder)

        def commit(self, messages):
            store, root = opened(self.path)
            own = f"{root}/{self.batch}"
            folders = sorted(m.folder for m in messages if m is not None)
            for part in parts(store, own):  # of attempts that did not count
                if part.base_name not in folders:
                    store.delete_dir(part.path)
            store.create_dir(own, recursive=True)
            with store.open_output_stream(f"{own}/{listing}") as f:
                f.write(json.dumps(folders).encode())
            if self.overwrite:
                for part in parts(store, root):
                    if part.base_name.startswith("batch-") and part.path != own:
                        store.delete_dir(part.path)

        def abort(self, messages):
            store, root = opened(self.path)
            if store.get_file_info(f"{root}/{self.batch}").type == fs.FileType.Directory:
                store.delete_dir(f"{root}/{self.batch}")

    class OutputHeads(DataSource):
        @classmethod
        def name(cls):
            return "output_heads"

        def schema(self):
            return "file_path string, text string, bytes_read long"

        def reader(self, schema):
            return HeadReader(dict(self.options))

    class OutputFiles(DataSource):
        @classmethod
        def name(cls):
            return "output_files"

        def schema(self):
            return "name string, text string"

        def writer(self, schema, overwrite):
            return FileWriter(dict(self.options), overwrite)

    return OutputHeads, OutputFiles


def _registered(spark: SparkSession) -> None:
    for source in _sources():
        spark.dataSource.register(source)


def write_outputs(outputs: DataFrame, path: str, mode: str = "append") -> None:
    """One file per row (name, text); rows without a name fail the job, which then leaves nothing."""
    _registered(outputs.sparkSession)
    rows = outputs.select(F.col("name").cast("string"), F.col("text").cast("string"))
    rows.write.format("output_files").mode(mode).save(path)


def read_heads(
    spark: SparkSession, path: str, records: int = SAMPLE_LINES, files: int = FILES
) -> DataFrame:
    """``file_path``, ``document_id`` (first digits of the file name), ``text``, ``bytes_read``.

    The text ends with the header's and that many further records' lines; line ends are single
    newlines. A quote that is never closed makes its record, and so the text, last to the end.
    """
    _registered(spark)
    heads = (
        spark.read.format("output_heads")
        .options(records=records, files=files, buffer=BUFFER)
        .load(path)
    )
    name = F.substring_index("file_path", "/", -1)
    return heads.select("file_path", first_digits(name).alias("document_id"), "text", "bytes_read")

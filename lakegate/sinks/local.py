"""Partitioned Parquet on a local disk, without a process per file and folder.

Hadoop sets permissions there by starting ``chmod``, once a folder and up to three times a file, which for
a table of many small partitions takes longer than all else. Tasks write the same files themselves.
"""

from __future__ import annotations

import os
import re
import shutil
from collections.abc import Callable, Iterator, Sequence
from typing import TYPE_CHECKING
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import pyarrow

#: Rows of a text column that a task holds at a time.
BATCH_ROWS = 256
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# What Spark does not leave as it is in the name of a partition's folder.
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def local_folder(path: str, default: str) -> str | None:
    """The folder a path names on a local disk, with the default file system's URI; None elsewhere."""
    root = re.sub(r"\Afile:(//(?=/))?", "", path)
    if re.match("/(?!/)", root) and (root != path or default.startswith("file:")):
        return root.rstrip("/") or None
    return None


def append_partitions(rows: DataFrame, layout: Sequence[str], folder: str, plain: Sequence[str] = ()) -> None:
    """Append ``rows`` below ``folder``, a file per partition and task; ``plain`` columns get no dictionary.

    The ``layout`` columns are text. As with Spark's own writer, files are seen once all tasks are
    done: they are written in a hidden folder and then moved. A task that runs again writes the same files.
    """
    write, spark = uuid4().hex, rows.sparkSession
    draft = os.path.join(folder, f"_temporary-{write}")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    os.makedirs(draft)
    try:
        spark.conf.set(name, str(BATCH_ROWS))
        put = _writer(list(layout), draft, write, list(plain))
        written = rows.sortWithinPartitions(*layout).mapInArrow(put, "files bigint")
        files = written.agg(F.coalesce(F.sum("files"), F.lit(0)).alias("files")).first().files
        # What a broken task left open stays behind.
        found = [(place, n) for place, _, names in os.walk(draft) for n in names if n.startswith("part-")]
        if len(found) < files:
            raise FileNotFoundError(f"{files - len(found)} files of the tasks are not below {draft}")
        for place, each in found:
            target = os.path.join(folder, os.path.relpath(place, draft))
            os.makedirs(target, exist_ok=True)
            os.replace(os.path.join(place, each), os.path.join(target, each))
        with open(os.path.join(folder, "_SUCCESS"), "wb"):
            pass
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
        shutil.rmtree(draft, ignore_errors=True)


def _writer(
    layout: list[str], draft: str, write: str, plain: list[str]
) -> Callable[[Iterator[pyarrow.RecordBatch]], Iterator[pyarrow.RecordBatch]]:
    # Workers may not know this package: what a task uses is carried with it.
    escaped, no_value = _ESCAPED, NO_VALUE

    def named(column: str, value: str | None) -> str:
        """The folder of a partition, as Spark names it."""
        return f"{column}={escaped.sub(lambda c: f'%{ord(c[0]):02X}', value) if value else no_value}"

    def put(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
        import pyarrow
        import pyarrow.parquet
        from pyspark import TaskContext

        context = TaskContext.get()
        file_name = f"part-{context.partitionId():05d}-{write}.snappy.parquet"
        key, out, draft_path, files = None, None, "", 0

        def close() -> None:
            if out is not None:
                out.close()
                os.replace(draft_path, os.path.join(os.path.dirname(draft_path), file_name))

        for batch in batches:
            keys = list(zip(*(batch.column(name).to_pylist() for name in layout), strict=True))
            data = pyarrow.Table.from_batches([batch]).drop_columns(layout)
            start = 0
            while start < len(keys):
                end = start + 1
                while end < len(keys) and keys[end] == keys[start]:
                    end += 1
                if out is None or keys[start] != key:
                    close()
                    key, files = keys[start], files + 1
                    place = os.path.join(draft, *map(named, layout, key))
                    os.makedirs(place, exist_ok=True)
                    draft_path = os.path.join(place, f".{file_name}.{context.taskAttemptId()}")
                    dictionary = [c for c in data.column_names if c not in plain]
                    out = pyarrow.parquet.ParquetWriter(
                        draft_path, data.schema, compression="snappy", use_dictionary=dictionary,
                        write_page_checksum=True, store_schema=False,
                    )
                out.write_table(data.slice(start, end - start))
                start = end
        close()
        yield pyarrow.RecordBatch.from_pydict({"files": pyarrow.array([files], pyarrow.int64())})

    return put

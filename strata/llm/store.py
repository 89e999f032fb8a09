"""Files that tasks write to and map from shared storage, and tables that cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from strata.session import scratch_dir


def file_system(path: str):
    """pyarrow file system and path of a URI or local path."""
    from pyarrow import fs

    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    return fs.FileSystem.from_uri(path)


@contextmanager
def placed(path: str):
    """An output stream whose file appears under its name only when it is whole: written beside it, then moved. A repeated or speculative
    task that writes the same content leaves one whole file; what a failed one has written is removed."""
    from pyarrow import fs

    store, where = file_system(path)
    store.create_dir(os.path.dirname(where), recursive=True)
    part = f"{where}.{uuid.uuid4().hex}"
    try:
        with store.open_output_stream(part) as out:
            yield out
    except BaseException:
        store.delete_file(part)
        raise
    if store.get_file_info(where).type != fs.FileType.NotFound and not isinstance(store, fs.LocalFileSystem):
        store.delete_file(where)
    store.move(part, where)


@contextmanager
def mapped(path: str, dtype):
    """A file memory-mapped as an array. A file in a remote store is copied to the task's own folder first and the copy
    removed afterwards."""
    from pyarrow import fs

    store, where = file_system(path)
    if isinstance(store, fs.LocalFileSystem):
        yield np.memmap(where, dtype=dtype, mode="r") if os.path.getsize(where) else np.zeros(0, dtype)
        return
    with tempfile.NamedTemporaryFile() as copy:
        with store.open_input_stream(where) as source:
            while block := source.read(1 << 20):
                copy.write(block)
        copy.flush()
        yield np.memmap(copy.name, dtype=dtype, mode="r") if copy.tell() else np.zeros(0, dtype)


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to a new folder of the shared workspace and read again: later jobs neither compute it again nor
    depend on what an executor holds."""
    spark: SparkSession = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

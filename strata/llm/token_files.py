"""Token-ID files: flat unsigned integers plus 64-bit document offsets, memory-mapped.

A file set (one per shard) is ``shard-00007.bin`` (the ids of its documents in a row, unsigned 16-bit if the vocabulary
allows, else 32-bit, little-endian), ``shard-00007.idx`` (unsigned 64-bit: for each document where it starts in the file,
then the file's length, counted in ids) and ``shard-00007.doc`` (its doc_ids as an Arrow file). Shards hold ranges of
ascending doc_id, so shard order is document order; where a shard starts in the whole is the sum of the ids in all
shards before it, a prefix sum over one row per shard. Files are moved into place when whole, and what a shard holds depends
on the input only, so a repeated task writes the same.
"""

from __future__ import annotations

import zlib
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from strata.llm import bpe, store
from strata.llm.texts import text_batches

#: UTF-8 bytes of text encoded at a time.
BATCH_BYTES = 4 << 20
#: UTF-8 bytes of text that a shard holds at most, about.
SHARD_BYTES = 512 << 20


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int, shards: int | None = None) -> DataFrame:
    """Encodes every text with the tokenizers library (distinct words once per batch), appends ``end_id`` and writes the
    shards under ``folder``. Documents are in ascending doc_id order, null ids first, rows of the same id by text. A null
    text is empty. Returns the manifest: one row per shard (shard, n_docs, n_ids, wide, start); an empty table gives
    none. Columns other than doc_id and text are not read. There are as many shards as shuffle partitions, more if the text would make
    them larger than ``SHARD_BYTES``; a task writes its files as it encodes, a batch at a time."""
    spark = docs.sparkSession
    if shards is None:
        n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // SHARD_BYTES))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    rows = rows.repartitionByRange(shards, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")

    def run(batches):
        encoder = bpe.encoder(tokenizer, by_library=True)
        wide = len(encoder.merges.bytes_of) > 1 << 16 or end_id >= 1 << 16
        end = np.array([end_id], "<u4")
        at = f"{folder}/shard-{TaskContext.get().partitionId():06d}"
        n_docs = n_ids = 0
        with ExitStack() as files:
            for part, texts in text_batches(batches, "text", BATCH_BYTES):
                if not n_docs:
                    ids_file, places_file, names_file = (files.enter_context(store.placed(f"{at}.{kind}")) for kind in ("bin", "idx", "doc"))
                    names = files.enter_context(pa.ipc.new_file(names_file, pa.schema([("doc_id", part.column(0).type)])))
                    places_file.write(np.zeros(1, "<u8").tobytes())
                own = [np.append(np.frombuffer(x, "<u4"), end) for x in encoder.encode_batch(texts)]
                places = n_ids + np.cumsum([len(x) for x in own])
                ids_file.write(np.concatenate(own).astype("<u4" if wide else "<u2").tobytes())
                places_file.write(places.astype("<u8").tobytes())
                names.write_batch(pa.RecordBatch.from_arrays([part.column(0)], names=["doc_id"]))
                n_docs, n_ids = n_docs + len(own), int(places[-1])
        if n_docs:
            yield pa.RecordBatch.from_pylist([{"shard": TaskContext.get().partitionId(), "n_docs": n_docs, "n_ids": n_ids, "wide": wide}],
                                             schema=pa.schema({"shard": pa.int64(), "n_docs": pa.int64(), "n_ids": pa.int64(), "wide": pa.bool_()}))

    done = store.kept(rows.mapInArrow(run, "shard long, n_docs long, n_ids long, wide boolean"), "token_manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return done.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def id_type(manifest: DataFrame, folder: str) -> str:
    """The Spark type of the doc_ids, as the files of the first shard tell it."""
    from pyspark.sql.pandas.types import from_arrow_type

    row = manifest.first()
    if row is None:
        return "long"
    fs, where = store.file_system(f"{folder}/shard-{row.shard:06d}.doc")
    with fs.open_input_file(where) as source:
        return from_arrow_type(pa.ipc.open_file(source).schema.field(0).type).simpleString()


def read(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of the files, from memory maps: doc_id, start (ids of all documents before it), n_tokens and ids_crc32
    (of the ids as little-endian unsigned 32-bit integers). One task per shard maps its files; no shuffle of ids."""
    count = max(1, manifest.count())

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at = f"{folder}/shard-{row['shard']:06d}"
                fs, where = store.file_system(f"{at}.doc")
                with fs.open_input_file(where) as source:
                    names = pa.ipc.open_file(source).read_all().column(0)
                with store.mapped(f"{at}.bin", "<u4" if row["wide"] else "<u2") as ids, store.mapped(f"{at}.idx", "<u8") as places:
                    places = np.asarray(places).astype(np.int64)
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(places, places[1:])]
                yield pa.RecordBatch.from_arrays(
                    [names.combine_chunks() if names.num_chunks != 1 else names.chunk(0), pa.array(row["start"] + places[:-1], pa.int64()),
                     pa.array(np.diff(places), pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (manifest.repartitionByRange(count, "shard")
            .mapInArrow(run, f"doc_id {id_type(manifest, folder)}, start long, n_tokens long, ids_crc32 long"))

"""Tokens per document from flat token files, by a scan for the end-of-document id.

The files hold nothing but ids. They are looked at in blocks, by tasks that seek to a run of blocks:
within a block a vectorised search finds the ends, and a prefix scan, within each run and then over
the runs, carries the length of the document that is still open from one block into the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.llm.files import Published, located
from ledgertag.llm.storage import column, stage, text_slices
from ledgertag.llm.tokens import BYTE_BPE, byte_ids

END = 50256
KIND = "<u2"
# Ids in a block, and in a file of ``write_flat`` at most, but for one long document.
BLOCK = 1 << 18
# Blocks that a task reads one after the other (32 MB), and runs for a task if there are very many.
RUN = 64
TASK_RUNS = 32
FILE_IDS = 4 << 20


def write_flat(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end: int = END, file_ids: int = FILE_IDS
) -> DataFrame:
    """Write ids of all texts and an end id after each, two bytes an id, to ``folder``.

    When the result is computed, the files are written. It has a row for each document: ``doc_id``,
    ``file`` and ``number``, its place among the documents of that file. Null text is empty. Keep
    the result in a table: computing it again writes other files.
    """
    path = tokenizer or public_tokenizers.path(BYTE_BPE)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("file", T.StringType()),
        T.StructField("number", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = byte_ids(path).encode, np.array([end], KIND).tobytes()
        target, written, number = None, 0, 0
        for batch in text_slices(batches, "text"):
            files, numbers = [], []
            for text in column(batch, "text").to_pylist():
                if target is None:
                    name = f"{uuid.uuid4().hex}.ids"
                    target, written, number = Published(folder, name), 0, 0
                data = encode(text or "") + last
                target.write(data)
                files.append(name)
                numbers.append(number)
                written, number = written + len(data), number + 1
                if written >= 2 * file_ids:
                    target.close()
                    target = None
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(files), pa.array(numbers)], names=schema.names
            )
        if target is not None:
            target.close()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _runs(spark: SparkSession, folder: str, width: int, block: int, run: int) -> DataFrame:
    """``file``, ``run`` and the file's ``length`` in bytes; a run is ``run`` blocks in a row.

    Names and lengths come from a listing, so no content is read here. Runs are dealt out evenly.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    size = run * block * width
    files = listed.where("length > 0").select(
        name.alias("file"), "length", F.floor((F.col("length") - 1) / size).alias("last")
    )
    count = files.agg(F.sum(F.col("last") + 1)).first()[0] or 0
    tasks = max(1, min(count, max(spark.sparkContext.defaultParallelism, -(-count // TASK_RUNS))))
    number = F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("run")
    return files.select("file", number, "length").repartition(tasks)


def _blocks(runs: DataFrame, folder: str, end: int, kind: str, block: int, run: int) -> DataFrame:
    """A row for each block, read at its place in the file.

    ``ends``, ids before the first end (``head``; all, if none) and after the last (``tail``), and
    lengths between ends (``inner``). ``done`` counts the ends that come before in the run, ``open``
    the ids since the last of them or since the run began.
    """
    numbers = ["run", "block", "done", "open", "ends", "head", "tail"]
    schema = T.StructType([
        T.StructField("file", T.StringType()),
        *(T.StructField(name, T.LongType()) for name in numbers),
        T.StructField("inner", T.ArrayType(T.LongType())),
    ])
    width = np.dtype(kind).itemsize

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = located(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if row["length"] % width:
                    raise ValueError(f"{row['file']} does not hold whole ids")
                done = since = 0
                with system.open_input_file(f"{path}/{row['file']}") as file:
                    file.seek(row["run"] * run * block * width)
                    for k in range(run):
                        own = np.frombuffer(file.read(block * width), kind)
                        if not len(own):
                            break
                        at = np.flatnonzero(own == end)
                        head = int(at[0]) if len(at) else len(own)
                        tail = len(own) - 1 - int(at[-1]) if len(at) else len(own)
                        found = (row["run"], k, done, since, len(at), head, tail)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([row["file"]]),
                                *(pa.array([x], pa.int64()) for x in found),
                                pa.array([np.diff(at) - 1], pa.list_(pa.int64())),
                            ],
                            names=schema.names,
                        )
                        done += len(at)
                        since = tail if len(at) else since + tail

    return runs.mapInArrow(scan, schema)


def token_counts(
    spark: SparkSession,
    folder: str,
    end: int = END,
    kind: str = KIND,
    block: int = BLOCK,
    run: int = RUN,
) -> DataFrame:
    """``file``, ``number``, ``n_tokens`` (without the end id) and ``ended`` of each document.

    Ids after the last end of a file are a document that has not ended; a file that stops right
    after an end has none, and an empty file has no documents. ``kind`` is the type of an id. Files
    may have any length: tasks seek to runs of ``run`` blocks and read them block by block, and
    what is scanned over a file in one task is a row of a few numbers for each run. A file that
    ends within an id raises.
    """
    runs = _runs(spark, folder, np.dtype(kind).itemsize, block, run)
    blocks = stage(_blocks(runs, folder, end, kind, block, run), "blocks")
    ended = F.col("ends") > 0
    # The ids before the first end of a run and after its last one; all of them if it has none.
    whole = blocks.groupBy("file", "run").agg(
        F.sum("ends").alias("ends"),
        F.max_by(F.when(ended, F.col("tail")).otherwise(F.col("open") + F.col("tail")), "block").alias("tail"),
    )
    order = W.partitionBy("file").orderBy("run")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    # Runs since the last one that has an end; their tails add up to what is open at a run.
    seen = whole.withColumns({
        "before": F.coalesce(F.sum("ends").over(before), F.lit(0)),
        "lap": F.coalesce(F.sum(ended.cast("int")).over(before), F.lit(0)),
        "last": F.lead("run").over(order).isNull(),
        # A lap begins after a run with an end, so its first run inherits that run's tail.
        "tail_before": F.coalesce(F.lag("tail").over(order), F.lit(0)),
    })
    within = W.partitionBy("file", "lap").orderBy("run").rowsBetween(W.unboundedPreceding, 0)
    carried = seen.withColumn("carry", F.sum("tail_before").over(within))
    placed = blocks.where(ended).join(carried.select("file", "run", "before", "carry"), ["file", "run"])
    start = F.col("before") + F.col("done")
    # What is open from earlier runs belongs to the first end of this one.
    first = F.col("open") + F.col("head") + F.when(F.col("done") == 0, F.col("carry")).otherwise(0)
    lengths = F.concat(F.array(first), "inner")
    closed = placed.select("file", start.alias("start"), F.posexplode(lengths).alias("k", "n_tokens"))
    left = F.when(ended, F.col("tail")).otherwise(F.col("carry") + F.col("tail"))
    rest = carried.where("last").select(
        "file",
        (F.col("before") + F.col("ends")).alias("number"),
        left.alias("n_tokens"),
        F.lit(False).alias("ended"),
    )
    return closed.select(
        "file", (F.col("start") + F.col("k")).alias("number"), "n_tokens", F.lit(True).alias("ended")
    ).unionByName(rest.where("n_tokens > 0"))

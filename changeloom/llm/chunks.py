"""Documents in written chunks, and rows that meet them by chunk.

An operator that asks something of the whole corpus for every line or token of a document asks once per chunk: a chunk
is one row, a compressed run of documents that lay together, so what it asks is combined before any shuffle, and a line
or token that is everywhere is asked once a chunk. The answers come back to the chunk in ``met``: both sides are dealt by
chunk and sorted, and a task reads them as a stream, answers first, and holds those of one chunk at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import small_batches, stored

CHUNK = 4 << 20  # bytes of text after which a chunk ends; a longer document is a chunk of its own
# Options of Parquet for rows that are large and compressed: the size of a row group is looked at after each row.
SMALL_GROUPS = {"parquet.block.size": 4 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1, "compression": "uncompressed"}


def packed(batch: pa.RecordBatch | pa.Table) -> bytes:
    """Rows as compressed bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write(batch)
    return sink.getvalue().to_pybytes()


def unpacked(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def runs(batches: Iterator[pa.RecordBatch], text: int, size: int) -> Iterator[pa.Table]:
    """Tables of consecutive rows whose texts (column number ``text``) have about ``size`` bytes together."""
    held, there = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = 0
        for row, length in enumerate(lengths):
            if there and there + length > size:
                held.append(batch.slice(start, row - start))
                yield pa.Table.from_batches(held)
                held, there, start = [], 0, row
            there += length
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def chunked(
    docs: DataFrame, purpose: str, make: Callable[[], Callable[[pa.Table], list]] | None = None, size: int = CHUNK, bodies: tuple[str, ...] = ("body",), step: str | None = None
) -> DataFrame:
    """``docs`` (two columns, the second a text) as a written table (chunk, body).

    ``make`` is called in every task and gives the function that turns the rows of a chunk into the tables kept in its
    ``bodies``. With ``step`` a chunk has several rows, numbered from 0 in a column of that name: the function gives a list
    of tables, or None, for each. Such a table is written in small row groups, since a reader holds a row group's bodies.
    """
    small_batches(docs.sparkSession, rows=1000, mb=8)

    def run(batches):
        change = make() if make else None
        for rows in runs(batches, 1, size):
            made = change(rows) if change else [rows.combine_chunks()]
            for at, tables in enumerate(made if step else [made]):
                columns = [pa.array([None if table is None else packed(table)], pa.binary()) for table in tables]
                names = list(bodies)
                if step:
                    columns, names = [*columns, pa.array([at], pa.int32())], [*names, step]
                yield pa.RecordBatch.from_arrays(columns, names)

    ddl = ", ".join(f"{name} binary" for name in bodies)
    if not step:
        return stored(docs.mapInArrow(run, ddl).withColumn("chunk", F.monotonically_increasing_id()), purpose)
    # rows of a task are numbered in order, so that the first of a chunk gives it its number
    number = F.monotonically_increasing_id() - F.col(step)
    return stored(docs.mapInArrow(run, f"{ddl}, {step} int").withColumn("chunk", number), purpose, **SMALL_GROUPS)


def met(chunks: DataFrame, answers: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, key: str = "chunk") -> DataFrame:
    """``mapInArrow`` of ``run`` over the rows of both tables, by key and then by part: answers are part 0, chunks part 1.

    Both have the columns of ``answers``; those that a chunk lacks are null. Further columns of ``answers`` sort its rows.
    """
    both = answers.withColumn("part", F.lit(0)).unionByName(chunks.withColumn("part", F.lit(1)), allowMissingColumns=True)
    order = [key, "part", *[c for c in answers.columns if c not in (key, "body")]]
    return both.repartition(key).sortWithinPartitions(*order).select(key, "part", *[c for c in both.columns if c not in (key, "part")]).mapInArrow(run, schema)

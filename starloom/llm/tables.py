"""What the operators share: tables, folds and work on whole texts in batches."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Characters of text that one step in a Python worker takes at once, beyond a single text.
STEP_CHARS = 1_000_000
#: Bytes of an Arrow batch on its way to a Python worker, about, beyond a single row.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows that a task reads from Parquet at once.
READ_ROWS = 512
_READ_SETTING = "spark.sql.parquet.columnarReaderBatchSize"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    folder = Path(tempfile.mkdtemp(prefix="starloom-code-"))
    archive = shutil.make_archive(str(folder / package.name), "zip", package.parent, package.name)
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by their bytes, and what is read at once by its rows, from now on in
    this session, unless it has bounds of its own.

    By rows alone, 10,000 long texts are one batch, which lies in the JVM and twice in the worker;
    4,096 of them read at once are one array, which grows by copies to twice the size.
    """
    for setting, value in ((_BATCH_SETTING, BATCH_BYTES), (_READ_SETTING, READ_ROWS)):
        if spark.conf.get(setting, None) is None:
            spark.conf.set(setting, str(value))


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(run: Work) -> Work:
    """``run``, after which a task gives the memory it has freed back to the system.

    Workers live on from task to task, and the allocator would keep for the next one what
    the largest step has taken, beside all that the JVM takes meanwhile.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return work


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts


def is_fold(id_col: Column, parts: int, number: int) -> Column:
    """Whether a row is of one fold. A NULL id is of none."""
    return F.coalesce(fold(id_col, parts) == number, F.lit(False))


def leading(n: Column, bits: int) -> Column:
    """A number that grows with a positive count as far as its leading bits tell counts apart."""
    over = F.greatest(F.length(F.bin(n)) - bits, F.lit(0))
    return over * (1 << bits) + F.floor(n / F.pow(F.lit(2.0), over)).cast("long")


def frequent(counted: DataFrame, most: int, key: str, n: str = "n") -> Column:
    """Whether a row's count is among the largest ones, which about ``most`` rows have.

    Rows are counted by the ten leading bits of their counts, and these groups are taken
    from the top on while they fit; of the first that does not, the rows whose key's
    hash is low, a twentieth fewer than fit. So no task and not the driver sorts or
    gathers candidates of every partition.
    """
    group = leading(F.col(n), 10)
    sizes = counted.groupBy(group.alias("group")).agg(F.count(F.lit(1)).alias("rows")).collect()
    room = most
    for row in sorted(sizes, key=lambda r: -r["group"]):
        if row["rows"] > room:
            share = int(0.95 * room / row["rows"] * (1 << 30))
            low = F.pmod(F.xxhash64(F.lit("frequent"), key), F.lit(1 << 30)) < share
            return (group > row["group"]) | ((group == row["group"]) & low)
        room -= row["rows"]
    return F.lit(True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def steps(
    batch: pa.RecordBatch, most: int = STEP_CHARS, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``most`` characters, or one text."""
    size = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, done + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts, empty where NULL."""
    return [t or "" for t in batch.column(text).to_pylist()]


def map_texts(
    docs: DataFrame,
    make: Callable[[], Callable[[list[str]], list]],
    added: str,
    keep: list[str],
    text_col: str = "text",
) -> DataFrame:
    """Columns made of each text, next to the columns in ``keep``, row for row.

    ``make`` runs once per task and gives a function
    from texts to a list of columns, in the order of ``added``. Kept columns pass
    through Arrow as they are, so large ids and NULL ids stay what they were.
    """
    ship(docs.sparkSession)
    kept = T.StructType([docs.schema[c] for c in keep])
    extra = T.StructType.fromDDL(added)
    types = [f.type for f in to_arrow_schema(extra)]
    names = [*keep, *extra.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns_of = make()
        for batch in batches:
            for part in steps(batch, text="__text"):
                columns = [pa.array(c, t) for c, t in zip(columns_of(texts_of(part, "__text")), types)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *columns], names)

    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    return rows.mapInArrow(tidy(run), T.StructType([*kept, *extra]))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text only, under these names."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

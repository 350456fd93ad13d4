"""Whitening of embeddings through distributed block matrices.

Vectors become whole numbers, ``floor(64 * c) + 1000000`` of each entry, whose sums
are exact. Every task cuts its rows into blocks of ``BLOCK_ROWS``; a block's number
and a row's place in it are the row's index. The centred blocks form a ``BlockMatrix``.
Its transpose times itself is the scatter; the middle dimension, which grows with the
data, is multiplied in splits of bounded size. The scatter's eigenvectors (dimensions
squared, on the driver) give the whitening matrix, and a second block multiplication
projects the rows. For that one the blocks are laid out in a square grid, the k-th
column of blocks meeting the whitening matrix at the k-th place of a block diagonal:
the engine spreads a grid by the roots of both sides, so a column of blocks alone
would come back in the root of the tasks it went out from.

Rows without vector, or with NULL or non-finite entries, take no part; nor do empty
vectors and those of another length than most (of equally frequent lengths, the
shortest counts). Equal vectors, equal ids and NULL ids are rows of their own.
Components whose eigenvalue is zero up to rounding cannot be scaled to variance one
and are left out, so equal vectors alone give no rows, as does an empty table. Numbers
beyond 64 bits raise an overflow. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from starloom.llm.tables import ship
from starloom.session import stage

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
BLOCK_ROWS, BLOCK_COLS = 1024, 1024
#: Blocks that one task multiplies for the scatter.
BLOCKS_PER_SPLIT = 64

_MATRIX = MatrixUDT()
_BLOCKS = T.StructType(
    [
        T.StructField("at", T.StructType().add("row", "long").add("col", "long")),
        T.StructField("block", _MATRIX),
    ]
)
RESULT = {
    "vec_id": "long",
    "component": "int",
    "n": "long",
    "deviation": "long",
    "whitened": "double",
    "explained": "double",
    "identity_error": "double",
}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


@dataclass
class Whitening:
    """What is fitted: rows, their sums, the projection, each component's share of variance."""

    n: int
    sums: np.ndarray
    matrix: np.ndarray
    explained: np.ndarray


def whole_numbers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``x`` of the rows that take part, whatever their lengths."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    used = rows.where(F.coalesce(finite & (F.size(vector) > 0), F.lit(False)))
    x = F.transform(vector, lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return used.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def _lists(column: pa.ListArray, kind=np.int64) -> list[np.ndarray]:
    flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b].astype(kind, copy=False) for a, b in zip(offsets, offsets[1:])]


def _square(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and sums per vector length, one row for each length a task has met."""
    found: dict[int, list] = {}
    for batch in batches:
        sizes = batch.column("x").value_lengths().to_numpy()
        for dim in np.unique(sizes):
            x = _square(batch.column("x").filter(pa.array(sizes == dim)))
            n, sums = found.get(int(dim), (0, 0))
            found[int(dim)] = [n + len(x), sums + x.sum(0)]
    columns = [list(found), [n for n, _ in found.values()], [s.tolist() for _, s in found.values()]]
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["dim", "n", "sums"])


def sums_of(numbers: DataFrame) -> tuple[int, np.ndarray]:
    """How many vectors there are of the most frequent length, and their sums, exactly."""
    parts = stage(numbers.mapInArrow(_sums, "dim int, n long, sums array<long>"), "sums")
    top = parts.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dim").first()
    if top is None:
        return 0, np.zeros(0, np.int64)
    each = parts.where(F.col("dim") == top["dim"]).select(F.posexplode("sums").alias("at", "sum"))
    sums = each.groupBy("at").agg(F.sum("sum").alias("sum")).orderBy("at").collect()
    return top["n"], np.array([r["sum"] for r in sums], np.int64)


def _deviation(n: int, sums: np.ndarray) -> Column:
    """Sum over the dimensions of ``(n * x - S) ** 2``, exact or an overflow."""
    centre = F.array(*[F.lit(int(s)) for s in sums]) if len(sums) <= 4096 else F.from_json(F.lit(str(sums.tolist())), "array<long>")
    apart = F.zip_with("x", centre, lambda x, s: (x * F.lit(n) - s) * (x * F.lit(n) - s))
    return F.aggregate(apart, F.lit(0).cast("long"), lambda a, b: a + b)


_STORED = {"part": "int", "number": "int", "ids": "array<long>", "deviations": "array<long>", "x": "array<long>"}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows in blocks, each block's numbers column after column."""
    part, number, names = TaskContext.get().partitionId(), 0, list(_STORED)
    held: list[pa.RecordBatch] = []

    def block(rows: pa.Table) -> pa.RecordBatch:
        x = _square(rows.column("x").combine_chunks()).T.ravel()
        lists = [pa.array([rows.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("vec_id", "deviation")]
        x_list = pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), *lists, x_list], names)

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < BLOCK_ROWS:
            continue
        rows = pa.Table.from_batches(held)
        full = len(rows) // BLOCK_ROWS * BLOCK_ROWS
        for at in range(0, full, BLOCK_ROWS):
            yield block(rows.slice(at, BLOCK_ROWS))
            number += 1
        held = rows.slice(full).to_batches()
    rest = pa.Table.from_batches(held) if held else None
    if rest is not None and len(rest):
        yield block(rest)


def index_blocks(numbers: DataFrame, n: int, sums: np.ndarray) -> tuple[DataFrame, int]:
    """Rows of the fit list in numbered blocks, and how many numbers there are."""
    ship(numbers.sparkSession)
    fit = numbers.where(F.size("x") == len(sums)).withColumn("deviation", _deviation(n, sums))
    stored = stage(fit.mapInArrow(_cut, _ddl(_STORED)), "blocks")
    top = stored.agg(F.max("part").alias("part"), F.max("number").alias("number")).first()
    width, parts = top["number"] + 1, top["part"] + 1
    if width * parts >= 1 << 31:
        raise ValueError("more blocks than a block matrix can number")
    return stored.withColumn("b", F.col("part") * width + F.col("number")), width * parts


def _matrices(blocks: DataFrame, n: int, sums: np.ndarray, place: Callable[[int, int], tuple[int, int]]) -> DataFrame:
    """Centred blocks, cut by columns too, at the places given for block and column cut."""
    dim, cuts = len(sums), range(0, len(sums), BLOCK_COLS)
    kinds = [to_arrow_type(f.dataType) for f in _BLOCKS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, x in zip(batch.column("b").to_pylist(), _lists(batch.column("x"))):
                centred = (x.reshape(dim, -1) * n - sums[:, None]) / n
                for j, at in enumerate(cuts):
                    row, col = place(b, j)
                    part = centred[at : at + BLOCK_COLS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([{"row": row, "col": col}], kinds[0]), _dense(part.T, kinds[1])], _BLOCKS.names
                    )

    return blocks.select("b", "x").mapInArrow(run, _BLOCKS)


def _dense(matrix: np.ndarray, kind: pa.DataType) -> pa.StructArray:
    """One dense matrix, column after column, as Spark stores it."""
    values = matrix.T.ravel()
    parts = {
        "type": pa.array([1], pa.int8()),
        "numRows": pa.array([matrix.shape[0]], pa.int32()),
        "numCols": pa.array([matrix.shape[1]], pa.int32()),
        "values": pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.float64())),
        "isTransposed": pa.array([False]),
    }
    columns = [parts[f.name].cast(f.type) if f.name in parts else pa.nulls(1, f.type) for f in kind]
    return pa.StructArray.from_arrays(columns, fields=list(kind))


def _block_matrix(blocks: DataFrame, rows: int, cols: int, n_rows: int, n_cols: int) -> BlockMatrix:
    # the frame goes to the JVM as it is; BlockMatrix(rdd) would pickle every number
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, rows, cols, n_rows, n_cols), rows, cols)


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """Product with the middle dimension in ``splits``, which the Python method does not offer."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def fit(blocks: DataFrame, n_blocks: int, n: int, sums: np.ndarray, most: int = COMPONENTS) -> Whitening:
    """Scatter of the centred rows, its eigenvectors, and the matrix that whitens."""
    dim = len(sums)
    # blocks that end a task's rows are shorter; products only need the halves to agree
    x = _block_matrix(
        _matrices(blocks, n, sums, lambda b, j: (b, j)), BLOCK_ROWS, min(dim, BLOCK_COLS), n_blocks * BLOCK_ROWS, dim
    )
    scatter = _times(x.transpose(), x, math.ceil(n_blocks / BLOCKS_PER_SPLIT)).toLocalMatrix().toArray()
    values, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    order = np.argsort(-values, kind="stable")
    above = values > max(values.max(), 0) * dim * np.finfo(float).eps
    order = order[above[order]][:most]
    scale = np.sqrt(values[order])
    return Whitening(n, sums, vectors[:, order] / scale, values[order] / max(values.sum(), np.finfo(float).tiny))


def project(blocks: DataFrame, n_blocks: int, model: Whitening) -> DataFrame:
    """Blocks with their rows' ids, deviations and whitened values, stored."""
    spark, (dim, k) = blocks.sparkSession, model.matrix.shape
    side, cuts = math.isqrt(n_blocks - 1) + 1, math.ceil(dim / BLOCK_COLS)
    cols = min(dim, BLOCK_COLS)
    tall = -(-n_blocks // side)
    x = _block_matrix(
        _matrices(blocks, model.n, model.sums, lambda b, j: (b // side, b % side * cuts + j)),
        BLOCK_ROWS,
        cols,
        tall * BLOCK_ROWS,
        side * cuts * cols,
    )
    pieces = [model.matrix[at : at + cols] for at in range(0, dim, cols)]
    diagonal = spark.sparkContext.parallelize(range(side), min(side, spark.sparkContext.defaultParallelism)).flatMap(
        lambda c: [((c * cuts + j, c), DenseMatrix(*p.shape, p.T.ravel())) for j, p in enumerate(pieces)]
    )
    w = BlockMatrix(diagonal, cols, k, side * cuts * cols, side * k)
    found = callMLlibFunc("getMatrixBlocks", _times(x, w, 1)._java_matrix_wrapper._java_model).toDF("at", "block")
    numbered = found.select((F.col("at._1") * side + F.col("at._2")).cast("int").alias("b"), "block")
    kind = pa.list_(pa.float64())

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block")
            block = block.storage if isinstance(block, pa.ExtensionArray) else block
            yield pa.RecordBatch.from_arrays([batch.column("b"), block.field("values").cast(kind)], ["b", "y"])

    plain = numbered.mapInArrow(values, "b int, y array<double>")
    return stage(plain.join(blocks.select("b", "ids", "deviations"), "b"), "projected")


def _grams(k: int, mean: np.ndarray | None):
    """Sums of a task's projected rows, or their products once the means are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k if mean is None else k * k)
        for batch in batches:
            for y in _lists(batch.column("y"), np.float64):
                y = y.reshape(k, -1)
                if mean is None:
                    total += y.sum(1)
                else:
                    y = y - mean[:, None]
                    total += (y @ y.T).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    return run


def identity_error(projected: DataFrame, n: int, k: int) -> float:
    """Largest entry of the projected rows' covariance minus the identity."""

    def summed(mean: np.ndarray | None) -> np.ndarray:
        parts = projected.select("y").mapInArrow(_grams(k, mean), "sums array<double>")
        each = parts.select(F.posexplode("sums").alias("at", "sum")).groupBy("at").agg(F.sum("sum").alias("sum"))
        return np.array([r["sum"] for r in each.orderBy("at").collect()])

    covariance = summed(summed(None) / n).reshape(k, k) / n
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Every row's whitened components, largest variance first (see ``RESULT``)."""
    spark = rows.sparkSession
    ship(spark)
    numbers = whole_numbers(rows, id_col, vector_col)
    n, sums = sums_of(numbers)
    if not n:
        return spark.createDataFrame([], _ddl(RESULT))
    blocks, n_blocks = index_blocks(numbers, n, sums)
    model = fit(blocks, n_blocks, n, sums, most)
    k = model.matrix.shape[1]
    if not k:
        return spark.createDataFrame([], _ddl(RESULT))
    projected = project(blocks, n_blocks, model)
    error, explained = identity_error(projected, n, k), model.explained

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, deviations, y in zip(batch.column("ids"), batch.column("deviations"), _lists(batch.column("y"), np.float64)):
                m = len(y) // k
                each = [pa.array(np.repeat(np.arange(m), k))]
                columns = [
                    ids.values.take(each[0]),
                    np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    np.full(m * k, n, np.int64),
                    deviations.values.take(each[0]),
                    y.reshape(k, m).T.ravel(),
                    np.tile(explained, m),
                    np.full(m * k, error),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], list(RESULT))

    return projected.select("ids", "deviations", "y").mapInArrow(out, _ddl(RESULT))

"""Dense linear algebra over row tables.

Rows stay distributed; a small matrix (size set by features / pixels / landmarks, never by
the row count) is broadcast once and applied to Arrow batches with numpy inside
``mapInPandas``. Sums over rows (X^T X, X^T Y) are per-partition partial matrices, cut into
packed tiles that a tree of two shuffles adds element by element, so the shuffle is partitions x
tiles rows, independent of the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from quillspark.session import ship_package


def _stack(series: pd.Series, width: int | None = None) -> np.ndarray:
    vals = list(series)
    if not vals:
        return np.zeros((0, width or 0))
    return np.stack([np.asarray(v, dtype=float) for v in vals])


# Matrices held by the driver or broadcast: 64 M cells are 512 MB. Their size follows features,
# pixels or landmarks, so a wider table is an error that says so, not a lost driver.
MAX_CELLS = 1 << 26


def check_cells(shape: Sequence[int], what: str) -> None:
    cells = int(np.prod([int(s) for s in shape]))
    if cells > MAX_CELLS:
        raise ValueError(f"{what} of shape {tuple(shape)} is over {MAX_CELLS} cells")


def broadcast_matrix(spark: SparkSession, m: np.ndarray):
    m = np.ascontiguousarray(np.asarray(m, dtype=float))
    check_cells(m.shape, "a broadcast matrix")
    ship_package(spark)
    return spark.sparkContext.broadcast(m)


def map_rows(df: DataFrame, fn: Callable[[np.ndarray], np.ndarray], x_col: str = "x", out_col: str = "y",
             keep: Sequence[str] | None = None) -> DataFrame:
    """``fn`` applied to the rows of ``x_col`` a batch at a time, as a matrix (rows x d) that it
    turns into one of as many rows; NULL x stays NULL. Kept columns pass through untouched."""
    keep = [c for c in (keep if keep is not None else df.columns) if c != out_col]
    ship_package(df.sparkSession)
    schema = StructType([df.schema[c] for c in keep] + [StructField(out_col, ArrayType(DoubleType()))])
    src = df.select(*keep, F.col(x_col).cast("array<double>").alias("__x"))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            column = b.column(len(keep))
            there = column.is_valid().to_numpy(zero_copy_only=False)
            y = fn(column_matrix(column.filter(pa.array(there)))) if there.any() else np.zeros((0, 0))
            offsets = np.concatenate(([0], np.cumsum(there * y.shape[1]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(~there, False)), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], lists], names=[*keep, out_col])

    return src.mapInArrow(run, schema)


#: Rows that a function of rows is given at a time where what it makes of them is not kept.
BLOCK_ROWS = 2048


def row_blocks(rows: int) -> Iterator[slice]:
    return (slice(at, at + BLOCK_ROWS) for at in range(0, rows, BLOCK_ROWS))


def project_rows(df: DataFrame, m: np.ndarray, x_col: str = "x", out_col: str = "y",
                 keep: Sequence[str] | None = None) -> DataFrame:
    """Row x matrix: ``out = x @ m`` for every row (m is d x k); NULL x stays NULL."""
    bm = broadcast_matrix(df.sparkSession, m)
    return map_rows(df, lambda x: x @ bm.value, x_col, out_col, keep)


def column_matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column without null rows as a matrix; NULL elements become NaN."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError(f"rows of {sizes.min()} to {sizes.max()} values where all should be equally long")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(float, copy=False).reshape(len(sizes), -1)


def list_column(m: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow list column, without a Python object a row."""
    offsets = np.arange(len(m) + 1, dtype=np.int32) * np.int32(m.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(m).ravel()))


# ---- packed sums ------------------------------------------------------------------------------
# Partials added by one task of the first level of the tree.
FAN_IN = 64


def add_packed(partials: DataFrame, keys: Sequence[str], packed: str,
               merge: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.add, tasks: int | None = None) -> DataFrame:
    """Sum of the ``packed`` arrays (array<double>) of each key, element by element, or what
    ``merge`` makes of two of them.

    A partial is one shuffled row whatever its length. Partials are added in a tree of two
    levels, FAN_IN input partitions a key first, so no task adds those of all partitions; a task
    reads them one by one and holds one sum a key. ``keys``: integer columns. ``tasks``: the
    partitions of ``partials``, given by a caller that adds up to FAN_IN rows a key itself
    (``collect_packed``): levels that it needs not are left out.
    """
    if tasks is not None and tasks <= FAN_IN:
        return partials.select(*keys, packed)
    ship_package(partials.sparkSession)
    keys = list(keys)
    fields = [partials.schema[k] for k in keys] + [partials.schema[packed]]
    schema = StructType(fields)

    def add(batches):
        sums: dict[tuple, np.ndarray] = {}
        for b in batches:
            lists = b.column(len(keys))
            flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy()
            stop = np.cumsum(sizes)
            for key, i, j in zip(zip(*(b.column(k).to_pylist() for k in range(len(keys)))), stop - sizes, stop):
                sums[key] = merge(sums[key], flat[i:j]) if key in sums else flat[i:j].astype(float)
        for key, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()) for k in key] + [pa.array([total])],
                                             names=[*keys, packed])

    level = partials.withColumn("_salt", F.floor(F.spark_partition_id() / F.lit(FAN_IN)))
    level = level.repartition(*keys, "_salt").select(*keys, packed).mapInArrow(add, schema)
    if tasks is not None and tasks <= FAN_IN * FAN_IN:
        return level
    return level.repartition(*keys).mapInArrow(add, schema)


def collect_packed(sums: DataFrame) -> dict[tuple[int, ...], np.ndarray]:
    """key -> packed array at the driver, of a table whose last column is packed; rows of a key are
    added in the order of their partitions. They come by Arrow, not as a Python object a value."""
    found: dict[tuple[int, ...], np.ndarray] = {}
    for b in sums.toArrow().to_batches():
        lists = b.column(b.num_columns - 1)
        flat, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        stop = np.cumsum(sizes)
        for key, i, j in zip(zip(*(c.to_pylist() for c in b.columns[:-1])), stop - sizes, stop):
            found[key] = found[key] + flat[i:j] if key in found else flat[i:j].copy()
    return found


# ---- products of rows ---------------------------------------------------------------------------
# Rows and columns of a tile of X^T Y; a tile is one packed row (32 KB).
TILE = 64
TILES = StructType([StructField("ti", IntegerType()), StructField("tj", IntegerType()),
                    StructField("width", IntegerType()), StructField("tile", ArrayType(DoubleType()))])


def product_tiles(df: DataFrame, x_col: str, y_col: str | None = None,
                  fn: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(ti, tj, width, tile): X^T Y (or X^T X, tiles on and above the diagonal only) of the rows
    whose arrays are not NULL, as packed tiles of TILE x TILE cells in row order. ``fn`` turns
    blocks of X into the rows that are multiplied, in the same tasks."""
    cols = [x_col] if y_col is None else [x_col, y_col]
    ship_package(df.sparkSession)
    there = F.lit(True)
    for c in cols:
        there = there & F.col(c).isNotNull()
    src = df.where(there).select(*[F.col(c).cast("array<double>").alias(f"m{i}") for i, c in enumerate(cols)])

    def run(batches):
        acc = None
        for b in batches:
            if not b.num_rows:
                continue
            x = column_matrix(b.column(0))
            y = x if y_col is None else column_matrix(b.column(1))
            for s in ([slice(None)] if fn is None else row_blocks(len(x))):
                left = x[s] if fn is None else fn(x[s])
                part = left.T @ (left if y_col is None else y[s])
                acc = part if acc is None else acc + part
        if acc is not None:
            yield from packed_tiles(acc, y_col is None)

    return add_tiles(src.mapInArrow(run, TILES))


def packed_tiles(m: np.ndarray, upper: bool = False) -> Iterator[pa.RecordBatch]:
    """The tiles of a task's partial matrix (``upper``: on and above the diagonal), a row each."""
    for i in range(0, m.shape[0], TILE):
        for j in range(i if upper else 0, m.shape[1], TILE):
            tile = m[i:i + TILE, j:j + TILE]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i // TILE], pa.int32()), pa.array([j // TILE], pa.int32()),
                 pa.array([tile.shape[1]], pa.int32()), pa.array([tile.ravel()])],
                names=["ti", "tj", "width", "tile"])


def add_tiles(partials: DataFrame) -> DataFrame:
    return add_packed(partials, ["ti", "tj", "width"], "tile")


def gram_matrix(df: DataFrame, x_col: str = "x") -> DataFrame:
    """(i, j, g) = X^T X, both triangles; only tiles on and above the diagonal are summed."""
    cells = _cells(product_tiles(df, x_col))
    both = F.when(F.col("ti") == F.col("tj"), F.array(F.struct("i", "j"))) \
        .otherwise(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return cells.select(F.explode(both).alias("c"), "g").select("c.i", "c.j", "g")


def cross_product(df: DataFrame, x_col: str = "x", y_col: str = "y") -> DataFrame:
    """(i, j, g) = X^T Y for two array columns of the same rows."""
    return _cells(product_tiles(df, x_col, y_col)).select("i", "j", "g")


def _cells(tiles: DataFrame) -> DataFrame:
    long = tiles.select("ti", "tj", "width", F.posexplode("tile").alias("pos", "g"))
    return long.select("ti", "tj", (F.col("ti") * TILE + (F.col("pos") / F.col("width")).cast("int")).alias("i"),
                       (F.col("tj") * TILE + F.col("pos") % F.col("width")).alias("j"), "g")


def product_array(df: DataFrame, shape: tuple[int, int], x_col: str = "x", y_col: str | None = None,
                  fn: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """X^T Y (or X^T X) at the driver, brought there tile by tile; zeros for a table without rows."""
    check_cells(shape, "a collected matrix")
    return collect_tiles(product_tiles(df, x_col, y_col, fn).toLocalIterator(), shape, y_col is None)


def collect_tiles(tiles: Iterable[Row], shape: tuple[int, int], mirror: bool = False) -> np.ndarray:
    """The matrix of summed tiles (``mirror``: symmetric, given by its upper ones)."""
    check_cells(shape, "a collected matrix")
    m = np.zeros(shape)
    for r in tiles:
        tile = np.array(r["tile"]).reshape(-1, r["width"])
        i, j = r["ti"] * TILE, r["tj"] * TILE
        m[i:i + tile.shape[0], j:j + tile.shape[1]] = tile
        if mirror:
            m[j:j + tile.shape[1], i:i + tile.shape[0]] = tile.T
    return m


def collect_matrix(ijg: DataFrame, shape: tuple[int, int] | None = None) -> np.ndarray:
    """Bring a small (i, j, g) table to the driver as a dense matrix."""
    ijg = ijg.select("i", "j", "g")
    if shape is not None:
        check_cells(shape, "a collected matrix")
    pdf = ijg.limit(MAX_CELLS + 1).toPandas() if shape is None else ijg.toPandas()  # Arrow, d x k rows
    if shape is None:
        check_cells((len(pdf),), "a collected matrix")
        shape = (int(pdf["i"].max()) + 1, int(pdf["j"].max()) + 1) if len(pdf) else (0, 0)
    m = np.zeros(shape)
    m[pdf["i"].to_numpy(), pdf["j"].to_numpy()] = pdf["g"].to_numpy()
    return m


def matrix_frame(spark: SparkSession, m: np.ndarray, row: str = "i", col: str = "j",
                 val: str = "g") -> DataFrame:
    """A small driver matrix as an (row, col, value) DataFrame."""
    m = np.asarray(m, dtype=float)
    ii, jj = np.indices(m.shape).reshape(2, -1)
    pdf = pd.DataFrame({row: ii.astype("int32"), col: jj.astype("int32"), val: m[ii, jj]})
    return spark.createDataFrame(pdf)


def dim_of(df: DataFrame, x_col: str = "x") -> int:
    """Length of the vectors (read from one row)."""
    r = df.select(F.size(x_col).alias("d")).where(F.col("d") >= 0).limit(1).collect()
    return int(r[0]["d"]) if r else 0

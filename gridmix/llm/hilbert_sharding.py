"""Sharding along a Hilbert curve.

Metadata columns are quantised to equal depth, the cells of that grid are
numbered along a Hilbert curve, rows are put in the order of their cell's
number, and the order is cut into runs of equal row counts. Neighbouring cells
share a run, so the files of a shard span narrow ranges of every dimension at
once. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from gridmix.llm.common import numbered, place_of, stored

BITS = 4
#: Rows that one task orders together.
BLOCK = 2_000
#: Distinct values that one task orders together.
VALUES = 50_000
#: The grid has two to the power of this many cells at most.
GRID_BITS = 16


def cell_starts(df: DataFrame, name: str, cells: int) -> list[tuple[Column, int]]:
    """(value, cell), ascending: the first value of each of the ``cells`` cells of equal depth that has one.

    A value is in cell floor(cells * r / n) if r of the n values that aren't null
    are before it: whole values are counted and ordered, whatever their type, so
    long common beginnings of strings don't matter. Running sums go over ranges
    of values of bounded size. At most ``cells`` - 1 rows reach the driver.
    """
    counts = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("v")).agg(F.count("*").alias("n"))
    counts = stored(counts, "values")
    size = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("values")).first()
    if not size["values"]:
        return []
    ranges = -(-size["values"] // VALUES)
    ordered = counts.withColumn("part", F.lit(0))
    if ranges > 1:  # a range's number is kept with its values when they are written
        ordered = stored(counts.repartitionByRange(ranges, "v").withColumn("part", F.spark_partition_id()), "ranges")
    past = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ordered.groupBy("part").agg(F.sum("n").alias("all")).select(  # one row for each VALUES values
        "part", F.coalesce(F.sum("all").over(past), F.lit(0)).alias("base"))
    before = F.col("base") + F.coalesce(F.sum("n").over(
        Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cell = F.floor(before * F.lit(cells) / F.lit(size["rows"]).cast("decimal(20,0)")).cast("int")
    placed = ordered.join(bases, "part").select("v", cell.alias("cell"))
    starts = placed.where("cell > 0").groupBy("cell").agg(F.min("v").alias("v"))
    kind = df.schema[name].dataType
    if not isinstance(kind, (StringType, BinaryType)):  # as text, which Spark reads back in its own time zone
        starts = starts.withColumn("v", F.col("v").cast("string"))
    return [(F.lit(r["v"]).cast(kind), r["cell"]) for r in sorted(starts.collect(), key=lambda r: r["cell"])]


def curve_cells(spark: SparkSession, dims: int, bits: int) -> DataFrame:
    """(cell, curve): the place on the Hilbert curve of each cell of the grid.

    The transform of Skilling (2004): undo the curve's reflections from the
    highest bit down, take the Gray code, and interleave the bits.
    """
    cells = spark.range(1 << dims * bits).withColumnRenamed("id", "cell")
    axes = [f"x{i}" for i in range(dims)]
    cells = cells.withColumns({a: F.shiftright("cell", bits * (dims - 1 - i)).bitwiseAND(F.lit((1 << bits) - 1))
                               for i, a in enumerate(axes)})

    def has(a: str, bit: int) -> Column:
        return F.col(a).bitwiseAND(F.lit(1 << bit)) != 0

    for bit in range(bits - 1, 0, -1):
        low = F.lit((1 << bit) - 1)
        for a in axes:
            swap = F.col(axes[0]).bitwiseXOR(F.col(a)).bitwiseAND(low)
            first = F.when(has(a, bit), F.col(axes[0]).bitwiseXOR(low)).otherwise(F.col(axes[0]).bitwiseXOR(swap))
            other = F.when(has(a, bit), F.col(a)).otherwise(F.col(a).bitwiseXOR(swap))
            cells = cells.withColumns({axes[0]: first} if a == axes[0] else {axes[0]: first, a: other})
    for before, a in zip(axes, axes[1:]):
        cells = cells.withColumn(a, F.col(a).bitwiseXOR(F.col(before)))
    turn = F.lit(0).cast("long")
    for bit in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(has(axes[-1], bit), F.lit((1 << bit) - 1)).otherwise(F.lit(0)))
    cells = cells.withColumn("turn", turn)
    bitwise = [F.shiftleft(F.shiftright(F.col(a).bitwiseXOR(F.col("turn")), bit).bitwiseAND(F.lit(1)),
                           bit * dims + dims - 1 - i)
               for bit in range(bits) for i, a in enumerate(axes)]
    return cells.select("cell", reduce(lambda x, y: x + y, bitwise).alias("curve"))


def on_curve(df: DataFrame, dims: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` and its ``curve`` place by the columns ``dims``, of any type that has an order. A null is in the first cell."""
    cell = F.lit(0).cast("long")
    for d in dims:
        place = F.lit(0).cast("long")
        for value, number in cell_starts(df, d, 1 << bits):
            place = F.when(F.col(d) >= value, F.lit(number).cast("long")).otherwise(place)
        cell = F.shiftleft(cell, bits) + place
    #: 2 ** (dims * bits) rows, whatever the input.
    grid = F.broadcast(curve_cells(df.sparkSession, len(dims), bits))
    return df.withColumn("cell", cell).join(grid, "cell").drop("cell")


def ranked(df: DataFrame, order: str, block: int = BLOCK, values: int = 1 << GRID_BITS) -> DataFrame:
    """``df`` (written, with a unique ``_row``) and its 0-based ``rank`` by ``order``, which has ``values``
    values at most.

    Rows of one value are split into hashed blocks; rows are numbered in each
    block, and blocks by running sums of their sizes, so no value meets in one task.
    """
    totals = df.groupBy(order).agg(F.count("*").alias("n"))
    blocks = totals.select(
        order, F.ceil(F.col("n") / block).alias("blocks"),
        F.coalesce(F.sum("n").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    if values <= 1 << GRID_BITS:  # three numbers a value
        blocks = F.broadcast(blocks)
    keyed = df.join(blocks, order).withColumn("_block", F.pmod(F.xxhash64("_row"), F.col("blocks")))
    sizes = keyed.groupBy(order, "_block").agg(F.count("*").alias("n"), F.first("base").alias("base"))
    starts = sizes.select(order, "_block", (F.col("base") + F.coalesce(F.sum("n").over(
        Window.partitionBy(order).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_start"))
    own = F.row_number().over(Window.partitionBy(order, "_block").orderBy("_row")) - 1
    return keyed.drop("blocks", "base").withColumn("_own", own).join(starts, [order, "_block"]).withColumn(
        "rank", F.col("_start") + F.col("_own")).drop("_block", "_own", "_start")


#: Columns that ``shards`` makes; one of ``keep`` that is called so is left out.
MADE = ("doc_id", "size", "text_crc32", "curve", "shard", "slot")


def shards(docs: DataFrame, number: int = 16, dims: Sequence[str] = ("source", "lang", "n_chars"), bits: int = BITS,
           id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard (0..number-1) and slot of every row, and the columns of ``keep``.

    Row counts of two shards differ by one at most. ``size`` is the text's
    bytes in UTF-8 plus 1 (null: 1, as an empty text). Repeated rows are rows
    like others, also with a null id. A null dimension is in the first cell,
    and dimensions may be numbers, strings, dates, times or booleans. Other
    columns of ``docs`` are left out, columns of any name may be kept, and an
    empty table gives no rows. The grid has 2 ** (len(dims) * bits) cells, so
    both are kept small.
    """
    if len(dims) * bits > GRID_BITS:
        raise ValueError(f"len(dims) * bits is {GRID_BITS} at most")
    kept = [c for c in dict.fromkeys(keep) if c.lower() not in MADE]
    names = [f"_dim{i}" for i in range(len(dims))], [f"_keep{i}" for i in range(len(kept))]
    source = numbered(docs).select(*[F.col(f"c{place_of(docs, c)}").alias(own) for c, own in zip(
        [id_col, text_col, *dims, *kept], ["_id", "_text", *names[0], *names[1]])])
    text = F.coalesce(F.col("_text").cast("string"), F.lit(""))
    placed = on_curve(source, names[0], bits).select(
        F.col("_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), "curve", *names[1],
        F.monotonically_increasing_id().alias("_row"))
    placed = stored(placed, "curve")
    total = placed.count()
    run = F.floor(F.col("rank") * number / F.lit(max(total, 1)).cast("decimal(20,0)"))
    begins = F.ceil(F.col("shard") * F.lit(total).cast("decimal(20,0)") / number)
    out = ranked(placed, "curve").withColumn("shard", run.cast("int")).withColumn(
        "slot", (F.col("rank") - begins).cast("long"))
    return out.select("doc_id", "size", "text_crc32", "curve", *names[1], "shard", "slot").toDF(
        "doc_id", "size", "text_crc32", "curve", *kept, "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, its files in the order of the curve."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

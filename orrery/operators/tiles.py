"""Exact NTILE over a whole table without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.session import materialize


@dataclass(frozen=True)
class Tile:
    """Tile number ``name`` from ordering the table by ``metric``."""

    name: str
    metric: str
    descending: bool = False


def _common_type(df: DataFrame, tiles: Sequence[Tile]) -> T.DataType:
    types = [df.schema[t.metric].dataType for t in tiles]
    if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in types):
        return T.DoubleType()
    scale = max((t.scale for t in types if isinstance(t, T.DecimalType)), default=0)
    return T.DecimalType(38, scale)


def _order_columns(df: DataFrame, tile: Tile, key: str, value_type: T.DataType) -> list[Column]:
    """Columns whose ascending order is the tile's order: nulls lowest, ties by key."""
    metric, ident = F.col(tile.metric), F.col(key)
    zero = F.lit(0).cast(value_type)
    null_rank = F.when(metric.isNull(), F.lit(1 if tile.descending else -1)).otherwise(F.lit(0))
    value = metric.cast(value_type)
    value = F.coalesce(-value if tile.descending else value, zero).cast(value_type)
    key_rank = F.when(ident.isNull(), F.lit(0)).otherwise(F.lit(1))
    return [null_rank, value, key_rank, ident]


def _tile_starts(n_rows: int, n_tiles: int) -> list[int]:
    """0-based row at which tiles 2, 3, ... begin; earlier tiles take the remainder."""
    size, extra = divmod(n_rows, n_tiles)
    starts = [t * size + min(t, extra) for t in range(1, n_tiles)]
    return [s for s in starts if s < n_rows]


def tile_cuts(df: DataFrame, key: str, tiles: Sequence[Tile], n_tiles: int) -> dict[str, list[tuple]]:
    """The first row of every tile but the first, as ``(null_rank, value, key_rank, key)``.

    All orderings are range-partitioned and sorted together in one shuffle, with
    the unique key as last sort column so that ties spread over partitions. The
    position inside each sorted partition is written to the shared scratch
    folder, which fixes it for the two small look-ups that follow: row counts per partition (at most one row per
    partition and ordering) and the cut rows themselves (``n_tiles - 1`` per
    ordering).
    """
    value_type = _common_type(df, tiles)
    names = ["null_rank", "value", "key_rank", "ident"]
    orderings = [
        F.struct(F.lit(i).alias("ordering"), *[c.alias(n) for c, n in zip(_order_columns(df, t, key, value_type), names)])
        for i, t in enumerate(tiles)
    ]
    stacked = df.select(F.inline(F.array(*orderings)))
    sort = ["ordering", *names]
    placed = materialize(
        stacked.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("place", F.monotonically_increasing_id()),
        "tiles",
    )
    runs = (
        placed.groupBy("ordering", F.shiftright("place", 33).alias("part"))
        .agg(F.count("*").alias("n_rows"), F.min("place").alias("first_place"))
        .collect()
    )
    wanted: list[int] = []
    for i in range(len(tiles)):
        parts = sorted((r.first_place, r.n_rows) for r in runs if r.ordering == i)
        starts = _tile_starts(sum(n for _, n in parts), n_tiles)
        passed = 0
        for first_place, n_rows in parts:
            wanted += [first_place + s - passed for s in starts if passed <= s < passed + n_rows]
            passed += n_rows
    cuts: dict[str, list[tuple]] = {t.name: [] for t in tiles}
    if wanted:
        for r in placed.filter(F.col("place").isin(wanted)).orderBy("place").collect():
            cuts[tiles[r.ordering].name].append((r.null_rank, r.value, r.key_rank, r.ident))
    return cuts


def _at_or_after(columns: Sequence[Column], cut: Sequence[object], types: Sequence[T.DataType]) -> Column:
    """Lexicographic ``columns >= cut``; a null last element means "any"."""
    if cut[-1] is None:
        columns, cut, types = columns[:-1], cut[:-1], types[:-1]
    result = None
    for col, bound, kind in reversed(list(zip(columns, cut, types))):
        limit = F.lit(bound).cast(kind)
        result = (col >= limit) if result is None else (col > limit) | ((col == limit) & result)
    return F.coalesce(result, F.lit(False))


def with_tiles(df: DataFrame, key: str, tiles: Sequence[Tile], n_tiles: int = 5) -> DataFrame:
    """Add one NTILE column per entry of ``tiles``; ties are broken by ``key``.

    ``key`` must be unique. Once the cuts are known a row's tile is a comparison
    with at most ``n_tiles - 1`` literals, so the table itself is not shuffled.
    """
    cuts = tile_cuts(df, key, tiles, n_tiles)
    value_type = _common_type(df, tiles)
    types = [T.IntegerType(), value_type, T.IntegerType(), df.schema[key].dataType]
    scores = {}
    for tile in tiles:
        columns = _order_columns(df, tile, key, value_type)
        score = F.lit(1)
        for cut in cuts[tile.name]:
            score = score + _at_or_after(columns, cut, types).cast("int")
        scores[tile.name] = score
    return df.withColumns(scores)

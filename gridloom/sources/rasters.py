"""Rasters from binary files as cells, tile by tile: portable grey and pixel maps, and raw band-sequential dumps."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELLS = "image string, row int, col int, bands array<double>"


def decode(content: bytes) -> np.ndarray:
    """(rows, cols, bands) of a binary P5 or P6 map with 8 or 16 bits."""
    m = re.match(rb"(P[56])\s+(?:#[^\n]*\n\s*)*(\d+)\s+(?:#[^\n]*\n\s*)*(\d+)\s+(?:#[^\n]*\n\s*)*(\d+)\s", content)
    if not m:
        raise ValueError("no binary portable map")
    cols, rows, most = (int(x) for x in m.groups()[1:])
    bands = 1 if m[1] == b"P5" else 3
    kind = np.dtype("u1") if most < 256 else np.dtype(">u2")
    return np.frombuffer(content, kind, rows * cols * bands, m.end()).reshape(rows, cols, bands)


def encode(cells: np.ndarray) -> bytes:
    """A binary map of 8-bit (rows, cols) or (rows, cols, 3) cells."""
    kind = b"P5" if cells.ndim == 2 else b"P6"
    return kind + b"\n%d %d\n255\n" % (cells.shape[1], cells.shape[0]) + cells.astype(np.uint8).tobytes()


def read_maps(spark: SparkSession, path: str) -> DataFrame:
    """Cells of every map under a path. A file is one task's work; cells are sent on in batches of rows."""

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                image = decode(bytes(content))
                step = max(1, 100_000 // image.shape[1])
                for top in range(0, image.shape[0], step):
                    part = image[top : top + step].astype(float)
                    r, c = np.divmod(np.arange(part.shape[0] * part.shape[1]), part.shape[1])
                    yield pd.DataFrame({"image": name, "row": (r + top).astype("int32"), "col": c.astype("int32"), "bands": list(part.reshape(-1, part.shape[2]))})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(cells, CELLS)


def tiles_of(cells: DataFrame, side: int) -> DataFrame:
    """Cells with the tile they belong to, the key to partition rasters by."""
    tile = lambda c: F.floor(F.col(c) / side).cast("int")
    return cells.withColumn("tile_row", tile("row")).withColumn("tile_col", tile("col"))


def tile_address(template: str, zoom: int, row, col):
    """Address of a map tile: a template with {z}, {y} and {x}."""
    parts = re.split(r"(\{[zyx]\})", template)
    named = {"{z}": F.lit(str(zoom)), "{y}": row.cast("string"), "{x}": col.cast("string")}
    return F.concat(*[named.get(p, F.lit(p)) for p in parts if p])


def bands_of(cells: DataFrame, count: int) -> DataFrame:
    """One row a cell and band, bands from 1."""
    return cells.select(*[c for c in cells.columns if c != "bands"], F.posexplode("bands").alias("band", "value")).withColumn("band", F.col("band") + 1).where(F.col("band") <= count)

"""Height rasters: big-endian 16-bit grids in binary files to rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "path string, post_row int, post_col int, elev_m int"
VOIDS = (-32768, -9999)


def decode_grids(files: DataFrame) -> DataFrame:
    """A row a post of every square grid in (path, content); voids are null."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                grid = np.frombuffer(content, ">i2").astype(np.int64)
                side = int(np.sqrt(len(grid)))
                at = np.arange(side * side)
                heights = pd.Series(grid[: side * side], dtype="Int32").mask(np.isin(grid[: side * side], VOIDS))
                yield pd.DataFrame({"path": name, "post_row": (at // side).astype(np.int32), "post_col": (at % side).astype(np.int32), "elev_m": heights})

    return files.select("path", "content").mapInPandas(decode, SCHEMA)


def read_grids(spark: SparkSession, path: str) -> DataFrame:
    """The posts of the grid files below a path."""
    return decode_grids(spark.read.format("binaryFile").load(path))

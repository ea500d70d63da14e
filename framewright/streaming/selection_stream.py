"""Running counterparts for frames that arrive over time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def view_counts_stream(cells: DataFrame) -> DataFrame:
    """Views of each cell so far; write it in update mode."""
    return cells.groupBy("flight", "cx", "cy").agg(F.count("*").alias("views"))


def spacing_stream(frames: DataFrame, spacing_m: float) -> DataFrame:
    """Greedy spacing with the last kept position of a flight as state.  Frames of a flight
    must arrive in order across batches; within one they are sorted."""

    def keep(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        out = []
        for f in pd.concat(list(parts)).sort_values("frame").itertuples():
            if last is None or (f.easting - last[0]) ** 2 + (f.northing - last[1]) ** 2 >= spacing_m**2:
                last = (f.easting, f.northing)
                out.append((key[0], f.frame))
        if last is not None:
            state.update(last)
        yield pd.DataFrame(out, columns=["flight", "frame"])

    return frames.select("flight", "frame", "easting", "northing").groupBy("flight").applyInPandasWithState(keep, "flight long, frame long", "e double, n double", "append", "NoTimeout")

"""Which samples of a profile count as surface, bottom or nutrient samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import midpoint
from tidemerge.functions.nulls import strict_max, strict_min
from tidemerge.operators.spread import attach_group

BIN = "Depth_bin"


def bin_daily(
    df: DataFrame, keys: Sequence[str], depth: str, threshold: float, time: str | None = None,
    *, hot_rows: int | None = None,
) -> DataFrame:
    """Keep the shallowest sample above the threshold and the deepest below it.

    With ``time``, every row of the group gets the midpoint of the group's times.
    """
    d = F.col(depth)
    stats = {"_top": strict_min(d), "_deep": strict_max(d)}
    if time is not None:
        t = F.col(time)
        stats |= {"_from": strict_min(t), "_to": strict_max(t)}
    # other rows are in no bin, and the times of all rows go into the group's midpoint alone
    apart = [] if time in (None, depth, *keys) else [time]
    ends = attach_group(df, keys, hot_rows=hot_rows, only=(d < threshold) | (d > threshold), without=apart, **stats)
    out = ends.withColumn(
        BIN,
        F.when((d == F.col("_top")) & (d < threshold), "surface").when(
            (d == F.col("_deep")) & (d > threshold), "bottom"
        ),
    )
    if time is not None:
        out = out.withColumn(time, midpoint(F.col("_from"), F.col("_to")))
    return out.filter(F.col(BIN).isNotNull()).select(*[F.col(f"`{c}`") for c in df.columns if c != BIN], BIN)


def bin_by_parameter(
    long: DataFrame,
    keys: Sequence[str],
    parameter: str,
    depth: str,
    water: Sequence[str],
    nutrients: Sequence[str],
    *,
    water_limit: float = 2,
    nutrient_limit: float = 5,
    surface_only: Sequence[str] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """Bin per key and parameter: water samples into surface and bottom, nutrients near the surface.

    ``long`` holds values that are not NULL, so the extremes are those of the
    samples in which the parameter was measured.
    """
    d, p = F.col(depth), F.col(parameter)
    # rows outside these limits are in no bin, wherever the extremes lie
    near = (p.isin(*water) & (d < water_limit)) | (p.isin(*nutrients) & (d < nutrient_limit))
    deep = p.isin(*[w for w in water if w not in surface_only]) & (d > water_limit)
    binned = attach_group(
        long, [*keys, parameter], hot_rows=hot_rows, only=near | deep,
        _top=strict_min(d), _deep=strict_max(d),
    ).withColumn(
        BIN,
        F.when(p.isin(*water) & (d < water_limit) & (d == F.col("_top")), "surface")
        .when(p.isin(*nutrients) & (d < nutrient_limit) & (d == F.col("_top")), "nutrient")
        .when(p.isin(*water) & (d > water_limit) & (d == F.col("_deep")), "bottom"),
    )
    out = binned.filter(F.col(BIN).isNotNull()).drop("_top", "_deep")
    if surface_only:
        out = out.filter(~(p.isin(*surface_only) & (F.col(BIN) == "bottom")))
    return out

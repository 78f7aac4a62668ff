"""Order-sensitive digests of any number of rows, with a bounded list in every task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 65_536


def ordered_digest(df: DataFrame, keys: list[str], pos: str, payload: Column | dict[str, Column], *, out: str = "digest",
                   fan: int = FAN, levels: int = 3) -> DataFrame:
    """SHA-256 tree over the rows of each key in position order.

    Rows are grouped by position // fan, every group is hashed in order, and the group
    digests are hashed the same way; `levels` rounds cover fan ** levels rows. Rows are dealt to their groups first, as
    they are, so what is shuffled is the columns that the payload needs, not the payload. Several payloads of the same rows,
    by the names of their digests, are digested in one pass.
    """
    parts = payload if isinstance(payload, dict) else {out: payload}
    held = [f"_d{i}" for i in range(len(parts))]
    place = F.col(pos).cast("bigint")
    work = df.repartition(*keys, F.floor(place / fan)).select(*keys, place.alias("_p"), *[c.alias(h) for h, c in zip(held, parts.values())], F.lit(1).cast("bigint").alias("_n"))
    for level in range(levels):
        last = level == levels - 1
        group = F.lit(0).cast("bigint") if last else F.floor(F.col("_p") / fan)
        listed = F.sort_array(F.collect_list(F.struct("_p", *held)))
        work = (work.groupBy(*keys, group.alias("_g")).agg(listed.alias("_l"), F.sum("_n").alias("_n"))
                .select(*keys, F.col("_g").alias("_p"),
                        *[F.sha2(F.array_join(F.col("_l")[h], "|"), 256).alias(h) for h in held], "_n"))
    rows = [F.col("_n").alias("rows")] if keys else []
    return work.select(*keys, *[F.col(h).alias(name) for h, name in zip(held, parts)], *rows)

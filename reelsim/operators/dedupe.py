"""Keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsim.operators.similarity import maybe_broadcast
from reelsim.session import store_table


# First rows that may be sent to every task (16 bytes each).
SENT_ROWS = 4_000_000


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: str = "row_id",
               order_unique: bool = True, stored: bool = False) -> DataFrame:
    """First row (lowest ``order``) of every key group; null keys form one
    group.

    With a unique ``order`` column (``row_id``): a hash aggregate of
    ``min(order)`` per key over the narrow key columns (combined map-side,
    so a key holding a third of all rows is reduced before the shuffle),
    then a semi-join on ``order``.  Wide columns (descriptions) are never
    sorted and move at most once; AQE broadcasts the first-row ids when
    they are small.  ``stored`` stores those ids and sends up to
    ``SENT_ROWS`` of them to every task, so that ``df`` is not shuffled.
    Without a unique order, ``min_by`` of the whole row.
    (``dropDuplicates`` does not promise the first row.)
    """
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    key_names = [f"_k{i}" for i in range(len(key_cols))]
    if order_unique:
        firsts = (df.select(*[c.alias(n) for c, n in zip(key_cols, key_names)], F.col(order))
                    .groupBy(*key_names).agg(F.min(order).alias(order)))
        firsts = firsts.select(order)
        if stored:
            firsts = store_table(firsts, "firsts")
            firsts = maybe_broadcast(firsts, firsts.count() <= SENT_ROWS)
        return df.join(firsts, order, "left_semi")
    cols = df.columns
    keyed = df.select(*[c.alias(n) for c, n in zip(key_cols, key_names)],
                      F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
    first = keyed.groupBy(*key_names).agg(F.min_by("_row", F.col(f"_row.{order}")).alias("_row"))
    return first.select("_row.*")


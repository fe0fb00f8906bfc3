"""Join helpers shared by the operators: key look-ups of a batch against a large stored table.

The batch's distinct keys are semi-joined with the stored key column, and the
batch is anti-joined with the few keys found. Whether a side is broadcast is
left to Spark's size estimates and adaptive execution
(``spark.sql.adaptive.autoBroadcastJoinThreshold``); nothing is counted while
a query is planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def stored_matches(stored: DataFrame, batch: DataFrame, key: str,
                   extra: list[str] | None = None) -> DataFrame:
    """Rows of ``stored`` (``key`` and ``extra`` columns only) whose key
    occurs in ``batch``. Where the batch's distinct keys are small, Spark
    broadcasts them and the stored side is filtered where it is read."""
    keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
    return (stored.select(key, *(extra or [])).where(F.col(key).isNotNull())
                  .join(keys, key, "left_semi"))


def absent_from(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``stored`` (insert-if-absent)."""
    found = stored_matches(stored, batch, key)
    return batch.join(found, key, "left_anti")

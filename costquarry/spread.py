"""Work that is far above the size of its rows, spread over the cores."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: A small file is few tasks by itself, whatever is then done with each of its rows.
TASKS_A_CORE = 4


def dealt(rows: DataFrame) -> DataFrame:
    """The rows, dealt to several tasks a core."""
    return rows.repartition(TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)

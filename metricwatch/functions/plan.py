"""Plan helper: lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from metricwatch.session import ensure_checkpoint_dir

def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialize ``df`` in the cluster's checkpoint folder (``spark.checkpoint.dir``).

    Reliable checkpoint, not a local one: the files live in shared storage, so losing an executor
    after this point does not force recomputation of the upstream plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)

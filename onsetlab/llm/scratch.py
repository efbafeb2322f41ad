"""Intermediate results that outlive executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from onsetlab.sources.staging import scratch_dir, session_stages


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, its lineage ended there.

    The files go when the session stops: what reads them is lazy, so none may go before.
    """
    context = df.sparkSession.sparkContext
    folder = scratch_dir(df.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    done = df.checkpoint(eager=True)
    session_stages(df.sparkSession).also_remove(written_to(done))
    return done


def written_to(checkpointed: DataFrame) -> str:
    """The folder that holds a checkpointed frame."""
    return checkpointed._jdf.queryExecution().logical().rdd().getCheckpointFile().get()

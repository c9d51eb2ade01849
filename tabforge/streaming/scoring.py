"""Scoring a stream with the same saved model as a batch, with bad records set aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabforge.functions.columns import col
from tabforge.operators import models
from tabforge.sources.tables import check_columns
from tabforge.streaming.sources import start_batches

REASON = "reject_reason"
_BAD = "__corrupt"


def score_stream(
    stream: DataFrame,
    model: PipelineModel,
    keep: Sequence[str] | None = None,
    target: str | None = None,
    datetime_columns: Sequence[str] = (),
) -> DataFrame:
    """Predictions of a typed stream. Missing columns raise at once; extra ones and the target are ignored."""
    check_columns(stream, models.input_columns(model, datetime_columns))
    rows = stream.drop(target) if target else stream
    return models.score(model, rows, keep)


def parse_records(stream: DataFrame, schema: StructType, required: Sequence[str], column: str = "value") -> DataFrame:
    """JSON text into columns plus ``reject_reason``: NULL for a good record, else what is wrong.

    A required field has to be named in the record; its value may be null, as imputation fills it.
    """
    text = col(column)
    names = F.json_object_keys(text)
    absent = F.array_sort(F.array_except(F.array(*[F.lit(c) for c in required]), names))
    reason = F.when(names.isNull(), F.lit("not a JSON object")).when(
        F.size(absent) > 0, F.concat(F.lit("Missing columns: "), F.to_json(absent))
    )
    # a value that doesn't fit its type would become NULL and be imputed: the whole record is set aside
    marked = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    parsed = F.from_json(text, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    rows = stream.select(text.alias(column), reason.alias(REASON), parsed.alias("__r"))
    typed = F.when(F.col(f"__r.{_BAD}").isNotNull(), F.lit("a value of the wrong type"))
    return rows.select(
        column, F.coalesce(F.col(REASON), typed).alias(REASON), *[F.col(f"__r.`{f.name}`").alias(f.name) for f in schema]
    )


def start_scoring(
    records: DataFrame,
    model: PipelineModel,
    output: str,
    quarantine: str,
    checkpoint: str,
    keep: Sequence[str] | None = None,
    column: str = "value",
    available_now: bool = False,
) -> StreamingQuery:
    """Score good records into ``output`` and write the others with their reason to ``quarantine``.

    Each micro-batch replaces its own folder, so a batch that is run again leaves one copy.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        good = batch.where(F.col(REASON).isNull()).drop(REASON, column)
        models.score(model, good, keep).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
        bad = batch.where(F.col(REASON).isNotNull()).select(column, REASON)
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")

    return start_batches(records, handle, checkpoint, available_now)

"""Patient streams: source, scoring, sinks.

Scoring is stateless, so the same functions serve streams and batches, and a stream's output
equals the batch result over the same rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from medlattice import schema as S
from medlattice.functions import rules
from medlattice.operators.clean import domain_check, nan_to_null
from medlattice.operators.models import with_probability
from medlattice.operators.ranking import confidence
from medlattice.sources.files import BAD_LINE, CSV_OPTIONS, read_patients_csv, with_bad_line
from medlattice.sources.store import load_model

MODEL_COLUMNS = {
    "disease": "string", "confidence": "double", "cardio_risk": "int", "diet_plan": "string",
    "lifestyle_plan": "string", "health_risk_index": "double", "risk_band": "string",
}


def read_patient_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = 1, schema: T.StructType = S.STREAM, bad_lines: bool = False
) -> DataFrame:
    """Stream over a folder of CSV files with a header; each new file is read once.

    Producers add files and never append to one that was already picked up. With ``bad_lines`` a line that does not
    fit the schema keeps its text in the column ``BAD_LINE``.
    """
    options = {**CSV_OPTIONS, "columnNameOfCorruptRecord": BAD_LINE} if bad_lines else CSV_OPTIONS
    reader = spark.readStream.schema(with_bad_line(schema) if bad_lines else schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return nan_to_null(reader.csv(path))


def score_rules(df: DataFrame) -> DataFrame:
    """Domain verdict, the two scores that need no diagnosis, and the risks made of them."""
    checked = domain_check(nan_to_null(df))
    scored = checked.withColumns(
        {"metabolic_risk": rules.metabolic_risk(), "lifestyle_burden": rules.lifestyle_burden()}
    )
    return scored.withColumns(
        {
            "diet_risk": rules.score_as_risk("metabolic_risk"),
            "lifestyle_risk": rules.score_as_risk("lifestyle_burden"),
        }
    )


def score_patients(df: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Rule scores plus the disease model, both plans and the health risk index.

    A column of ``df`` that carries the name of a result, as in a labelled table, is kept as
    ``true_<name>``. The disease risk is one minus the probability of ``Healthy``, whose position
    is read from the model's own decoder; it is one for a model that never saw ``Healthy``.

    Rows the domain check rejects stay in the output with null predictions, so nothing is lost
    in the model's null handling. Without a model the model columns are null.
    """
    scored = score_rules(df.withColumnsRenamed({c: f"true_{c}" for c in df.columns if c in MODEL_COLUMNS}))
    if model is None:
        return scored.withColumns({c: F.lit(None).cast(kind) for c, kind in MODEL_COLUMNS.items()})
    inputs = [*S.NUMERIC, *S.CATEGORICAL]
    stand_ins = {c: F.coalesce(c, F.lit(0.0)) for c in S.NUMERIC}
    stand_ins |= {c: F.coalesce(c, F.lit("")) for c in S.CATEGORICAL}
    held = scored.withColumn("_raw", F.struct(*inputs)).withColumns(stand_ins)
    predicted = with_probability(model.transform(held))
    usable = F.col("verdict") == "accepted"
    labels = list(model.stages[-1].getLabels())
    healthy = F.get("probability", F.lit(labels.index("Healthy"))) if "Healthy" in labels else F.lit(0.0)
    kept = [c for c in scored.columns if c not in inputs]
    out = predicted.select(
        *kept, *[F.col(f"_raw.{c}").alias(c) for c in inputs],
        F.when(usable, F.col("predicted_class")).alias("disease"),
        F.when(usable, confidence("probability", "prediction")).alias("confidence"),
        F.when(usable, F.lit(1.0) - healthy).alias("_disease_risk"),
    )
    out = out.withColumn("cardio_risk", rules.cardio_risk())
    out = out.withColumns(
        {
            "diet_plan": rules.diet_plan(F.col("metabolic_risk"), F.col("cardio_risk")),
            "lifestyle_plan": rules.lifestyle_plan(F.col("metabolic_risk"), F.col("lifestyle_burden")),
            "health_risk_index": rules.health_risk_index("_disease_risk", "diet_risk", "lifestyle_risk"),
        }
    )
    order = [*scored.columns, *MODEL_COLUMNS]
    return out.withColumn("risk_band", rules.risk_band("health_risk_index")).select(*order)


def model_or_none(spark: SparkSession, path: str | None) -> PipelineModel | None:
    """The saved pipeline, or None when there is none at the path."""
    return load_model(spark, path) if path else None


def write_stream(
    df: DataFrame, path: str, checkpoint: str, once: bool = True, every: str = "5 seconds",
    partition: str | None = None,
) -> StreamingQuery:
    """Append to Parquet exactly once: the file sink commits each batch in its own log.

    ``once`` processes what is there and ends; otherwise a batch starts at every interval.
    Partitioning by verdict keeps rejected rows apart in the same single pass.
    """
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if partition:
        writer = writer.partitionBy(partition)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start(path)


def write_console(df: DataFrame, every: str | None = "5 seconds") -> StreamingQuery:
    """Print appended rows in full; ``every=None`` uses the default trigger."""
    writer = df.writeStream.outputMode("append").format("console").option("truncate", False)
    return (writer.trigger(processingTime=every) if every else writer).start()


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Let a query run for a while, then stop it; True if it had ended by itself."""
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


def score_stream(
    spark: SparkSession, source: str, sink: str, checkpoint: str, model_path: str | None = None,
    files_per_trigger: int | None = 1, once: bool = True, quarantine: bool = False,
) -> StreamingQuery:
    """Score a folder of CSV files into Parquet partitioned by verdict.

    Falls back to rule scores with null predictions when no model is stored at ``model_path``. With ``quarantine``
    lines that do not fit the schema go to a partition of their own, verdict ``malformed``, with their text in
    ``BAD_LINE``: the same pass, so each line is in the sink exactly once.
    """
    stream = read_patient_stream(spark, source, files_per_trigger, bad_lines=quarantine)
    scored = score_patients(stream, model_or_none(spark, model_path))
    if quarantine:
        scored = scored.withColumn("verdict", F.when(F.col(BAD_LINE).isNotNull(), "malformed").otherwise(F.col("verdict")))
    return write_stream(scored, sink, checkpoint, once, partition="verdict")


def score_accumulated(spark: SparkSession, source: str, model_path: str | None = None) -> DataFrame:
    """The same scoring over everything the folder holds, as a batch."""
    return score_patients(read_patients_csv(spark, source, S.STREAM), model_or_none(spark, model_path))

"""Feature encoding: indexers, one-hot, assembling, scaling, and the four feature sets.

Stages are Spark ML estimators; fit them on the training rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice import schema as S


def frequency_indexer(columns: Sequence[str]) -> StringIndexer:
    """Most frequent value gets 0, ties alphabetical, unseen and null share the next index."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_index" for c in columns],
        stringOrderType="frequencyDesc", handleInvalid="keep",
    )


def alphabetical_indexer(columns: Sequence[str], suffix: str = "_code", invalid: str = "error") -> StringIndexer:
    """Codes in alphabetical order of the values."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}{suffix}" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid=invalid,
    )


def label_indexer(target: str, classes: Sequence[str], output: str = "label") -> StringIndexerModel:
    """Target codes for a known class list, so a class that is absent from a small training
    table still keeps its code. Unknown labels raise."""
    return StringIndexerModel.from_labels(list(classes), inputCol=target, outputCol=output, handleInvalid="error")


def label_decoder(classes: Sequence[str], prediction: str = "prediction", output: str = "predicted_class") -> IndexToString:
    return IndexToString(inputCol=prediction, outputCol=output, labels=list(classes))


def one_hot(columns: Sequence[str], drop_last: bool) -> OneHotEncoder:
    """Input is ``<column>_index``. With ``keep`` indexers the last slot is "unseen":
    ``drop_last`` turns unseen levels into all zeros."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_encoded" for c in columns], dropLast=drop_last
    )


def assembler(columns: Sequence[str], output: str = "features_raw") -> VectorAssembler:
    """Vector of the columns; rows with a missing entry are skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip")


def scaler(source: str = "features_raw", output: str = "features") -> StandardScaler:
    """Mean 0, sample standard deviation 1; a constant column becomes 0."""
    return StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=True)


@dataclass(frozen=True)
class ColumnScaler:
    """Fitted means and population standard deviations; ``transform`` is a projection."""

    stats: Mapping[str, tuple[float, float]]

    def transform(self, df: DataFrame, suffix: str = "_scaled") -> DataFrame:
        return df.withColumns({f"{c}{suffix}": self._expression(c) for c in self.stats})

    def as_stage(self, suffix: str = "_scaled") -> SQLTransformer:
        """The same arithmetic as a pipeline stage, so it is saved with the model."""
        parts = []
        for column, (mean, sd) in self.stats.items():
            value = f"((`{column}` - {mean!r}D) / {sd!r}D)" if sd > 0 else f"(`{column}` * 0.0D)"
            parts.append(f"{value} AS `{column}{suffix}`")
        return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")

    def _expression(self, column: str):
        mean, sd = self.stats[column]
        centred = F.col(column) - F.lit(mean)
        return centred / F.lit(sd) if sd > 0 else centred * F.lit(0.0)


def fit_population_scaler(df: DataFrame, columns: Sequence[str]) -> ColumnScaler:
    """Means and population deviations of all columns in one aggregation."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return ColumnScaler({c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0) for c in columns})


def fill_stage(values: Mapping[str, float | str]) -> SQLTransformer:
    """Fitted replacement values as a pipeline stage. A column without any value has none: that is an error."""
    empty = [column for column, value in values.items() if value is None]
    if empty:
        raise ValueError(f"no value to fill with, all rows are null: {', '.join(empty)}")
    parts = []
    for column, value in values.items():
        literal = "'" + value.replace("'", "''") + "'" if isinstance(value, str) else f"{float(value)!r}D"
        parts.append(f"coalesce(`{column}`, {literal}) AS `{column}`")
    names = ", ".join(f"`{c}`" for c in values)
    return SQLTransformer(statement=f"SELECT * EXCEPT ({names}), {', '.join(parts)} FROM __THIS__")


def ordinal_stage() -> SQLTransformer:
    """Ordinal codes of the four ordered categories as a pipeline stage."""
    parts = []
    for source, (code, levels) in S.ORDINAL.items():
        arms = " ".join(f"WHEN '{level}' THEN {float(i)!r}D" for i, level in enumerate(levels))
        parts.append(f"CASE `{source}` {arms} END AS `{code}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


# --- feature sets ---------------------------------------------------------------------------


def production_features() -> list:
    """28 slots: 7 numeric and 5 one-hot categories with an "unseen" slot each, all scaled."""
    encoded = [f"{c}_encoded" for c in S.CATEGORICAL]
    return [
        frequency_indexer(S.CATEGORICAL), one_hot(S.CATEGORICAL, drop_last=False),
        assembler([*S.NUMERIC, *encoded]), scaler(),
    ]


def coded_features(train: DataFrame) -> list:
    """12 slots: 7 numeric and 5 alphabetical codes, scaled with population deviations."""
    codes = alphabetical_indexer(S.CATEGORICAL, invalid="keep").fit(train)
    columns = [*S.NUMERIC, *[f"{c}_code" for c in S.CATEGORICAL]]
    scale = fit_population_scaler(codes.transform(train), columns)
    return [codes, scale.as_stage(), assembler([f"{c}_scaled" for c in columns], "features")]


def one_hot_features(train: DataFrame) -> list:
    """23 slots at most: 7 scaled numerics and 5 one-hot categories, unseen levels all zero."""
    scale = fit_population_scaler(train, S.NUMERIC)
    encoded = [f"{c}_encoded" for c in S.CATEGORICAL]
    return [
        frequency_indexer(S.CATEGORICAL), one_hot(S.CATEGORICAL, drop_last=True), scale.as_stage(),
        assembler([*[f"{c}_scaled" for c in S.NUMERIC], *encoded], "features"),
    ]


def ordinal_features(train: DataFrame) -> list:
    """11 slots: 7 numeric and 4 ordinal codes, mean-imputed, scaled once."""
    from medlattice.operators.clean import fit_mean

    codes = ordinal_stage()
    coded = codes.transform(train)
    fill = fit_mean(coded, S.ORDINAL_FEATURES)
    scale = fit_population_scaler(fill.transform(coded), S.ORDINAL_FEATURES)
    scaled = [f"{c}_scaled" for c in S.ORDINAL_FEATURES]
    return [codes, fill_stage(dict(fill.values)), scale.as_stage(), assembler(scaled, "features")]


def fit_features(stages: Sequence, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(train)


def slot_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector slots, read from the column's ML metadata."""
    attrs = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a.get("name", str(a["idx"]))) for group in attrs.values() for a in group)
    return [name for _, name in slots]

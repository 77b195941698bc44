"""Imputation, scaling and one-hot encoding, fitted on training rows only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from evenkeel.contract import Contract, require_columns
from evenkeel.functions.numeric import nan_to_null
from evenkeel.operators.order_stats import exact_quantiles, long_series
from evenkeel.session import materialize

# Spark's encoder and assembler describe every feature in the column's metadata, which the driver holds and every plan
# copies. Beyond this many categories vectors are put together without it.
DESCRIBED = 10_000


def numeric_column(name: str) -> Column:
    return nan_to_null(F.col(name).cast("double"))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact interpolated medians of several columns in the same passes."""
    found = exact_quantiles(long_series(df, [(i, numeric_column(c)) for i, c in enumerate(columns)]), [0.5])
    empty = [c for i, c in enumerate(columns) if i not in found]
    if empty:
        raise ValueError(f"no present values to take a median of in {empty}")
    return {c: found[i][1][0] for i, c in enumerate(columns)}


def impute_median(df: DataFrame, columns: Sequence[str], fitted: dict[str, float] | None = None) -> DataFrame:
    fitted = fitted or medians(df, columns)
    return df.withColumns({c: F.coalesce(numeric_column(c), F.lit(fitted[c])) for c in columns})


@dataclass(frozen=True)
class Categories:
    mode: str
    values: tuple[str, ...]


def _counted_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, v, count): how often each present value of the i-th column occurs, all columns in one aggregate."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    return df.select(F.inline(pairs)).where("v IS NOT NULL").groupBy("i", "v").count()


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The most frequent present value per column (ties: smallest). Collected: one value per column."""
    counted = _counted_values(df, columns)
    most = counted.groupBy(F.col("i").alias("__i")).agg(F.max("count").alias("__most"))
    top = counted.join(most, (F.col("i") == F.col("__i")) & (F.col("count") == F.col("__most")))
    found = {r["i"]: r["v"] for r in top.groupBy("i").agg(F.min("v").alias("v")).collect()}
    empty = [c for i, c in enumerate(columns) if i not in found]
    if empty:
        raise ValueError(f"no present values to take a mode of in {empty}")
    return {c: found[i] for i, c in enumerate(columns)}


def labels(table: DataFrame) -> tuple[str, ...]:
    """A category table's values in order. They reach the driver: for what is made of names, not of rows."""
    return tuple(r["value"] for r in table.orderBy("position").select("value").collect())


def categories(df: DataFrame, columns: Sequence[str]) -> dict[str, Categories]:
    """Sorted distinct values and the most frequent one (ties: smallest) per column, for one-hot columns with names."""
    if not columns:
        return {}
    found = modes(df, columns)
    return {c: Categories(found[c], labels(category_table(df, c))) for c in columns}


def category_table(df: DataFrame, column: str) -> DataFrame:
    """(value, position): the distinct present values of a column, numbered from 0 in their order.

    Values are dealt out by ranges and numbered within each; the sizes of earlier ranges are
    added. No task and no driver sees all of them.
    """
    values = df.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct()
    dealt = values.repartitionByRange("value").withColumn("__range", F.spark_partition_id())
    ranges = materialize(dealt, "categories")
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("__range").agg(F.count("*").alias("__n"))  # one row per task
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy("value")) - 1
    numbered = ranges.withColumn("__at", inside).join(offsets, "__range")
    return numbered.select("value", (F.col("__at") + F.col("__before")).alias("position"))


def category_positions(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """``df`` with ``{column}_position``; NULL for a missing value and for one that isn't in the table."""
    side = table.select(F.col("value").alias("__value"), F.col("position").alias(f"{column}_position"))
    return df.join(side, F.col(column).cast("string") == F.col("__value"), "left").drop("__value")


def impute_mode(df: DataFrame, columns: Sequence[str], fitted: dict[str, Categories] | None = None) -> DataFrame:
    fill = {c: fitted[c].mode for c in columns} if fitted else modes(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(fill[c])) for c in columns})


def moments(df: DataFrame, columns: Sequence[str | Column]) -> list[tuple[float, float]]:
    """Mean and population deviation per column, one pass."""
    cs = [numeric_column(c) if isinstance(c, str) else c for c in columns]
    row = df.agg(*[F.avg(c) for c in cs], *[F.stddev_pop(c) for c in cs]).first()
    return list(zip(row[: len(cs)], row[len(cs) :]))


def standardize(df: DataFrame, columns: Sequence[str], fitted: Sequence[tuple[float, float]] | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column divides by one."""
    fitted = fitted or moments(df, columns)
    return df.withColumns({c: (numeric_column(c) - m) / (s or 1.0) for c, (m, s) in zip(columns, fitted)})


def one_hot_columns(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per category, sorted; unknown or missing gives zeros throughout."""
    flags = {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("double") for v in sorted(values)}
    return df.withColumns(flags)


def _number(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class FeatureState:
    """What was learned from the training rows: a few numbers per column, and per categorical column a table.

    ``tables`` number the categories (value, position) and ``sizes`` counts them. ``transform_features`` joins rows
    with them, whatever their size; ``stages`` and ``feature_names`` are made of the labels themselves.
    """

    contract: Contract
    medians: dict[str, float]
    scale: dict[str, tuple[float, float]]
    modes: dict[str, str]
    tables: dict[str, DataFrame]
    sizes: dict[str, int]

    @cached_property
    def labels(self) -> dict[str, tuple[str, ...]]:
        return {c: labels(self.tables[c]) for c in self.contract.categorical}

    def feature_names(self) -> list[str]:
        """Numeric columns, then ``column_value`` per category."""
        names = list(self.contract.numeric)
        for c in self.contract.categorical:
            names += [f"{c}_{v}" for v in self.labels[c]]
        return names

    def feature_table(self) -> DataFrame:
        """(position, name) of every feature, without the driver."""
        spark = SparkSession.active()
        out = spark.createDataFrame(list(enumerate(self.contract.numeric)), "position bigint, name string")
        before = len(self.contract.numeric)
        for c in self.contract.categorical:
            named = self.tables[c].select((F.col("position") + before).alias("position"), F.concat(F.lit(f"{c}_"), "value").alias("name"))
            out, before = out.unionByName(named), before + self.sizes[c]
        return out

    def _select_statement(self) -> str:
        parts = []
        for c in self.contract.numeric:
            mean, std = self.scale[c]
            value = f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {_number(self.medians[c])})"
            parts.append(f"({value} - {_number(mean)}) / {_number(std or 1.0)} AS `__num_{c}`")
        for c in self.contract.categorical:
            parts.append(f"coalesce(CAST(`{c}` AS STRING), {_text(self.modes[c])}) AS `__cat_{c}`")
        return f"SELECT *, {', '.join(parts)} FROM __THIS__"

    def stages(self, df: DataFrame) -> list[Transformer]:
        """Stock Spark ML stages, so a saved pipeline loads without this package; the labels are part of it.

        A missing category takes the mode; one unseen in training encodes to zeros,
        because its index is the one the encoder drops.
        """
        stages: list[Transformer] = [SQLTransformer(statement=self._select_statement())]
        inputs = [f"__num_{c}" for c in self.contract.numeric]
        if self.contract.categorical:
            cats = list(self.contract.categorical)
            # One indexer per column: the many-column form pads unequal label lists with nulls.
            indexers = [
                StringIndexerModel.from_labels(
                    list(self.labels[c]), inputCol=f"__cat_{c}", outputCol=f"__idx_{c}", handleInvalid="keep"
                )
                for c in cats
            ]
            encoder = OneHotEncoder(
                inputCols=[f"__idx_{c}" for c in cats], outputCols=[f"__hot_{c}" for c in cats], dropLast=True
            )
            # Category counts come from column metadata: fitting reads no rows.
            stages += indexers
            stages.append(encoder.fit(PipelineModel(stages).transform(df)))
            inputs += [f"__hot_{c}" for c in cats]
        return stages + self._assembled(inputs)

    def _assembled(self, inputs: list[str]) -> list[Transformer]:
        helpers = [f"__{kind}_{c}" for c in self.contract.categorical for kind in ("cat", "idx", "hot")]
        helpers += [f"__num_{c}" for c in self.contract.numeric]
        keep = ", ".join(f"`{h}`" for h in helpers)
        drop = SQLTransformer(statement=f"SELECT * EXCEPT ({keep}) FROM __THIS__")
        return [VectorAssembler(inputCols=inputs, outputCol="features"), drop]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``features``: categories are numbered by joins with their tables and encoded to sparse vectors.

        Up to ``DESCRIBED`` categories the column's metadata describes each feature; beyond, ``feature_table`` does.
        """
        ready = SQLTransformer(statement=self._select_statement()).transform(df)
        for c in self.contract.categorical:
            side = self.tables[c].select(F.col("value").alias("__value"), F.col("position").alias(f"__idx_{c}"))
            ready = ready.join(side, F.col(f"__cat_{c}") == F.col("__value"), "left").drop("__value")
        return self._wide(ready) if sum(self.sizes.values()) > DESCRIBED else self._described(ready)

    def _described(self, ready: DataFrame) -> DataFrame:
        inputs = [f"__num_{c}" for c in self.contract.numeric]
        for c in self.contract.categorical:
            # One number more than there are categories stands for all others; the encoder drops it.
            kinds = {"ml_attr": {"type": "nominal", "num_vals": self.sizes[c] + 1}}
            index = F.coalesce(F.col(f"__idx_{c}"), F.lit(self.sizes[c])).cast("double")
            ready = ready.withColumn(f"__idx_{c}", index.alias(f"__idx_{c}", metadata=kinds))
            encoder = OneHotEncoder(inputCols=[f"__idx_{c}"], outputCols=[f"__hot_{c}"], dropLast=True)
            ready = encoder.fit(ready).transform(ready)  # the number of categories comes from the metadata
            inputs.append(f"__hot_{c}")
        return PipelineModel(self._assembled(inputs)).transform(ready)

    def _wide(self, ready: DataFrame) -> DataFrame:
        """The same vectors with nothing per feature on the driver; always sparse."""
        values = [F.col(f"__num_{c}") for c in self.contract.numeric]
        places, before = [F.lit(i).cast("int") for i in range(len(values))], len(values)
        for c in self.contract.categorical:
            places.append((F.col(f"__idx_{c}") + before).cast("int"))  # NULL for a value unseen in training
            values.append(F.lit(1.0))
            before += self.sizes[c]
        pairs = F.arrays_zip(F.array(*places).alias("at"), F.array(*values).alias("x"))
        held = F.filter(pairs, lambda p: p["at"].isNotNull() & (p["x"] != 0))
        parts = {"type": F.lit(0), "size": F.lit(before), "indices": held["at"], "values": held["x"]}
        vector = F.struct(*[c.alias(name) for name, c in parts.items()])
        # Spark makes vectors of such parts when it reads them as JSON, whose numbers come back as they were.
        text = F.to_json(F.struct(vector.alias("features")))
        read = F.from_json(text, StructType().add("features", VectorUDT()), {"mode": "FAILFAST"})["features"]
        spoiled = F.exists(F.array(*values), F.isnan)
        features = F.when(spoiled, F.raise_error(F.lit("a feature is NaN"))).otherwise(read)
        helpers = [f"__{kind}_{c}" for c in self.contract.categorical for kind in ("cat", "idx")]
        return ready.withColumn("features", features).drop(*helpers, *[f"__num_{c}" for c in self.contract.numeric])


def nonzero_counts(df: DataFrame, column: str = "features") -> DataFrame:
    """(position, rows): in how many vectors of ``column`` a feature isn't zero; features that always are have no row.

    Counted like any key, so no task holds a number per feature.
    """
    vector = F.unwrap_udt(column)
    # A dense vector has no list of positions.
    at = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    pairs = df.select(F.explode(F.arrays_zip(at.alias("position"), vector["values"].alias("value"))).alias("p"))
    held = pairs.where("p.value != 0").groupBy(F.col("p.position").cast("bigint").alias("position"))
    return held.agg(F.count("*").alias("rows"))


def fit_features(train: DataFrame, contract: Contract) -> FeatureState:
    """Learn medians, then moments of the imputed values, and the categories."""
    require_columns(train, contract.features, "required features")
    mids = medians(train, contract.numeric) if contract.numeric else {}
    imputed = [F.coalesce(numeric_column(c), F.lit(mids[c])) for c in contract.numeric]
    scale = dict(zip(contract.numeric, moments(train, imputed))) if contract.numeric else {}
    found = modes(train, contract.categorical) if contract.categorical else {}
    tables = {c: materialize(category_table(train, c), "category-table") for c in contract.categorical}
    return FeatureState(contract, mids, scale, found, tables, {c: t.count() for c, t in tables.items()})


def transform_features(df: DataFrame, state: FeatureState | None) -> DataFrame:
    """Add the ``features`` vector."""
    if state is None:
        raise RuntimeError("Features must be fitted before they can be transformed.")
    require_columns(df, state.contract.features, "required features")
    return state.transform(df)

"""Feature engineering: fitted one-hot vocabularies, label maps, imputation, scaling.

Everything is fit / transform: a fit is one aggregate over the data whose small result
(a vocabulary, a handful of means) is kept in a plain object; a transform is a single
projection with those values as literals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.running import numbered
from keelson.functions.text import clean_names, quote_name, try_numeric, value_map
from keelson.session import staged

MAX_COLUMNS = 1000
UNSEEN = 1e15  # beyond any slot: the encoder gives such an index no place


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for several columns in one scan; NULL values included."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(quote_name(c)).cast("string").alias("value")) for c in columns
    ])
    return (
        df.select(F.explode(pairs).alias("pair"))
        .groupBy("pair.column", "pair.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_vocab(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct non-NULL values per column with their frequency."""
    return value_counts(df, columns).filter(F.col("value").isNotNull())


def fit_vocab(
    df: DataFrame, columns: Sequence[str], max_categories: int = MAX_COLUMNS
) -> dict[str, list[str]]:
    """Collect sorted vocabularies for encoding into columns. Each value becomes an output column,
    so a column with more than ``max_categories`` values is refused (and never reaches the
    driver); :class:`WideEncoder` encodes those."""
    vocab = category_vocab(df, columns)
    limit = max_categories * len(columns)
    rows = vocab.select("column", "value").limit(limit + 1).collect()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        found[row["column"]].append(row["value"])
    crowded = [c for c, values in found.items() if len(values) > max_categories]
    if crowded or len(rows) > limit:
        raise ValueError(f"too many categories to encode (limit {max_categories}): {crowded or list(columns)}")
    return {c: sorted(values) for c, values in found.items()}


def _indicator(column: str, value: str) -> Column:
    hit = F.col(quote_name(column)).cast("string") == F.lit(value)
    return F.when(hit, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def one_hot(df: DataFrame, vocab: Mapping[str, Sequence[str]], drop_first: bool = False) -> DataFrame:
    """One 0/1 column per vocabulary value, source columns dropped.

    NULL and unseen values give zeros everywhere. ``drop_first`` leaves out the first
    value of every column.
    """
    kept = [F.col(quote_name(c)) for c in df.columns if c not in vocab]
    dummies = [
        _indicator(c, v).alias(f"{c}_{v}")
        for c, values in vocab.items()
        for v in values[1 if drop_first else 0:]
    ]
    return df.select(*kept, *dummies)


def unseen_categories(df: DataFrame, vocab: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values a fitted vocabulary does not know, with their row count."""
    known = F.lit(False)
    for c, values in vocab.items():
        known = known | ((F.col("column") == c) & F.col("value").isin(list(values)))
    return category_vocab(df, list(vocab)).filter(~known)


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without any NULL in the given (default: all) columns."""
    held = F.lit(True)
    for c in columns if columns is not None else df.columns:
        value = F.col(quote_name(c))
        held = held & value.isNotNull()
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            held = held & ~F.isnan(value)
    return df.filter(held)


def rename_clean(df: DataFrame) -> DataFrame:
    """P3 applied to all columns."""
    return df.toDF(*clean_names(df.columns))


def select_supported(df: DataFrame, supported: Sequence[str]) -> DataFrame:
    """Exactly the supported columns; extra ones are ignored, missing ones an error."""
    missing = [c for c in supported if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[quote_name(c) for c in supported])


def select_signature(df: DataFrame, signature: T.StructType) -> DataFrame:
    """The model's input columns, checked by name and cast to the signature type."""
    select_supported(df, signature.names)
    wrong = [
        f"{f.name}: {df.schema[f.name].dataType.simpleString()} is not {f.dataType.simpleString()}"
        for f in signature
        if isinstance(f.dataType, T.NumericType) != isinstance(df.schema[f.name].dataType, T.NumericType)
    ]
    if wrong:
        raise TypeError("signature mismatch: " + "; ".join(wrong))
    return df.select(*[F.col(quote_name(f.name)).cast(f.dataType).alias(f.name) for f in signature])


def with_signature(df: DataFrame, signature: T.StructType) -> DataFrame:
    """P17 for a batch that is scored: all its columns, those of the signature checked by name and kind and cast to its types."""
    checked = select_signature(df, signature)
    return df.withColumns({f.name: F.col(quote_name(f.name)).cast(f.dataType) for f in checked.schema})


def signature_type(fields: Sequence) -> T.StructType:
    """A stored signature, (name, type) rows, as a schema."""
    return T.StructType([T.StructField(f["name"], T._parse_datatype_string(f["type"])) for f in fields])


@dataclass
class FeatureSpec:
    """P5: the fitted featuriser: encode, map the label, clean names, drop NULL rows.

    ``wide`` names categorical columns whose values are too many for columns of their own: they stay as they are, also
    where they are NULL, for a :class:`WideEncoder` that turns them into one sparse vector.
    """

    categoricals: Sequence[str]
    label: str | None = None
    label_map: Mapping[str, int] = field(default_factory=lambda: {"Yes": 1, "No": 0})
    vocab: dict[str, list[str]] | None = None
    wide: Sequence[str] = ()

    def fit(self, df: DataFrame) -> FeatureSpec:
        vocab = fit_vocab(df, self._narrow()) if self._narrow() else {}
        return FeatureSpec(self.categoricals, self.label, self.label_map, vocab, self.wide)

    def _narrow(self) -> list[str]:
        return [c for c in self.categoricals if c not in self.wide]

    def transform(self, df: DataFrame, training: bool = True) -> DataFrame:
        """Training drops rows with a NULL feature or label; scoring keeps unlabelled rows."""
        if self.vocab is None:
            raise ValueError("fit the spec first")
        out = one_hot(df, {c: self.vocab[c] for c in self._narrow()})
        if self.label and self.label in out.columns:
            mapped = value_map(self.label, self.label_map)
            out = out.select(*[
                mapped.alias(c) if c == self.label else F.col(quote_name(c)) for c in out.columns])
        wide = [n for c, n in zip(out.columns, clean_names(out.columns)) if c in self.wide]
        out = rename_clean(out)
        label = clean_names([self.label])[0] if self.label else None
        required = [c for c in out.columns if c not in wide and (training or c != label)]
        return drop_nulls(out, required)

    def to_dict(self) -> dict:
        return {
            "categoricals": list(self.categoricals),
            "label": self.label,
            "label_map": dict(self.label_map),
            "vocab": self.vocab,
            "wide": list(self.wide),
        }

    @staticmethod
    def from_dict(state: Mapping) -> FeatureSpec:
        return FeatureSpec(state["categoricals"], state["label"], state["label_map"], state["vocab"], state.get("wide", ()))


# --- imputation and scaling ---------------------------------------------------

@dataclass
class NumericSpec:
    """Coerce to double, fill with the mean, standardise with the
    population deviation. Statistics come from the rows it was fitted on."""

    columns: Sequence[str]
    means: dict[str, float] | None = None
    scales: dict[str, float] | None = None

    def fit(self, df: DataFrame) -> NumericSpec:
        """One aggregate. Filling with the mean keeps the mean and shrinks the deviation
        by the share of filled rows, so no second pass is needed."""
        exprs = [F.count(F.lit(1)).alias("_rows")]
        for c in self.columns:
            x = try_numeric(c)
            exprs += [F.avg(x).alias(f"_m_{c}"), F.var_pop(x).alias(f"_v_{c}"), F.count(x).alias(f"_n_{c}")]
        stats = df.agg(*exprs).first()
        empty = [c for c in self.columns if not stats[f"_n_{c}"]]
        if empty:
            raise ValueError(f"no numeric value to fit on: {empty}")
        means = {c: float(stats[f"_m_{c}"]) for c in self.columns}
        scales = {
            c: (stats[f"_v_{c}"] * stats[f"_n_{c}"] / stats["_rows"]) ** 0.5 for c in self.columns
        }
        return NumericSpec(self.columns, means, scales)

    def impute(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self._filled(c) for c in self.columns})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self._scaled(c) for c in self.columns})

    def _filled(self, c: str) -> Column:
        return F.coalesce(try_numeric(c), F.lit(self.means[c]))

    def _scaled(self, c: str) -> Column:
        centred = self._filled(c) - F.lit(self.means[c])
        return centred / F.lit(self.scales[c]) if self.scales[c] else centred * F.lit(0.0)


def mode_values(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-NULL value per column; ties go to the greatest value."""
    best = (
        category_vocab(df, columns)
        .groupBy("column")
        .agg(F.max(F.struct("n", "value")).alias("best"))
        .select("column", "best.value")
        .collect()
    )
    found = {r["column"]: r["value"] for r in best}
    return {c: found.get(c) for c in columns}


def mode_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    modes = mode_values(df, columns)
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(modes[c]).cast(df.schema[c].dataType)) for c in columns
    })


def fit_labels(df: DataFrame, column: str) -> DataFrame:
    """the classes of a label column as (value, index), the index by sorted value.

    A table of any size: classes are numbered by ranges of the value, see :func:`numbered`.
    """
    classes = category_vocab(df, [column]).select("value")
    return numbered(classes, ["value"]).withColumn("index", F.col("index").cast("int"))


def label_encode(df: DataFrame, column: str, classes: DataFrame, output: str) -> DataFrame:
    """position of the class among the sorted ones; an unknown class and NULL give NULL."""
    known = classes.select(F.col("value").alias("_value"), F.col("index").alias(output))
    return df.drop(output).join(known, F.col(quote_name(column)).cast("string") == F.col("_value"), "left").drop("_value")


@dataclass
class WideEncoder:
    """P1, P5, F1 for columns of any number of values: one sparse vector, a slot per value.

    The values of all columns are a table (column, value, slot) that is never collected: slots follow the columns and
    then the sorted values. Rows get their slots by joins; NULL and unseen values are zeros.
    """

    columns: Sequence[str]
    output: str = "encoded"
    slots: DataFrame | None = None
    model: PipelineModel | None = None

    def fit(self, df: DataFrame) -> WideEncoder:
        order = F.create_map(*[x for i, c in enumerate(self.columns) for x in (F.lit(c), F.lit(i))])
        values = category_vocab(df, self.columns).select("column", "value", order[F.col("column")].alias("_place"))
        slots = staged(numbered(values, ["_place", "value"], "slot").drop("_place"), "slots")
        found = {r["column"]: (r["first"], r["n"]) for r in slots.groupBy("column").agg(
            F.min("slot").alias("first"), F.count(F.lit(1)).alias("n")).collect()}  # a row per column
        index = F.col("slot") - F.create_map(*[x for c, (first, _) in found.items() for x in (F.lit(c), F.lit(first))])[F.col("column")] if found else F.col("slot")
        encoder = OneHotEncoder(inputCols=self._indexes(), outputCols=[f"_v_{i}" for i in range(len(self.columns))], handleInvalid="keep", dropLast=True)
        # A row of the highest indexes tells the encoder its sizes; the values themselves stay in the table.
        highest = df.sparkSession.createDataFrame([tuple(float(max(found.get(c, (0, 0))[1] - 1, 0)) for c in self.columns)], self._indexes())
        joined = VectorAssembler(inputCols=encoder.getOutputCols(), outputCol=self.output)
        return WideEncoder(self.columns, self.output, slots.withColumn("index", index), Pipeline(stages=[encoder, joined]).fit(highest))

    def _indexes(self) -> list[str]:
        return [f"_i_{i}" for i in range(len(self.columns))]

    def transform(self, df: DataFrame) -> DataFrame:
        if self.slots is None:
            raise ValueError("fit the encoder first")
        out = df
        for name, column in zip(self._indexes(), self.columns):
            known = self.slots.filter(F.col("column") == column).select("value", "index")
            out = label_encode(out, column, known, name).withColumn(name, F.coalesce(F.col(name).cast("double"), F.lit(UNSEEN)))
        return self.model.transform(out).drop(*self._indexes(), *[f"_v_{i}" for i in range(len(self.columns))])

    def save(self, path: str) -> None:
        self.slots.write.mode("overwrite").parquet(f"{path}/slots")
        self.model.write().overwrite().save(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> WideEncoder:
        model = PipelineModel.load(f"{path}/model")
        slots = spark.read.parquet(f"{path}/slots")
        names = {r["column"]: r["first"] for r in slots.groupBy("column").agg(F.min("slot").alias("first")).collect()}
        return WideEncoder(sorted(names, key=names.get), model.stages[-1].getOutputCol(), slots, model)


def wide_one_hot(df: DataFrame, columns: Sequence[str], output: str = "encoded") -> WideEncoder:
    """The fitted :class:`WideEncoder` of some columns."""
    return WideEncoder(list(columns), output).fit(df)


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """one vector column (sparse or dense, whichever is smaller)."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)

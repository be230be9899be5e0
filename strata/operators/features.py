"""Feature encoding with Spark ML transformers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import projection
from strata.operators.clean import fill_constant
from strata.operators.prefix import row_numbers
from strata.operators.quantiles import clean_value
from strata.runtime import as_list, attach, pin

# Labels of a Spark ML indexer live on the driver and inside every task; ``index_strings`` has no such limit.
MAX_LABELS = 1_000_000


def complete_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Fill every feature: 0.0 for numbers, ``missing`` for text, so assembling cannot fail."""
    if numeric:
        df = fill_constant(df, 0.0, numeric)
    return fill_constant(df, "missing", categorical) if categorical else df


#: What a filled feature is called beside its raw column.
FILLED = "_full"


def fill_stage(numeric: Sequence[str], categorical: Sequence[str], number: float = 0.0, text: str = "missing") -> SQLTransformer:
    """Filling as a stage that is stored with its model: ``complete_features`` for rows as they arrive.

    Each feature gets a column of its own next to the raw one, so keys, labels and raw values pass
    through.  Text that is no number, NaN and NULL count as missing; infinity does as well, since
    a model cannot place it.
    """
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    made = []
    for c in numeric:
        v = f"try_cast({quoted(c)} AS DOUBLE)"
        made.append(f"CASE WHEN abs({v}) < double('infinity') THEN {v} ELSE {float(number)!r} END AS {quoted(c + FILLED)}")
    literal = "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    made += [f"coalesce(CAST({quoted(c)} AS STRING), {literal}) AS {quoted(c + FILLED)}" for c in categorical]
    return SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__")


def raw_stages(numeric: Sequence[str], categorical: Sequence[str], *last, **encoding) -> list:
    """Fill, index, one-hot, assemble, and then ``last``: a pipeline that fits and scores raw rows.

    A label that was not seen in fitting shares an index with no other label, so it never ends a job or a stream.
    """
    return [
        fill_stage(numeric, categorical),
        *encoder_stages([c + FILLED for c in numeric], [c + FILLED for c in categorical], **encoding),
        *last,
    ]


def check_cardinality(df: DataFrame, categorical: Sequence[str], max_labels: int = MAX_LABELS) -> None:
    """Refuse to index a near-unique text column; collapse it with ``top_k_categories`` first."""
    row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in categorical]).first().asDict()
    wide = {c: n for c, n in row.items() if n > max_labels}
    if wide:
        raise ValueError(f"too many categories to index: {wide}")


def string_indexer(cols: Sequence[str], suffix: str = "_idx") -> StringIndexer:
    """Label to rank by frequency (ties by value); unseen and NULL share one extra index."""
    return StringIndexer(
        inputCols=list(cols),
        outputCols=[f"{c}{suffix}" for c in cols],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def label_table(df: DataFrame, col: str) -> DataFrame:
    """(__label, __rows, __rank) of every label: rows that have it, and its rank by frequency (ties by value); stored."""
    counts = df.groupBy(F.col(col).cast("string").alias("__label")).agg(F.count(F.lit(1)).alias("__rows")).filter("__label IS NOT NULL")
    ranked = row_numbers(counts.withColumn("__rare", -F.col("__rows")), ["__rare", "__label"], "__rank")
    return pin(ranked.select("__label", "__rows", "__rank"))


def _indexed(df: DataFrame, cols: Sequence[str], suffix: str) -> tuple[DataFrame, list[int]]:
    """``df`` with the index of each column, and how many labels each has."""
    out, labels = df, []
    for c in cols:
        ranked = label_table(df, c)
        labels.append(ranked.count())
        found = attach(out.withColumn("__label", F.col(c).cast("string")), ranked, "__label", "__rows")
        index = F.coalesce("__rank", F.lit(labels[-1])).cast("double")
        out = found.withColumn(f"{c}{suffix}", index).drop("__label", "__rows", "__rank")
    return out, labels


def index_strings(df: DataFrame, cols: str | Sequence[str], suffix: str = "_idx") -> DataFrame:
    """Add the label's rank by frequency (ties by value) as a DOUBLE; NULL comes after the last label.

    Labels are counted, ranked and joined back as tables, so a column may have any number of them.
    """
    return _indexed(df, as_list(cols), suffix)[0]


def one_hot_slots(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], out: str = "slots") -> tuple[DataFrame, int]:
    """(``df`` with its sparse feature vector as a list of (slot, value), length of the vector).

    Numbers take the first slots and are left out where they are 0, NULL or NaN; a category has a
    slot per label, by frequency, and one for NULL.  Labels stay in tables, so a vector may have
    any width, and a row holds as many entries as it has columns.
    """
    indexed, labels = _indexed(df, categorical, "__slot")
    entry = lambda slot, value: F.struct(slot.cast("long").alias("slot"), value.alias("value"))
    parts = []
    for i, c in enumerate(numeric):
        v = clean_value(df, c)
        parts.append(F.when(v != 0, entry(F.lit(i), v)))
    width = len(numeric)
    for c, n in zip(categorical, labels):
        parts.append(entry(F.col(f"{c}__slot") + F.lit(width), F.lit(1.0)))
        width += n + 1
    made = indexed.withColumn(out, F.filter(F.array(*parts), lambda e: e.isNotNull()))
    return made.drop(*[f"{c}__slot" for c in categorical]), width


def encoder_stages(
    numeric: Sequence[str],
    categorical: Sequence[str],
    out: str = "features",
    drop_last: bool = False,
    keep_invalid: bool = False,
    scale: bool = False,
) -> list:
    """Index, one-hot and assemble; with ``scale`` also divide by the sample deviation."""
    stages: list = []
    inputs = list(numeric)
    if categorical:
        stages.append(string_indexer(categorical))
        stages.append(
            OneHotEncoder(
                inputCols=[f"{c}_idx" for c in categorical],
                outputCols=[f"{c}_ohe" for c in categorical],
                dropLast=drop_last,
                handleInvalid="keep" if keep_invalid else "error",
            )
        )
        inputs += [f"{c}_ohe" for c in categorical]
    assembled = f"{out}_raw" if scale else out
    stages.append(VectorAssembler(inputCols=inputs, outputCol=assembled))
    if scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol=out, withStd=True, withMean=False))
    return stages


def fit_encoder(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], max_labels: int = MAX_LABELS, **kw
) -> PipelineModel:
    """Fit the encoding once, on training rows; it then applies to any rows.

    A one-hot slot per label: more than ``max_labels`` in a column is an error.
    """
    if categorical:
        check_cardinality(df, categorical, max_labels)
    return Pipeline(stages=encoder_stages(numeric, categorical, **kw)).fit(df)


def feature_slots(df: DataFrame, features: str = "features") -> list[tuple[int, str, str]]:
    """(slot, name, source column) of an assembled vector, from its metadata alone."""
    attrs = df.schema[features].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    sources = {f"{c[:-4]}_ohe_": c[:-4] for c in df.columns if c.endswith("_ohe")}

    def source(name: str) -> str:
        hits = [prefix for prefix in sources if name.startswith(prefix)]
        return sources[max(hits, key=len)] if hits else name

    return [(i, name, source(name)) for i, name in slots]


def vector_width(df: DataFrame, features: str = "features") -> int:
    """Length of the vector without running a job."""
    return df.schema[features].metadata["ml_attr"]["num_attrs"]


def one_hot_counts(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """(column, slot, n): how many rows light up each one-hot slot."""
    cols = as_list(cols)
    indexed = index_strings(df, cols)
    return (
        indexed.select(*[F.col(f"{c}_idx").cast("int").alias(c) for c in cols])
        .unpivot([], cols, "column", "slot")
        .groupBy("column", "slot")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def standardize(df: DataFrame, cols: Sequence[str], center: bool = False, suffix: str = "_std") -> DataFrame:
    """Add ``x / stddev_samp(x)`` per column (0.0 for a constant column); NaN is missing and becomes NULL."""
    stats = df.agg(
        F.struct(
            *[F.stddev_samp(clean_value(df, c)).alias(f"s{i}") for i, c in enumerate(cols)],
            *[F.avg(clean_value(df, c)).alias(f"m{i}") for i, c in enumerate(cols)],
        )
    ).scalar()
    new = {}
    for i, c in enumerate(cols):
        v = clean_value(df, c)
        sd = stats.getField(f"s{i}")
        shifted = v - stats.getField(f"m{i}") if center else v
        new[f"{c}{suffix}"] = F.when(sd == 0, F.when(v.isNotNull(), F.lit(0.0))).otherwise(shifted / sd)
    return df.withColumns(new)


def pca(df: DataFrame, features: str = "features", k: int = 2, out: str = "pca") -> DataFrame:
    """Project onto the first ``k`` principal components of the centred features; see ``projection``."""
    return projection.project(df, projection.components(df, features, k), features, out)


def array_to_features(df: DataFrame, col: str, width: int | None = None, out: str = "features") -> DataFrame:
    """An ML vector with slot metadata from an array column; its width is the longest array's.

    A given ``width`` is checked on every row: an array of another length is an error, never
    cut or filled.  NULL arrays are an error as well.
    """
    if width is None:
        width = df.agg(F.max(F.size(col))).first()[0] or 0
    fits = F.coalesce(F.size(col) == width, F.lit(False))
    wrong = F.concat(F.lit(f"array in {col} is not of {width} elements but of "), F.coalesce(F.size(col).cast("string"), F.lit("NULL")))
    df = df.withColumn(col, F.when(fits, F.col(col)).otherwise(F.raise_error(wrong)))
    parts = [f"{col}_{i}" for i in range(width)]
    flat = df.withColumns({p: F.get(col, F.lit(i)).cast("double") for i, p in enumerate(parts)})
    return VectorAssembler(inputCols=parts, outputCol=out).transform(flat).drop(*parts)



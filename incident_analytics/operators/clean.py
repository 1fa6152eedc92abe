"""Projections, filters and cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed
from incident_analytics.functions.scalar import ColumnOrName, as_col


def _all(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


# --- column lists -----------------------------------------------------------------

def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[c for c in cols if c in df.columns])


def drop_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def ensure_cols(df: DataFrame, cols: Sequence[tuple[str, str]]) -> DataFrame:
    """Add each missing column as a null of its type."""
    missing = {c: F.lit(None).cast(t) for c, t in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def cast_rename(df: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Replace each mapped column by its cast under the new name.

    A value that does not cast becomes null; unmapped columns stay as they are.
    """
    def project(c: str) -> Column:
        quoted = F.col(f"`{c}`")
        if c not in mapping:
            return quoted
        name, kind = mapping[c]
        return quoted.try_cast(kind).alias(name)

    return df.select(*[project(c) for c in df.columns])


def resolve_col(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate the frame has, ignoring case, as spelled in the frame."""
    actual = {c.lower(): c for c in df.columns}
    return next((actual[c.lower()] for c in candidates if c.lower() in actual), None)


def severity_col(df: DataFrame, predicted: bool = False) -> str | None:
    """Actual or predicted severity column, falling back to the other kind."""
    kinds = [fixed.ACTUAL_SEVERITY_NAMES, fixed.PREDICTED_SEVERITY_NAMES]
    first, second = reversed(kinds) if predicted else kinds
    return resolve_col(df, [*first, *second])


# --- row filters -------------------------------------------------------------------

def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a value in every listed column."""
    return df.filter(_all(F.col(c).isNotNull() for c in cols))


def dropna_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """`require` on those of the listed columns that exist."""
    return require(df, [c for c in cols if c in df.columns])


def drop_non_finite(df: DataFrame, cols: Sequence[str], keep_null: bool = False) -> DataFrame:
    """Drop rows with NaN or an infinity in any column; nulls go too by default."""
    def usable(c: str) -> Column:
        x = F.col(c).cast("double")
        finite = ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
        return x.isNull() | finite if keep_null else x.isNotNull() & finite

    return df.filter(_all(usable(c) for c in cols))


def label_range(df: DataFrame, c: str, lo: int = 1, hi: int = 4) -> DataFrame:
    """Integer labels within lo..hi; others, and values that do not cast, go."""
    return df.withColumn(c, F.col(c).try_cast("int")).filter(F.col(c).between(lo, hi))


def clean_key(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Trim the key columns as text and drop rows with a null or blank key."""
    trimmed = df.withColumns({c: F.trim(F.col(c).cast("string")) for c in cols})
    return trimmed.filter(_all(F.col(c) != "" for c in cols))


def filter_or_all(df: DataFrame, cond: Column) -> DataFrame:
    """Rows that meet the condition, or every row if none does.

    The guard is an uncorrelated EXISTS: one probe that stops at its first hit.
    """
    return df.filter(F.coalesce(cond, F.lit(False)) | ~df.filter(cond).exists())


def pick_populated(df: DataFrame, a: str, b: str, blank_is_empty: bool = False) -> str:
    """`a` if it has any usable value, else `b`.

    Runs a probe on column `a` alone, so that the plan built from the answer
    reads only the column it needs.
    """
    usable = F.col(a).isNotNull()
    if blank_is_empty:
        usable = usable & (F.trim(F.col(a).cast("string")) != "")
    return b if df.select(a).filter(usable).isEmpty() else a


def facet_filter(
    df: DataFrame,
    years: Sequence[int] = (),
    states: Sequence[str] = (),
    weather: Sequence[str] = (),
) -> DataFrame:
    """Dashboard selections. An empty selection or a missing column filters nothing.

    States compare in upper case and come out in upper case.
    """
    year_col = resolve_col(df, fixed.YEAR_NAMES)
    state_col = resolve_col(df, fixed.EDGE_STATE_NAMES)
    weather_col = resolve_col(df, fixed.WEATHER_NAMES)
    if year_col and years:
        df = df.filter(F.col(year_col).try_cast("int").isin(*years))
    if state_col and states:
        df = df.withColumn(state_col, F.upper(F.col(state_col).cast("string")))
        df = df.filter(F.col(state_col).isin(*states))
    if weather_col and weather:
        df = df.filter(F.col(weather_col).cast("string").isin(*weather))
    return df


# --- values --------------------------------------------------------------------------

def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls in those of the mapped columns that exist."""
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def number(c: ColumnOrName, fill0: bool = False) -> Column:
    """Double from anything; what does not convert is null, or 0 with `fill0`."""
    x = as_col(c).cast("string").try_cast("double")
    return F.coalesce(x, F.lit(0.0)) if fill0 else x


def to_num(df: DataFrame, c: str, fill0: bool = False) -> DataFrame:
    return df.withColumn(c, number(c, fill0)) if c in df.columns else df


def to_int(df: DataFrame, c: str) -> DataFrame:
    """Column as bigint, unless it holds a fractional number: then as it was.

    Text that is no number becomes null. Runs a probe for a fractional value.
    """
    x = number(c)
    if df.filter(x != F.floor(x)).isEmpty():
        return df.withColumn(c, x.try_cast("bigint"))
    return df


# --- facets ----------------------------------------------------------------------------

FACETS = {"year": ("year",), "state": ("state", "State"), "weather": ("weather_bucket", "weather")}


def facets(
    df: DataFrame,
    year: str = "year",
    state: str = "State",
    weather: str = "weather_bucket",
    default_states: int = 8,
) -> DataFrame:
    """Values of the three facets of one table, with the ones selected at the start.

    One scan finds the combinations that occur.
    """
    combos = df.select(year, state, weather).distinct()
    return _with_defaults(_facet_values(combos, {"year": year, "state": state, "weather": weather}), default_states)


def facets_of(marts: Sequence[DataFrame], default_states: int = 8) -> DataFrame:
    """Values of the facets over several marts, each of which gives those that it has a column for.

    A facet's column is the first existing one of its names in `FACETS`; a facet that no mart
    has gives no rows. Each mart is scanned once, only in its facet columns.
    """
    found = []
    for mart in marts:
        columns = {facet: resolve_col(mart, names) for facet, names in FACETS.items()}
        columns = {facet: c for facet, c in columns.items() if c}
        if columns:
            found.append(_facet_values(mart.select(*columns.values()).distinct(), columns))
    if not found:
        raise ValueError("no mart has a facet column")
    return _with_defaults(reduce(DataFrame.unionByName, found).distinct(), default_states)


def _facet_values(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """facet, value: years as whole numbers, states in capitals, nulls left out."""
    def value(facet: str, c: str) -> Column:
        text = F.col(c).cast("string")
        return {"year": F.col(c).try_cast("int").cast("string"), "state": F.upper(text), "weather": text}[facet]

    pairs = F.array(*[F.struct(F.lit(facet).alias("facet"), value(facet, c).alias("value")) for facet, c in columns.items()])
    return df.select(F.inline(pairs)).dropna().distinct()


def _with_defaults(values: DataFrame, default_states: int) -> DataFrame:
    """Selected at the start: years 2023 and 2022 if 2023 occurs, else the latest; the first states; all weather.

    The windows run over the few values of a facet.
    """
    facet = Window.partitionBy("facet")
    years = F.when(F.col("facet") == "year", F.col("value").try_cast("int"))
    has_2023 = F.max(F.when(years == 2023, 1)).over(facet).isNotNull()
    default = (
        F.when(F.col("facet") == "weather", True)
        .when(F.col("facet") == "state",
              F.row_number().over(facet.orderBy("value")) <= default_states)
        .when(has_2023, years.isin(2023, 2022))
        .otherwise(years == F.max(years).over(facet))
    )
    return values.withColumn("is_default", default).orderBy("facet", "value")


def selected_point(points: DataFrame, states: Sequence[str]) -> DataFrame:
    """The map point of the selected state; no row unless exactly one is selected."""
    if len(states) != 1:
        return points.filter(F.lit(False))
    name = fixed.STATE_BY_CODE.get(states[0].upper(), states[0])
    return points.filter(F.col("StateName") == name)

"""Scalar functions: Column in, Column out, all JVM-side."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics import fixed_values as fixed

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time ---------------------------------------------------------------------

def parse_ts(c: ColumnOrName) -> Column:
    """Timestamp from text; malformed text gives null, also under ANSI mode."""
    return F.try_to_timestamp(as_col(c))


def year_month(ts: ColumnOrName) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM")


def dow_name(ts: ColumnOrName) -> Column:
    """Day name, Mon to Sun."""
    return F.date_format(as_col(ts), "E")


def is_weekend(ts: ColumnOrName) -> Column:
    return dow_name(ts).isin("Sat", "Sun")


def is_night(c: ColumnOrName) -> Column:
    return as_col(c) == F.lit("Night")


def epoch_sec(ts: ColumnOrName) -> Column:
    return F.unix_seconds(as_col(ts).cast("timestamp"))


def duration_min(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minutes between two timestamps, taken on whole seconds."""
    return (epoch_sec(end) - epoch_sec(start)) / F.lit(60.0)


def null_outliers(c: ColumnOrName, lo: float, hi: float) -> Column:
    """Null below `lo` or above `hi`; both bounds are kept."""
    return F.when(as_col(c).between(lo, hi), as_col(c))


def time_features(df: DataFrame, source: str = "Start_Time") -> DataFrame:
    """Add start_ts, hour, dow (1 = Sunday) and is_weekend as 0/1.

    A frame without the source column comes back as it is.
    """
    if source not in df.columns:
        return df
    ts = parse_ts(source)
    day = F.dayofweek(ts)
    return df.withColumns({
        "start_ts": ts,
        "hour": F.hour(ts),
        "dow": day,
        "is_weekend": F.when(day.isin(1, 7), 1).otherwise(0),
    })


def ensure_month_num(df: DataFrame) -> DataFrame:
    """Add month_num from the first source the frame has.

    Order: an existing month_num, the "yyyy-MM" month, the parsed start, the
    start text. With none of them the month is 1, with a warning.
    """
    cols = df.columns
    if "month_num" in cols:
        return df
    if "month" in cols:
        month = F.substring(F.col("month").cast("string"), 6, 2).try_cast("int")
    elif "Start_Time_ts" in cols:
        month = F.month("Start_Time_ts")
    elif "Start_Time" in cols:
        month = F.month(parse_ts("Start_Time"))
    else:
        warnings.warn("no column to take the month from: month_num is 1", stacklevel=2)
        month = F.lit(1)
    return df.withColumn("month_num", month)


# --- text and flags -------------------------------------------------------------

def to_bool(c: ColumnOrName) -> Column:
    """Boolean from "True"/"False" text; null and other text give null."""
    return as_col(c).try_cast("boolean")


def bool_to_int(c: ColumnOrName) -> Column:
    """1 or 0 from a boolean, number or text; other text gives null."""
    text = F.lower(as_col(c).cast("string"))
    return (
        F.when(text.isin("true", "1"), 1)
        .when(text.isin("false", "0"), 0)
        .otherwise(text.try_cast("int"))
    )


def keyword_bucket(
    c: ColumnOrName,
    rules: Sequence[tuple[str, str]] = fixed.WEATHER_RULES,
    default: str = fixed.WEATHER_OTHER,
) -> Column:
    """Bucket of the first keyword the text contains, ignoring case."""
    text = F.lower(as_col(c))
    hits = [F.when(text.contains(word), F.lit(bucket)) for word, bucket in rules]
    return F.coalesce(*hits, F.lit(default))


def node_key(*parts: ColumnOrName) -> Column:
    """Parts joined by '|'; null parts are left out."""
    return F.concat_ws("|", *[as_col(p) for p in parts])


def node_part(c: ColumnOrName, i: int) -> Column:
    """Part `i` of a node key, null when the key has fewer parts."""
    return F.get(F.split(as_col(c), r"\|"), i)


def split_node(
    df: DataFrame, c: str = "node", state: str = "state", city: str = "city"
) -> DataFrame:
    return df.withColumns({state: node_part(c, 0), city: node_part(c, 1)})


def bucket_by(df: DataFrame, mode: str, fill: str | None = None) -> DataFrame:
    """Add the string column `bucket` for mode hour, weather, month or all.

    Each mode takes the first of its source columns that exists, else "all".
    `fill` replaces null buckets; without it nulls stay and form a group.
    """
    sources = {
        "hour": [("hour", F.col), ("Start_Time", lambda c: F.hour(parse_ts(c)))],
        "weather": [("weather_bucket", F.col), ("Weather_Condition", F.col)],
        "month": [("month", F.col), ("month_num", F.col)],
    }
    found = [make(c) for c, make in sources.get(mode.lower(), []) if c in df.columns]
    bucket = found[0].cast("string") if found else F.lit("all")
    return df.withColumn("bucket", F.coalesce(bucket, F.lit(fill)) if fill else bucket)


# --- severity -------------------------------------------------------------------

def band(c: ColumnOrName) -> Column:
    """low up to 2, medium at 3, high above, unknown for null."""
    c = as_col(c)
    return (
        F.when(c.isNull(), "unknown").when(c <= 2, "low").when(c == 3, "medium").otherwise("high")
    )


def severity_label(c: ColumnOrName, keep_other: bool = True) -> Column:
    """Low, Medium, High or Very High from a number (truncated) or a spelling.

    Any other value is kept as text, or becomes null with `keep_other=False`.
    """
    text = as_col(c).cast("string")
    number = F.trim(text).try_cast("double")
    word = F.lower(F.trim(text))
    hits = [
        F.when(((number >= rank) & (number < rank + 1))
               | word.isin(fixed.SEVERITY_SPELLINGS[label]), F.lit(label))
        for rank, label in enumerate(fixed.SEVERITY_LABELS, start=1)
    ]
    return F.coalesce(*hits, text) if keep_other else F.coalesce(*hits)


def severity_rank(label: ColumnOrName) -> Column:
    """Position of a label, 1 to 4; null for any other text."""
    rank = F.array_position(F.array(*map(F.lit, fixed.SEVERITY_LABELS)), as_col(label))
    return F.nullif(rank, F.lit(0)).cast("int")


def index_to_label(idx: ColumnOrName, labels: Sequence[str] | None) -> Column:
    """Original integer label of a predicted index.

    Without labels the result is index + 1; an index past the labels, or a label
    that is no integer, gives null.
    """
    idx = as_col(idx).cast("int")
    if labels is None:
        return idx + 1
    values = F.array(*[F.lit(s).cast("string").try_cast("int") for s in labels])
    return F.when(idx >= 0, F.get(values, idx))


def confidence(probabilities: ColumnOrName) -> Column:
    """Largest class probability of an array."""
    return F.array_max(as_col(probabilities))


# --- geography and scores ---------------------------------------------------------

def lookup(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(table, as_col(c))


def state_name(c: ColumnOrName) -> Column:
    """Name of a state code, ignoring case and blanks; other text is trimmed."""
    text = F.trim(as_col(c).cast("string"))
    return F.coalesce(lookup(F.upper(text), fixed.STATE_BY_CODE), text)


def least(*cols: ColumnOrName) -> Column:
    """Smallest value, nulls left out."""
    return F.least(*[as_col(c) for c in cols])


def risk_score(n: ColumnOrName, avg: ColumnOrName, null_as_zero: bool = False) -> Column:
    factors = [as_col(n), as_col(avg)]
    if null_as_zero:
        factors = [F.coalesce(c, F.lit(0)) for c in factors]
    return reduce(lambda a, b: a * b, factors)


def edge_risk(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Mean of two endpoint values; null if either is null."""
    return (as_col(a) + as_col(b)) / F.lit(2.0)


def map_measures(df: DataFrame, name: str = "StateName", cases: str = "Cases") -> DataFrame:
    """Add the bubble radius and the tooltip of a map point."""
    n = F.col(cases)
    return df.withColumns({
        "radius": F.sqrt(F.greatest(n, F.lit(0)).cast("double")),
        "tooltip": F.concat(F.col(name), F.lit("\nCases: "), F.format_number(n.cast("long"), 0)),
    })

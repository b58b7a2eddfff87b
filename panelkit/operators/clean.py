"""Cleaning operators for utility sales tables and facility lists.

Every operator is DataFrame -> DataFrame with column names as arguments.
Grouping steps use partial (map-side) aggregation, so a hot group is reduced
in every task before the shuffle; no step collects a group's rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from panelkit import schemas as S
from panelkit.functions.exprs import (normalize_key, normalize_name, not_in_codes,
                                      safe_double, safe_int, unit_price)


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "input") -> DataFrame:
    """fail early, naming the missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required column(s) {missing}; has {df.columns}")
    return df


def size_filter(df: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """every listed column strictly above its threshold (NULL drops)."""
    cond: Column | None = None
    for c, t in thresholds.items():
        term = F.col(c) > F.lit(t)
        cond = term if cond is None else cond & term
    return df if cond is None else df.filter(cond)


def min_size_filter(df: DataFrame, column: str = "Customers", minimum: float = 0) -> DataFrame:
    """``column >= minimum``; a minimum of 0 switches the step off."""
    if not minimum:
        return df
    if column not in df.columns:
        return df
    return df.filter(F.col(column) >= F.lit(minimum))


def exclude_codes(df: DataFrame, column: str = "Utility_ID",
                  codes: Iterable[int] = S.ADJUSTMENT_CODES) -> DataFrame:
    """drop adjustment codes, compared as numbers; NULL keys drop too."""
    return df.filter(not_in_codes(column, codes))


def cast_columns(df: DataFrame, ints: Sequence[str] = (), doubles: Sequence[str] = ()) -> DataFrame:
    """Text -> int (through double) / text -> double, bad -> NULL."""
    cols = {c: safe_int(c) for c in ints}
    cols.update({c: safe_double(c) for c in doubles})
    return df.withColumns(cols) if cols else df


def with_unit_price(df: DataFrame, *, revenue: str = "Revenue_Thousands",
                    sales: str = "Sales_MWh", out: str = "Price_Per_kWh") -> DataFrame:
    """price = revenue / sales; NULL side or zero sales -> NULL."""
    return df.withColumn(out, unit_price(revenue, sales))


def normalize_text(df: DataFrame, *, names: Sequence[str] = ("Utility_Name",),
                   keys: Sequence[str] = ("State",)) -> DataFrame:
    """Trim names; trim + upper-case keys."""
    cols = {c: normalize_name(c) for c in names if c in df.columns}
    cols.update({c: normalize_key(c) for c in keys if c in df.columns})
    return df.withColumns(cols)


def conform_schema(df: DataFrame, required: Sequence[str] = S.REQUIRED_COLUMNS,
                   types: Mapping[str, T.DataType] = S.REQUIRED_TYPES,
                   keep: Sequence[str] = ()) -> DataFrame:
    """P10 + P11: add each missing required column as a typed NULL, then
    project in the required order (plus any ``keep`` columns at the end)."""
    missing = {c: F.lit(None).cast(types[c]) for c in required if c not in df.columns}
    if missing:
        df = df.withColumns(missing)
    return df.select(*required, *[c for c in keep if c in df.columns])


def conform_rows(df: DataFrame, fields: Sequence[str] = S.LIST_FIELDS,
                 placement: Mapping[str, str] = S.LIST_TO_FACILITY,
                 target: Sequence[str] = S.FACILITY_COLUMNS) -> DataFrame:
    """Positional columns (``df.columns[i]`` is ``fields[i]``) -> the
    15-column facility layout; target columns without a source are NULL text."""
    by_field = dict(zip(fields, df.columns))
    src_for = {dst: by_field[f] for f, dst in placement.items()}
    return df.select([
        (F.col(src_for[t]) if t in src_for else F.lit(None).cast("string")).alias(t)
        for t in target
    ])


def consolidate_duplicates(df: DataFrame, *, keys: Sequence[str] = ("Utility_Name", "State", "Year"),
                           first: str = "Utility_ID", order: str | Column | None = None,
                           sums: Sequence[str] = ("Revenue_Thousands", "Sales_MWh", "Customers"),
                           revenue: str = "Revenue_Thousands", sales: str = "Sales_MWh",
                           price: str = "Price_Per_kWh",
                           count_as: str | None = None) -> DataFrame:
    """A5: one row per key group.

    * rows are returned unchanged when a key or summed column is missing.
    * ``first``: first non-NULL value in ``order`` (a source line number from
      :func:`sources.csv.numbered_lines`, or the Column
      ``F.struct("_file", "_line")`` across files).  A distributed read has no implicit file order, so the caller
      names one; ``min_by`` keeps this a bounded two-value buffer per group.
      Without ``order`` the smallest non-NULL value is taken (deterministic).
    * ``sums``: NULLs skipped, an all-NULL group sums to 0.
    * price recomputed from the summed revenue and sales (0 -> NULL).
    * ``count_as``: optionally the number of source rows per group.
    """
    if any(c not in df.columns for c in (*keys, *sums)):
        return df
    aggs = []
    if first in df.columns:
        if order is None:
            aggs.append(F.min(first).alias(first))
        else:
            place = F.col(order) if isinstance(order, str) else order
            ordering = F.when(F.col(first).isNotNull(), place)
            aggs.append(F.min_by(first, ordering).alias(first))
    aggs += [F.coalesce(F.sum(c), F.lit(0).cast(df.schema[c].dataType)).alias(c)
             for c in sums]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    out = df.groupBy(*keys).agg(*aggs)
    return with_unit_price(out, revenue=revenue, sales=sales, out=price)


def duplicate_groups(df: DataFrame, keys: Sequence[str] = ("Utility_Name", "State"),
                     out: str = "n_rows") -> DataFrame:
    """Key groups holding more than one row."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
            .filter(F.col(out) > 1))


def detect_year(df: DataFrame, *, by: Sequence[str], year: str = S.YEAR_HEADER,
                out: str = "Year") -> DataFrame:
    """Most common year per group, smallest on ties (NULLs ignored).

    ``mode`` keeps a value -> count map per group; its size is the number of
    distinct years, so a hot group does not grow the buffer.
    """
    return df.groupBy(*by).agg(F.mode(F.col(year), True).alias(out))


def clean_step_counts(consolidated: DataFrame, *, count_col: str, keep_sizes: Column,
                      keep_codes: Column) -> DataFrame:
    """A10: one row of counts through the cleaning steps, in one pass.

    ``consolidated`` is the output of :func:`consolidate_duplicates` with
    ``count_as=count_col``: raw rows = sum of group sizes; then consolidated
    groups, groups passing the size filter, groups passing size and code
    filters.
    """
    return consolidated.agg(*_step_counts(count_col, keep_sizes, keep_codes))


def _step_counts(count_col: str, keep_sizes: Column, keep_codes: Column) -> list[Column]:
    return [F.sum(count_col).alias("n_raw"),
            F.count(F.lit(1)).alias("n_consolidated"),
            F.count_if(F.coalesce(keep_sizes, F.lit(False))).alias("n_size_ok"),
            F.count_if(F.coalesce(keep_sizes & keep_codes, F.lit(False))).alias("n_code_ok")]


STEP_COUNTS = ("n_raw", "n_consolidated", "n_size_ok", "n_code_ok")


def observed_step_counts(consolidated: DataFrame, *, count_col: str, keep_sizes: Column,
                         keep_codes: Column) -> tuple[DataFrame, Observation]:
    """A10 without a pass of its own: the rows of ``consolidated``, and the
    counts of :func:`clean_step_counts`, which are there (``.get``) once the rows
    have been written.

    Write the returned rows straight away, with no shuffle in between: the
    counts then belong to the tasks of the writing stage, each counted once,
    even when executors are lost and earlier stages run again.
    """
    seen = Observation()
    return consolidated.observe(seen, *_step_counts(count_col, keep_sizes, keep_codes)), seen


def observed_row(spark: SparkSession, seen: Observation) -> DataFrame:
    """The observed counts as one row (an empty table: no raw rows, as in the aggregate)."""
    got = seen.get
    return spark.createDataFrame([tuple(got[n] for n in STEP_COUNTS)],
                                 ", ".join(f"{n} long" for n in STEP_COUNTS))


#: Quotes are doubled inside quoted fields; a backslash is an ordinary character.
CSV_DIALECT = {"quote": '"', "escape": '"', "maxColumns": "200000"}
BAD_ROW = "_bad_row"


def ragged_schema(names: Sequence[str]) -> str:
    """Text columns plus the one that marks rows of another field count."""
    return ", ".join([*[f"`{n}` STRING" for n in names], f"`{BAD_ROW}` STRING"])


def ragged_rows_filter(lines: DataFrame, *, arity: int, column: str = "value",
                       names: Sequence[str] | None = None,
                       skip_line: str | None = None) -> DataFrame:
    """F7 + S8: keep lines with exactly ``arity`` CSV fields and parse them
    positionally into string columns.

    Blank lines and lines with too few or too many fields are dropped: the
    parser marks a row of another field count as bad, so each line is parsed
    once, however wide.  Empty fields are NULL.  A header line is *not*
    skipped unless given as ``skip_line`` (the original keeps it when it has
    the right arity).
    """
    names = list(names) if names else [f"_c{i}" for i in range(arity)]
    kept = lines.filter(F.length(column) > 0)
    if skip_line is not None:
        kept = kept.filter(F.col(column) != F.lit(skip_line))
    parsed = F.from_csv(F.col(column), ragged_schema(names),
                        {**CSV_DIALECT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_ROW})
    return (kept.select(parsed.alias("_r")).filter(F.col(f"_r.{BAD_ROW}").isNull())
            .select([F.col(f"_r.`{n}`").alias(n) for n in names]))


def clean_sheet(raw: DataFrame, *, file_col: str = "_file",
                year_header: str = S.YEAR_HEADER, keep: Sequence[str] = ()) -> DataFrame:
    """One raw sheet (or many, told apart by ``file_col``) -> the required
    8-column layout: header mapping, the sheet's year (most common
    ``year_header`` value per file, smallest on ties), numbers coerced
    (bad -> NULL), price recomputed, names trimmed, states trimmed and
    upper-cased, missing columns added as NULL.  ``keep`` carries extra
    columns through (e.g. ``_file``, ``_line`` for file-order rules)."""
    from panelkit.functions.headers import header_map

    mapping = header_map([c for c in raw.columns if c != file_col and c not in keep])
    # the mode of numbers: '2019' and '2019.0' are one year
    years = detect_year(raw.select(file_col, safe_int(F.col(f"`{year_header}`")).alias("_y")),
                        by=[file_col], year="_y")
    df = raw.select(file_col, *[c for c in keep if c != file_col],
                    *[F.col(f"`{s}`").alias(d) for s, d in mapping.items()])
    # one row per file on the right: AQE broadcasts it when measured small
    df = df.join(years, on=file_col, how="left")
    if file_col not in keep:
        df = df.drop(file_col)
    return clean_mapped(df, keep=keep)


def clean_mapped(df: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """Sheet rows under their target names, with ``Year`` -> the required
    8-column layout: numbers coerced, price recomputed, names and states
    normalized, missing columns added as NULL."""
    df = cast_columns(df, doubles=[c for c in ("Revenue_Thousands", "Sales_MWh", "Customers")
                                   if c in df.columns])
    if "Revenue_Thousands" in df.columns and "Sales_MWh" in df.columns:
        df = with_unit_price(df)
    df = normalize_text(df)
    return conform_schema(df, keep=keep)

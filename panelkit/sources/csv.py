"""CSV and text sources.

All readers stay splittable: no ``wholetext`` and no per-file Python code.
Raw sheets with preamble lines are numbered per file using the scan's own
metadata (file path, split start) plus a per-split row id.  Only header
*text* (one line per distinct layout) reaches the driver, to build the
rename plan; data never does.
"""

from __future__ import annotations

import csv as _pycsv
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from panelkit import schemas as S
from panelkit.functions.exprs import safe_int
from panelkit.functions.headers import dedupe_names, header_map
from panelkit.operators import clean
from panelkit.session import materialize


def read_typed_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                   header: bool = True) -> DataFrame:
    """Header line skipped, columns bound *by position* to ``schema``;
    ``path`` may be a glob (all matching files form one table).  With a
    header, its names must be those of ``schema`` in that order: a file with
    swapped columns fails instead of loading exchanged values."""
    return (spark.read.option("header", header).option("enforceSchema", not header)
            .option("mode", "PERMISSIVE").schema(schema).csv(path))


def read_inferred_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Header names and types inferred from every row (an extra pass over
    the input; with a known schema use :func:`read_typed_csv`)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_facilities(spark: SparkSession, path: str) -> DataFrame:
    """Facility file as the panel uses it: 15-column schema, missing capacity
    -> 0.0, year and month double -> int ('2003.0' and '2008' both read),
    unused columns dropped."""
    df = read_typed_csv(spark, path, S.FACILITY_SCHEMA)
    return (df.fillna({"Capacity_MW": 0.0})
            .withColumns({"Opening_Year": F.col("Opening_Year").try_cast("int"),
                          "Opening_Month": F.col("Opening_Month").try_cast("int")})
            .drop(*S.FACILITY_DROPPED))


def read_power_costs(spark: SparkSession, path_glob: str, *,
                     thresholds: dict | None = None,
                     codes: Sequence[int] = S.ADJUSTMENT_CODES) -> DataFrame:
    """Yearly sales files (glob) -> size filter -> code exclusion -> numeric
    id and customers; revenue and sales dropped."""
    df = read_typed_csv(spark, path_glob, S.POWER_FILE_SCHEMA).select(*S.POWER_COLUMNS)
    df = clean.cast_columns(df, ints=["Year"])  # '2013.0' and '2013' both read
    th = {"Customers": S.MIN_CUSTOMERS, "Sales_MWh": S.MIN_SALES} if thresholds is None else thresholds
    df = clean.size_filter(df, th)
    df = clean.exclude_codes(df, "Utility_ID", codes)
    df = clean.cast_columns(df, ints=["Utility_ID", "Customers"])
    return df.drop("Revenue_Thousands", "Sales_MWh")


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines with ``_file`` and ``_line``, the 0-based line number within
    the file, computed without reading any file in one task.

    Within one split of a file the scan's row id is consecutive and in read
    order.  The scan runs once: split and row id are written with the lines,
    so nothing depends on how a second read would be split.  Rows are counted
    per (file, split) - one small row per split - and a window over each
    file's splits turns the counts into offsets.
    """
    # every file under the given paths, whatever their directory layout
    raw = materialize(
        spark.read.option("recursiveFileLookup", True).text(path)
        .select("value", F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_blk"),
                F.monotonically_increasing_id().alias("_id")), "raw_lines")
    per_split = raw.groupBy("_file", "_blk").agg(F.min("_id").alias("_id0"),
                                                 F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_file").orderBy("_blk")
                              .rowsBetween(Window.unboundedPreceding, -1))
    splits = materialize(per_split.withColumn("_before", F.coalesce(before, F.lit(0))),
                         "split_offsets")
    return (raw.join(splits, on=["_file", "_blk"], how="inner")
            .select("value", "_file",
                    (F.col("_before") + F.col("_id") - F.col("_id0")).alias("_line")))


def _parse_header(text: str) -> list[str]:
    return dedupe_names(next(_pycsv.reader([text])))


def read_preamble_csv(spark: SparkSession, path: str | Sequence[str], *,
                      skip: int = S.SHEET_PREAMBLE_LINES,
                      per_layout: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Per file, drop ``skip`` preamble lines, take the next line as the
    header (repeated names get .1 .2 suffixes) and parse the rest as CSV text
    columns named by it.  ``_file`` and ``_line`` (line number within the
    file) are kept for per-file steps and for "first in file order" rules.

    Files with different headers are parsed separately; ``per_layout`` (for
    example the header mapping of :func:`clean.clean_sheet`) runs on each
    layout's rows before the results are unioned by name, so header rules
    see one sheet layout at a time."""
    lines = numbered_lines(spark, path)
    heads = materialize(lines.filter(F.col("_line") == skip)
                        .select("_file", F.col("value").alias("_hdr")), "sheet_headers")
    layouts = sorted(r["_hdr"] for r in heads.select("_hdr").distinct().collect())
    if not layouts:
        raise ValueError(f"no header line found in {path}")
    data = lines.filter((F.col("_line") > skip) & (F.length("value") > 0))
    if len(layouts) > 1:
        # one row per file on the right; AQE broadcasts it when measured small
        data = data.join(heads, on="_file", how="inner")
    out: DataFrame | None = None
    for text in layouts:
        names = _parse_header(text)
        schema = ", ".join(f"`{n}` STRING" for n in names)
        sel = data if len(layouts) == 1 else data.filter(F.col("_hdr") == text)
        part = (sel.select("_file", "_line", F.from_csv("value", schema, clean.CSV_DIALECT).alias("_r"))
                .select("_file", "_line", *[F.col(f"_r.`{n}`").alias(n) for n in names]))
        if per_layout is not None:
            part = per_layout(part)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def sheet_sources(names: Sequence[str]) -> dict[str, str]:
    """Target column -> column of a sheet with these header names, by the
    header rules; the year column under ``_y``."""
    if S.YEAR_HEADER not in names:
        raise ValueError(f"no column {S.YEAR_HEADER!r} in the sheet header: {list(names)}")
    return {dst: src for src, dst in header_map(names).items()} | {"_y": S.YEAR_HEADER}


def read_layouts(spark: SparkSession, path: str | Sequence[str], *, targets: Sequence[str],
                 sources: Callable[[list[str]], dict[str, str]] = sheet_sources,
                 skip: int = S.SHEET_PREAMBLE_LINES) -> DataFrame:
    """S7 + P17 for any number of layouts in one scan: ``_file``, ``_line`` and
    the ``targets`` as text, NULL where a layout lacks one.

    Every line is parsed once, to an array as wide as the widest header.  A small
    table says, for each layout (distinct header line), which field holds which
    target (``sources``: header names -> target -> header name); it reaches the
    lines through the file they come from, and each target is picked by
    position.  The plan has one scan and one parse however many layouts there are.
    On the driver: the distinct header lines.
    """
    lines = numbered_lines(spark, path)
    heads = materialize(lines.filter(F.col("_line") == skip)
                        .select("_file", F.col("value").alias("_hdr")), "sheet_headers")
    layouts = {r["_hdr"]: _parse_header(r["_hdr"]) for r in heads.select("_hdr").distinct().collect()}
    if not layouts:
        raise ValueError(f"no header line found in {path}")
    at = []
    for text, names in layouts.items():
        held = sources(names)
        at.append((text, *[names.index(held[t]) if t in held else None for t in targets]))
    positions = spark.createDataFrame(at, ", ".join(["_hdr string", *[f"`_at_{t}` int" for t in targets]]))
    # one row per file on the right; AQE broadcasts it when measured small
    rows = (lines.filter((F.col("_line") > skip) & (F.length("value") > 0))
            .join(heads.join(positions, "_hdr").drop("_hdr"), on="_file", how="inner"))
    width = max(len(names) for names in layouts.values())
    schema = ", ".join(f"_c{i} STRING" for i in range(width))
    parsed = rows.withColumn("_r", F.from_csv("value", schema, clean.CSV_DIALECT))
    fields = parsed.withColumn("_f", F.array(*[F.col(f"_r._c{i}") for i in range(width)]))
    return fields.select("_file", "_line", *[F.get("_f", F.col(f"`_at_{t}`")).alias(t) for t in targets])


def read_sheets(spark: SparkSession, path: str | Sequence[str], *, keep: Sequence[str] = (),
                skip: int = S.SHEET_PREAMBLE_LINES) -> DataFrame:
    """Raw sheets of any number of layouts, cleaned as by
    :func:`clean.clean_sheet`, in one scan; ``keep``: ``_file``, ``_line``."""
    names = [c for c in S.REQUIRED_COLUMNS if c not in ("Year", "Price_Per_kWh")]
    raw = read_layouts(spark, path, targets=[*names, "_y"], skip=skip)
    years = clean.detect_year(raw.select("_file", safe_int(F.col("_y")).alias("_y")), by=["_file"], year="_y")
    df = raw.drop("_y").join(years, on="_file", how="left")
    return clean.clean_mapped(df.select(*dict.fromkeys([*keep, *names, "Year"])), keep=keep)


def read_positional(spark: SparkSession, path: str | Sequence[str], *, arity: int,
                    names: Sequence[str] | None = None, skip_line: str | None = None,
                    quoted_newlines: bool = False) -> DataFrame:
    """S8 + F7: headerless positional rows; only rows with exactly ``arity``
    fields are kept.  Lines are read splittably; ``quoted_newlines`` lets
    quoted fields span lines, which Spark reads one file per task."""
    if not quoted_newlines:
        return clean.ragged_rows_filter(spark.read.text(path), arity=arity, names=names,
                                        skip_line=skip_line)
    names = list(names) if names else [f"_c{i}" for i in range(arity)]
    schema = clean.ragged_schema(names)
    rows = (spark.read.options(**clean.CSV_DIALECT, multiLine="true", mode="PERMISSIVE",
                               columnNameOfCorruptRecord=clean.BAD_ROW).schema(schema).csv(path))
    keep = F.col(clean.BAD_ROW).isNull()
    if skip_line is not None:
        first = next(_pycsv.reader([skip_line]))
        same = F.lit(True)
        for n, v in zip(names, first):
            same = same & F.col(f"`{n}`").eqNullSafe(F.lit(v or None))
        keep = keep & ~same
    return rows.filter(keep).select(*[F.col(f"`{n}`") for n in names])

"""CSV landing with quarantine.

Every field is read as text and cast afterwards by expressions, so that one bad value costs
one row and can be shown.  A file is parsed once: rows that load, rows with a value that does not
cast and rows that the parser rejects are written in one pass, a folder per verdict, with the cast
values beside the text, and every table is a read of one or two of these folders.

Column pruning is off for the parser: it would otherwise judge a row by the columns a query needs.
Files with line breaks inside quotes are cut into records first, by many tasks (`records`).
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from star_marts.fixed_values import NULL_TOKENS
from star_marts.functions import try_date, try_whole
from star_marts.operators.once import computed_once
from star_marts.schemas import strings
from star_marts.session import scratch_path
from star_marts.sources.records import csv_records

_CORRUPT = "_corrupt_record"
# Stands for a field with nothing in it; with the default, "" in quotes would be NULL too.
_NO_FIELD = "\x00"

HEADERS_AT_ONCE = 16

VERDICT = "landing_verdict"
LOADED, MISTYPED, MALFORMED = "loaded", "mistyped", "malformed"


@dataclass(frozen=True)
class Landed:
    """Rows that loaded, and rows that were skipped with the reason."""

    good: DataFrame
    rejected: DataFrame


class Landing:
    """What one pass over CSV files left in a folder.

    `text` are the rows that parsed, `malformed` those that did not; `typed` are the rows whose
    values all cast, `mistyped` the others that parsed.  `counts` are rows per verdict, counted
    by the pass itself.
    """

    def __init__(
        self, spark: SparkSession, folder: str, names: Sequence[str], typed: T.StructType | None,
        counts: dict[str, int],
    ):
        self.folder, self.names, self.counts = folder, list(names), counts
        self._rows = spark.read.schema(_stored_schema(names, typed)).parquet(folder)
        self._types = typed

    def _of(self, *verdicts: str) -> DataFrame:
        return self._rows.filter(F.col(VERDICT).isin(*verdicts))

    def _skipped(self, verdict: str) -> DataFrame:
        return self._of(verdict).select(*self.names, "raw_record", "reason")

    @property
    def text(self) -> DataFrame:
        return self._of(LOADED, MISTYPED).select(*self.names)

    @property
    def malformed(self) -> DataFrame:
        return self._skipped(MALFORMED)

    @property
    def typed(self) -> DataFrame:
        if self._types is None:
            raise ValueError("landed without types")
        return self._of(LOADED).select(*[F.col(f"typed.{n}").alias(n) for n in self.names])

    @property
    def mistyped(self) -> DataFrame:
        return self._skipped(MISTYPED)


def _stored_schema(names: Sequence[str], typed: T.StructType | None) -> T.StructType:
    cast = [T.StructField("typed", typed)] if typed is not None else []
    text = [*strings(names).fields, *strings(["raw_record", "reason"]).fields]
    return T.StructType([*text, *cast, T.StructField(VERDICT, T.StringType())])


def _csv_options(multiline: bool, trim: bool) -> dict[str, object]:
    return dict(
        quote='"', escape='"', mode="PERMISSIVE", nullValue=_NO_FIELD, multiLine=multiline,
        ignoreLeadingWhiteSpace=trim, ignoreTrailingWhiteSpace=trim,
    )


def _reader(spark: SparkSession, trim: bool, header: bool):
    return spark.read.options(header=header, **_csv_options(False, trim))


def _parsed(records: DataFrame, names: Sequence[str], trim: bool) -> DataFrame:
    """Fields of records that were cut out of their files, with what is malformed."""
    fields = strings([*names, _CORRUPT])
    options = {**_csv_options(True, trim), "columnNameOfCorruptRecord": _CORRUPT, "header": False}
    texts = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    return records.select(F.from_csv("value", fields.simpleString(), texts).alias("_r")).select("_r.*")


def _null_tokens(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    if not tokens:
        return df
    return df.select(
        *[F.when(~F.col(c).isin(list(tokens)), F.col(c)).alias(c) for c in df.columns]
    )


def land(
    spark: SparkSession, path: str | list[str], schema: T.StructType, *,
    typed: T.StructType | None = None, folder: str | None = None, header: bool = True,
    multiline: bool = False, trim: bool = False, null_tokens: Sequence[str] = (), keep_text: bool = True,
) -> Landing:
    """Parse files once, by position, and store every row with its verdict in `folder`.

    `schema` names the columns; `typed` is what their values are cast to.  Rows of another width are
    malformed.  Without a folder the rows go to the scratch folder.  Rows whose values all cast are
    stored without their text if `keep_text` is off; `text` has only NULLs for them then.
    """
    names = schema.fieldNames()
    if multiline:
        rows = _parsed(csv_records(spark, path, header=header, trim=trim), names, trim)
    else:
        rows = (
            _reader(spark, trim, header)
            .options(enforceSchema=True, columnNameOfCorruptRecord=_CORRUPT, columnPruning=False)
            .schema(strings([*names, _CORRUPT]))
            .csv(path)
        )
    broken = F.col(_CORRUPT).isNotNull()
    if null_tokens:
        tokens = list(null_tokens)
        rows = rows.select(*[F.when(broken | ~F.col(n).isin(tokens), F.col(n)).alias(n) for n in names], _CORRUPT)
    if typed is None:
        reason, cast = F.when(broken, F.lit("malformed row")), []
    else:
        rows, bad = _cast(rows, typed)
        cast = [F.when(~broken & (bad == ""), F.col("_typed")).alias("typed")]
        reason = F.when(broken, F.lit("malformed row")).when(bad != "", F.concat(F.lit("bad "), bad))
    fields = names if keep_text else [F.when(reason.isNotNull(), F.col(n)).alias(n) for n in names]
    judged = rows.select(*fields, F.col(_CORRUPT).alias("raw_record"), reason.alias("reason"), *cast)
    verdict = F.when(F.col("reason").isNull(), LOADED).when(F.col("raw_record").isNull(), MISTYPED).otherwise(MALFORMED)
    seen = Observation()
    counted = judged.withColumn(VERDICT, verdict).observe(
        seen, *[F.count_if(F.col(VERDICT) == v).alias(v) for v in (LOADED, MISTYPED, MALFORMED)]
    )
    folder = folder or scratch_path(spark, "landing")
    counted.write.partitionBy(VERDICT).parquet(folder)
    found = seen.get
    return Landing(spark, folder, names, typed, {v: found.get(v, 0) for v in (LOADED, MISTYPED, MALFORMED)})


def read_positional(spark: SparkSession, path: str | list[str], schema: T.StructType, **options) -> Landed:
    """Read columns by position into an all-text schema; rows of another width are rejected.

    Options are those of `land`.
    """
    landing = land(spark, path, schema, **options)
    return Landed(landing.text, landing.malformed)


def read_typed(
    spark: SparkSession, path: str | list[str], schema: T.StructType, **options
) -> Landed:
    """Read by position and cast; a row with a value that does not cast is rejected."""
    landing = land(spark, path, schema, typed=schema, keep_text=False, **options)
    return Landed(landing.typed, landing.mistyped.unionByName(landing.malformed))


def _cast(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Column]:
    """The frame with `_typed`, each column cast once, and the names of columns that do not cast."""
    names = schema.fieldNames()
    cast = computed_once(df, "_typed", F.struct(*[_try_type(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]))
    # A cast that gives a value ends the test; only the few others look at the text.
    bad = [F.col(f"_typed.{n}").isNull() & (F.coalesce(F.trim(n), F.lit("")) != "") for n in names]
    return cast, F.when(
        reduce(Column.__or__, bad),
        F.array_join(F.array_compact(F.array(*[F.when(b, F.lit(n)) for n, b in zip(names, bad, strict=True)])), ", "),
    ).otherwise("")


def apply_types(df: DataFrame, schema: T.StructType) -> Landed:
    """Cast text columns to a schema, apart from rows in which some value does not cast."""
    names = schema.fieldNames()
    cast, bad = _cast(df, schema)
    good = cast.filter(bad == "").select(*[F.col(f"_typed.{n}").alias(n) for n in names])
    rejected = cast.filter(bad != "").select(
        *names, F.lit(None).cast("string").alias("raw_record"), F.concat(F.lit("bad "), bad).alias("reason")
    )
    return Landed(good, rejected)


def _try_type(c: Column, to: T.DataType) -> Column:
    if isinstance(to, T.DateType):
        return try_date(c)
    if isinstance(to, T.IntegralType):
        return try_whole(c, to.simpleString())
    return c.try_cast(to)


def normalize_name(name: str) -> str:
    """Upper case without anything but letters and digits: 'Station Name' -> 'STATIONNAME'."""
    return re.sub(r"[^A-Z0-9]", "", name.upper())


def read_by_header(
    spark: SparkSession, paths: str | Iterable[str], schema: T.StructType | None = None, *,
    multiline: bool = False, trim: bool = True, null_tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """Read text columns named by the header, regardless of case, blanks and order.

    With a schema, its columns are picked by name and missing ones are NULL.  Short rows are
    padded and surplus fields dropped.  Files of one folder may differ in their headers: those
    with the same one are read together.
    """
    frames = []
    for names, files in _files_by_header(spark, [paths] if isinstance(paths, str) else list(paths), multiline):
        if multiline:
            columns = [f"c{i}" for i in range(len(names))]
            rows = _parsed(csv_records(spark, files, trim=trim), columns, trim).drop(_CORRUPT)
        else:
            rows = _reader(spark, trim, header=True).schema(strings(f"c{i}" for i in range(len(names)))).csv(files)
        rows = rows.toDF(*[normalize_name(c) for c in names])
        if schema is not None:
            have = {c.upper(): c for c in rows.columns}
            rows = rows.select(
                *[
                    F.col(have[n.upper()]).alias(n)
                    if n.upper() in have
                    else F.lit(None).cast("string").alias(n)
                    for n in schema.fieldNames()
                ]
            )
        frames.append(_null_tokens(rows, null_tokens))
    if not frames:
        return spark.createDataFrame([], strings(schema.fieldNames() if schema is not None else []))
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def _files_by_header(spark: SparkSession, paths: list[str], multiline: bool) -> list[tuple[list[str], list[str]]]:
    """Column names, and the files of all paths that have them in their first record.

    A name and a record per file reach the driver, which lists the files for a scan anyway.
    """
    found: dict[str, list[str]] = {}
    for file, header in first_records(spark, paths, multiline):
        found.setdefault(header.removesuffix("\r"), []).append(file)
    return [(_names(header), files) for header, files in found.items()]


def _names(header: str) -> list[str]:
    """The fields of a header record."""
    return [name.strip() for name in next(csv.reader([header.removeprefix("\ufeff")], doublequote=True), [])]


def first_records(spark: SparkSession, paths: list[str], multiline: bool = False) -> list[tuple[str, str]]:
    """Every file that is not empty, and its first record.

    A task opens each file and stops after the line, so what is read does not depend on how long
    the file is; as many files as HEADERS_AT_ONCE are read side by side.
    """
    own = spark.newSession()  # settings of its own: a file is one partition
    own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 60))

    def first(file: str) -> str | None:
        lines = own.read.option("lineSep", "\n").text(file)
        wanted = 1
        while True:
            found = [row["value"] for row in lines.limit(wanted).collect()]
            header = "\n".join(found)
            if len(found) < wanted or not (multiline and header.count('"') % 2):
                return header if found else None
            wanted *= 4

    def record(file: str) -> tuple[str, str | None]:
        header = first(file)
        if header is not None and multiline and "\n" in header:
            # Lines beyond the record may have come along.
            lines, taken = header.split("\n"), 1
            while "\n".join(lines[:taken]).count('"') % 2 and taken < len(lines):
                taken += 1
            header = "\n".join(lines[:taken])
        return file, header

    files = sorted(unquote(f) for f in own.read.text(paths).inputFiles())
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        return [(file, header) for file, header in pool.map(record, files) if header is not None]

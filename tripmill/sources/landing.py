"""Landing: raw feed files to one table per feed, in the declared types, with lineage."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.functions.periods import period_of, source_name
from tripmill.operators.conform import columns_by_role
from tripmill.plans.reuse import persisted
from tripmill.sources.files import footer_columns, list_files
from tripmill.specs import FeedSpec, PeriodFilter

LINEAGE: tuple[str, ...] = ("_ingestion_ts", "_source_file", "_source_type", "year_month")


def ingestion_time() -> Column:
    """Now, in UTC, as one constant: every row and every retry of a landing agrees."""
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(now).cast("timestamp_ntz")


def add_lineage(raw: DataFrame, source_type: str, at: Column | None = None) -> DataFrame:
    """When, from which source, as which feed and for which month a row was landed."""
    source = source_name(F.col("_metadata.file_path"))
    return raw.withColumns(
        {
            "_ingestion_ts": ingestion_time() if at is None else at,
            "_source_file": source,
            "_source_type": F.lit(source_type),
            "year_month": period_of(source),
        }
    )


def to_contract(raw: DataFrame, contract: StructType, extras: dict[str, str]) -> DataFrame:
    """Declared columns in their declared types, then undeclared ones, then lineage.

    Names match without regard to case; missing columns are null, and so are
    values that do not fit. Undeclared columns are kept.
    """
    actual = columns_by_role(raw)
    types = dict(raw.dtypes)

    def typed(name: str, kind: str) -> Column:
        found = actual.get(name.lower())
        if found is None:
            return F.lit(None).cast(kind).alias(name)
        value = F.col(f"`{found}`")
        return (value if types[found] == kind else value.try_cast(kind)).alias(name)

    declared = [typed(f.name, f.dataType.simpleString()) for f in contract.fields]
    undeclared = [typed(name, kind) for name, kind in extras.items()]
    lineage = [name for name in LINEAGE if name in raw.columns]
    return raw.select(*declared, *undeclared, *lineage)


def select_files(files: DataFrame, periods: PeriodFilter) -> DataFrame:
    """Files of the chosen months, by the month in the name of their source."""
    month = period_of(source_name(F.col("path")))
    return select_periods(files.withColumn("year_month", month), periods)


def _folders_above(spark: SparkSession, root: str | list[str]) -> Column:
    """Folders from that of a ``path`` up to the root, the only ones of which all files are known.

    None for files that were named one by one or by a pattern.
    """
    if not isinstance(root, str) or any(c in root for c in "*?[{"):
        return F.array().cast("array<string>")
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    top = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString()
    steps = F.split("path", "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(steps) - 1), lambda n: F.array_join(F.slice(steps, 1, n), "/")
    )
    inside = F.lit(top.rstrip("/") + "/")
    return F.filter(above, lambda folder: F.concat(folder, F.lit("/")).startswith(inside))


def physical_schemas(
    spark: SparkSession, root: str | list[str], periods: PeriodFilter = PeriodFilter()
) -> DataFrame:
    """Each distinct footer schema of the chosen files, and the locations where it is found.

    One row per location: a folder all files of which are chosen and have that schema, the
    topmost such, or a file that lies beside others. So there are as many rows as
    folders, however many files these hold, and no task or row gathers the files of a schema.
    """
    listed = list_files(spark, root, "*.parquet").withColumn("above", _folders_above(spark, root))
    columns = footer_columns(select_files(listed, periods))
    per_file = columns.groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("position", "name", "type"))).alias("columns")
    )
    chosen = per_file.withColumns(
        {"above": _folders_above(spark, root), "schema": F.xxhash64("columns")}
    )

    def per_folder(files: DataFrame, *keys: str) -> DataFrame:
        found = files.select(*keys, F.explode("above").alias("folder"))
        return found.groupBy("folder", *keys).agg(F.count(F.lit(1)).alias("n"))

    alike = per_folder(chosen, "schema").join(per_folder(listed), ["folder", "n"]).select("folder")
    # A folder's files are all alike: so are those of the folders below it.
    marked = chosen.select("path", "schema", "columns", F.posexplode_outer("above").alias("depth", "folder"))
    tops = (
        marked.join(alike.withColumn("alike", F.lit(True)), "folder", "left")
        .groupBy("path", "schema")
        .agg(
            F.any_value("columns").alias("columns"),
            F.min_by("folder", F.when(F.col("alike"), F.col("depth"))).alias("top"),
        )
    )
    return tops.groupBy(F.coalesce("top", "path").alias("location"), "schema").agg(
        F.any_value("columns").alias("columns")
    )


def land_feed(
    spark: SparkSession,
    root: str | list[str],
    spec: FeedSpec,
    periods: PeriodFilter = PeriodFilter(),
    at: Column | None = None,
) -> DataFrame:
    """The raw files of a feed, of the chosen months, as one frame in the declared types.

    Plain Parquet reading fails on files whose types differ and hides added
    columns, so files are grouped by footer schema (read by the executors). The driver, which
    declares the scans, gets each schema once and its folders (files only where a folder
    holds several schemas or months); each schema is one scan and one select.
    """
    with persisted(physical_schemas(spark, root, periods)) as found:
        schemas = found.select("schema", "columns").dropDuplicates(["schema"]).collect()
        places: dict[int, list[str]] = {}
        for row in found.select("schema", "location").orderBy("location").toLocalIterator():
            places.setdefault(row["schema"], []).append(row["location"])
    if not schemas:
        raise FileNotFoundError(f"no Parquet files of the chosen months below {root}")
    groups = sorted(schemas, key=lambda g: places[g["schema"]][0])
    contract = StructType.fromDDL(spec.contract) if spec.contract else StructType()
    declared = {f.name.lower() for f in contract.fields}

    seen: dict[str, tuple[str, set[str]]] = {}
    for group in groups:
        for column in group["columns"]:
            if column["name"].lower() not in declared:
                name, kinds = seen.setdefault(column["name"].lower(), (column["name"], set()))
                kinds.add(column["type"])
    extras = {
        name: next(iter(kinds)) if len(kinds) == 1 else "string" for name, kinds in seen.values()
    }

    at = ingestion_time() if at is None else at
    scans = []
    for group in groups:
        reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        raw = reader.parquet(*places[group["schema"]])
        scans.append(to_contract(add_lineage(raw, spec.name, at), contract, extras))
    return reduce(DataFrame.unionByName, scans)


def select_periods(
    landed: DataFrame, periods: PeriodFilter, column: str = "year_month"
) -> DataFrame:
    """Rows of one month, else of one year, else of the first n months; else all.

    On a landed table each case is a condition on the partition column.
    """
    month = F.col(column)
    if periods.month:
        return landed.filter(month == periods.month)
    if periods.year:
        return landed.filter(month.startswith(f"{periods.year}-"))
    if periods.first_n:
        months = landed.select(column).distinct()
        nth = months.orderBy(column).limit(periods.first_n).agg(F.max(column))
        return landed.filter(month <= nth.scalar())
    return landed

"""Which columns the files of a table hold, file by file, from their footers."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

THREADS = 16
_NANOS = "spark.sql.legacy.parquet.nanosAsLong"


class SchemaDriftError(ValueError):
    """Files of one table hold a column in types that have no common type."""


# A file's columns as its footer spells them: physical type, name, logical type.
Signature = tuple[str, ...]


def signature(spark: SparkSession, file: str) -> Signature:
    jvm, path = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(file)
    opened = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration()))
    try:
        return tuple(f.toString() for f in opened.getFileMetaData().getSchema().getFields())
    finally:
        opened.close()


def census(spark: SparkSession, files: Sequence[str], threads: int = THREADS) -> dict[Signature, list[str]]:
    """Files by signature. The driver reads the footers alone, several at a time, as it does to plan a read of them."""
    found: dict[Signature, list[str]] = defaultdict(list)
    with ThreadPoolExecutor(threads) as pool:
        for file, columns in zip(files, pool.map(lambda f: signature(spark, f), files)):
            found[columns].append(file)
    return dict(found)


def files_of(spark: SparkSession, path: str, wanted: Column | None = None) -> list[str]:
    """Parquet files under a path, of the wanted partitions; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return sorted(r["path"] for r in (files if wanted is None else files.where(wanted)).select("path").collect())


def nanosecond_columns(columns: Signature) -> dict[str, T.DataType]:
    """Columns with nanosecond timestamps, and the type that they get."""
    found = {}
    for c in columns:
        if "(TIMESTAMP(NANOS" in c:
            name = c.split(" ", 2)[2].rsplit(" (TIMESTAMP", 1)[0]
            found[name] = T.TimestampType() if "NANOS,true" in c else T.TimestampNTZType()
    return found


def from_nanoseconds(df: DataFrame, columns: dict[str, T.DataType]) -> DataFrame:
    """Nanoseconds since 1970 to timestamps in whole microseconds, rounded down."""
    def stamp(name: str, kind: T.DataType) -> Column:
        micros = F.floor(F.col(f"`{name}`").cast("decimal(20,0)") / 1000).cast("bigint")
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_micros(micros) if isinstance(kind, T.TimestampType) else F.timestamp_add("MICROSECOND", micros, start)
    return df.withColumns({n: stamp(n, k) for n, k in columns.items() if n in df.columns}) if columns else df


def read_alike(spark: SparkSession, files: Sequence[str], columns: Signature, base: str | None = None,
               like: str | None = None) -> DataFrame:
    """Files of one signature, in one read. ``base`` is the folder that partition columns start from.

    ``files`` may be a folder that holds others, too, which a filter on partitions must
    exclude; ``like`` is then a file that gives the types.

    Spark refuses nanosecond timestamps unless it may read them as numbers. The session is
    told so if such a column is there, for good: plans read when they run. Other columns are
    read as before.
    """
    nanos = nanosecond_columns(columns)
    if nanos:
        spark.conf.set(_NANOS, "true")
    def reader() -> DataFrameReader:
        return spark.read.option("basePath", base) if base else spark.read
    found = reader().schema(reader().parquet(like).schema).parquet(*files) if like else reader().parquet(*files)
    return from_nanoseconds(found, nanos)


@contextmanager
def _nanos_as_numbers(spark: SparkSession, value: str) -> Iterator[None]:
    before = spark.conf.get(_NANOS, "false")
    if before != value:
        spark.conf.set(_NANOS, value)
    try:
        yield
    finally:
        if before != value:
            spark.conf.set(_NANOS, before)


def inferred(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as Spark reads it by itself; None if it holds nanosecond timestamps."""
    try:
        with _nanos_as_numbers(spark, "false"):
            return spark.read.parquet(path)
    except AnalysisException as e:
        if "TIMESTAMP(NANOS" not in str(e):
            raise
        return None


def one_file(spark: SparkSession, path: str) -> str:
    """Some file of a table that Spark refuses to read."""
    with _nanos_as_numbers(spark, "true"):
        return unquote(spark.read.parquet(path).inputFiles()[0])


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds values of both, as concatenating tables widens them; None if there is none.

    Whole numbers of different widths become bigint, whole and broken numbers double.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def common_schema(schemas: Iterable[tuple[str, T.StructType]]) -> T.StructType:
    """Columns of all (file, schema) by name, in their widest type; raises where a column has no common type."""
    found: dict[str, tuple[T.DataType, str]] = {}
    for file, schema in schemas:
        for f in schema.fields:
            known = found.get(f.name)
            kind = f.dataType if known is None else wider(known[0], f.dataType)
            if kind is None:
                raise SchemaDriftError(f"column {f.name!r} is {known[0].simpleString()} in {known[1]} and {f.dataType.simpleString()} in {file}")
            if known is None or kind != known[0]:
                found[f.name] = kind, file
    return T.StructType([T.StructField(n, k) for n, (k, _) in found.items()])

"""The quarantine lane: what of a landing cannot be read, as rows with file and reason.

Each reader returns two tables: what could be read, and `(file, reason, record)` of what could not. Nothing fails the
job and nothing turns into silent nulls; whoever calls decides with `require_some` whether a run may go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from labtrail.schemas import STATION_CODE, nested_schema
from labtrail.sources.batches import BATCH
from labtrail.sources.sheets import as_strings, trim_headers

LANE = "file string, reason string, record string"
NOT_A_DOCUMENT, NO_SAMPLES = "documento ilegivel", "documento sem amostras"
OTHER_CELLS = "numero de celulas diferente do cabecalho"
UNREADABLE, PARTLY = "arquivo ilegivel", "arquivo lido em parte"
_CORRUPT = "_corrupt_record"


def _lane(df: DataFrame, file: Column, reason: Column, record: Column) -> DataFrame:
    return df.select(file.alias("file"), reason.alias("reason"), record.cast("string").alias("record"))


def _file() -> Column:
    return F.col("_metadata.file_path")


def read_documents(
    spark: SparkSession, path: str | list[str], samples_field: str = "amostras", station_field: str = STATION_CODE,
    multiline: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Landed documents, and those that are no document or have no samples (an empty list is none).

    The record of a document that does not parse is its text.
    """
    schema = StructType(nested_schema(samples_field, station_field).fields).add(_CORRUPT, "string")
    read = (
        spark.read.schema(schema)
        .option("multiLine", multiline)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(path)
        .select("*", _file().alias("_file"))
    )
    broken = F.col(_CORRUPT).isNotNull()
    bare = F.coalesce(F.size(samples_field), F.lit(0)) <= 0
    reason = F.when(broken, F.lit(NOT_A_DOCUMENT)).when(bare, F.lit(NO_SAMPLES))
    judged = read.withColumn("_reason", reason)
    return (
        judged.where(F.col("_reason").isNull()).drop(_CORRUPT, "_file", "_reason"),
        _lane(judged.where(F.col("_reason").isNotNull()), F.col("_file"), F.col("_reason"), F.col(_CORRUPT)),
    )


def read_sheet(spark: SparkSession, path: str, multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """One landed CSV sheet as text, and the rows whose number of cells is not that of the header.

    A row with surplus cells is not cut and one that lacks some is not filled up: both are kept out as written.
    """
    options = {"header": True, "encoding": "UTF-8", "multiLine": multiline}
    header = spark.read.options(**options).csv(path).columns
    schema = StructType()
    for name in header:
        schema = schema.add(name, StringType())
    read = (
        spark.read.options(**options, columnNameOfCorruptRecord=_CORRUPT)
        .schema(schema.add(_CORRUPT, "string"))
        .csv(path)
        .select("*", _file().alias("_file"))
    )
    # always true, and reads the whole row on both lanes: Spark counts the cells of no row that it reads in part
    whole = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in header])) >= 0
    judged = read.withColumn("_broken", F.col(_CORRUPT).isNotNull() & whole)
    good = as_strings(trim_headers(judged.where(~F.col("_broken")).drop(_CORRUPT, "_file", "_broken")))
    bad = _lane(judged.where("_broken"), F.col("_file"), F.lit(OTHER_CELLS), F.col(_CORRUPT))
    return good, bad


def read_batches(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """The batches of a Parquet table, and its files that cannot be read or not to their end.

    A file is taken whole or not at all. To find out, all columns of all files are read once and counted by file, and
    set against the rows their ends state; the files that do not agree are kept from the first table by their names,
    which only these few files contribute. The record of a file is its size.
    """
    landed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = landed.select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    table = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(path)
    data = [c for c in table.columns if c != BATCH]
    stated = table.groupBy(_file().alias("file")).agg(F.count(F.lit(1)).alias("stated"))
    # the count hangs on a hash of all columns, which makes the reader decode them all
    decoded = table.select(_file().alias("file"), _any_hash(table, data).alias("hash"))
    read = decoded.groupBy("file").agg(F.when(F.bit_xor("hash").isNotNull(), F.count(F.lit(1))).alias("read"))
    names = lambda df: df.withColumn("file", F.regexp_replace("file", "^file:/+", "file:/"))
    judged = names(files).join(names(stated), "file", "left").join(names(read), "file", "left")
    reason = F.when(F.col("stated").isNull(), F.lit(UNREADABLE)).when(
        ~F.col("stated").eqNullSafe(F.coalesce("read", F.lit(0))), F.lit(PARTLY)
    )
    bad = _lane(judged.withColumn("_reason", reason).where("_reason IS NOT NULL"), F.col("file"), F.col("_reason"), F.col("bytes"))
    own = table.withColumn("file", F.regexp_replace(_file(), "^file:/+", "file:/"))
    return own.join(bad.select("file"), "file", "left_anti").select(*table.columns), bad


def _any_hash(df: DataFrame, columns: list[str]) -> Column:
    """A hash of all columns; maps go in as their entries."""
    maps = {f.name for f in df.schema if "map<" in f.dataType.simpleString()}
    return F.xxhash64(*[F.to_json(F.col(f"`{c}`")) if c in maps else F.col(f"`{c}`") for c in columns])


def lanes(*bad: DataFrame) -> DataFrame:
    """Several quarantine lanes as one."""
    out = bad[0]
    for one in bad[1:]:
        out = out.unionByName(one)
    return out


def lane_summary(bad: DataFrame) -> DataFrame:
    """Files and records by reason."""
    return bad.groupBy("reason").agg(F.count_distinct("file").alias("files"), F.count("*").alias("records"))


def require_some(good: DataFrame, what: str) -> DataFrame:
    """Stop when nothing could be read; a job that ends at the first row."""
    if good.isEmpty():
        raise ValueError(f"{what}: nothing could be read")
    return good

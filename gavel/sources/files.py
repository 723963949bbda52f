"""Readers of the JSON/CSV/binary inputs.

Every reader has an explicit schema with all fields nullable, keeps going past
bad files (their rows land in the corrupt side) and takes ids and dates from the
file name with expressions, so file selection happens before parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.base import blank_to_null
from ..functions.dates import date_from_name
from ..operators.keyed import first_available


def _json(spark: SparkSession, path: str, schema: str, glob: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", glob)
        .json(path)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine of file names with the raw text)."""
    good = df.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    bad = df.where(F.col("_corrupt_record").isNotNull()).select("file_name", "_corrupt_record")
    return good, bad


def meetings(spark: SparkSession, path: str, strict_name: bool = False) -> DataFrame:
    """Meeting files, backups left out; `strict_name` wants an ISO date in the name."""
    df = _json(spark, path, schemas.MEETING, "meeting_*_*.json").where(~F.col("file_name").contains("_old"))
    if strict_name:
        df = df.where(F.col("file_name").rlike(r"^meeting_\d+_\d{4}-\d{2}-\d{2}\.json$"))
    return df


def meetings_on(df: DataFrame, date: str) -> DataFrame:
    return df.where(F.col("file_name").contains(date))


def meeting_by_id(df: DataFrame, meeting_id: str) -> DataFrame:
    """The first file of a meeting in name order."""
    return df.where(F.col("file_name").startswith(f"meeting_{meeting_id}_")).orderBy("file_name").limit(1)


def segments_of(df: DataFrame) -> Column:
    """Segments of either spelling, first present wins, else empty."""
    empty = F.array().cast(f"array<{schemas.SEGMENT}>")
    return F.coalesce(F.col("segments"), F.col("transcript"), empty)


def _transcripts(spark: SparkSession, path: str, glob: str, pattern: str) -> DataFrame:
    df = _json(spark, path, schemas.TRANSCRIPT, glob).where(F.col("file_name").rlike(pattern))
    return (
        df.withColumn("transcript_id", F.regexp_extract("file_name", pattern, 1))
        .withColumn("date", date_from_name("file_name"))
        .withColumn("segments", segments_of(df))
        .drop("transcript")
    )


def processed_transcripts(spark: SparkSession, path: str) -> DataFrame:
    return _transcripts(
        spark, path, "processed_transcript_*.json", r"processed_transcript_(\d+)_(\d{4}-\d{2}-\d{2})"
    )


def raw_transcripts(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """Raw transcripts without test files; optionally one year; only those with segments."""
    df = _transcripts(spark, path, "transcript_*.json", r"^transcript_(\d+)_(\d{4}-\d{2}-\d{2})")
    df = df.where(~F.col("file_name").contains("--transcript-id") & (F.size("segments") > 0))
    return df.where(F.col("file_name").contains(f"_{year}-")) if year else df


def bare_list_transcripts(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Files that may hold a bare list of segments or an object around one.

    Read as text and parsed by expressions; the first form that parses wins.
    """
    text = spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(path)
    text = text.withColumn("file_name", F.col("_metadata.file_name"))
    as_list = F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<{schemas.SEGMENT}>"))
    as_object = F.from_json("value", f"segments array<{schemas.SEGMENT}>, transcript array<{schemas.SEGMENT}>")
    return text.select(
        "file_name",
        F.coalesce(
            as_list, as_object["segments"], as_object["transcript"], F.array().cast(f"array<{schemas.SEGMENT}>")
        ).alias("segments"),
    )


def mixed_records(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """(file_name, record, shape, corrupt): files of any JSON shape as VARIANT values, each read and parsed once.

    `shape` is the type of the outermost value and, for objects, its fields, as Spark names them.  What does not parse stays as a
    row with its text in `corrupt` and no record; empty files give no row."""
    text = spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(path)
    parsed = text.select(F.col("_metadata.file_name").alias("file_name"), "value", F.try_parse_json("value").alias("record"))
    broken = F.col("record").isNull()
    return parsed.select("file_name", "record", F.schema_of_variant("record").alias("shape"), F.when(broken, F.col("value")).alias("corrupt"))


def shapes_of(records: DataFrame) -> DataFrame:
    """The one schema that holds all records of a table of `mixed_records`."""
    return records.agg(F.schema_of_variant_agg("record").alias("schema"))


def variant_segments(record: Column) -> Column:
    """Segments of any of the three shapes: a bare list, or an object with `segments` or else `transcript`; empty without any."""
    rows = f"array<{schemas.SEGMENT}>"
    found = [F.try_variant_get(record, p, rows) for p in ("$", "$.segments", "$.transcript")]
    return F.coalesce(*found, F.array().cast(rows))


def variant_total(record: Column, total: str = "$.net", items: str = "$", amount: str = "$.value") -> Column:
    """A financial figure of either shape: an object that names it, or a list whose amounts add up to it."""
    listed = F.try_variant_get(record, items, "array<variant>")
    added = F.aggregate(listed, F.lit(0.0), lambda a, x: a + F.coalesce(F.try_variant_get(x, amount, "double"), F.lit(0.0)))
    return F.coalesce(F.try_variant_get(record, total, "double"), added)


def preferred_transcripts(processed: DataFrame, raw: DataFrame) -> DataFrame:
    """Per transcript id: the processed file if there is one, else the raw file."""
    return first_available([processed, raw], ["transcript_id"])


def video_maps(spark: SparkSession, path: str) -> DataFrame:
    df = _json(spark, path, schemas.VIDEO_MAP, "video_mapping_*.json")
    return df.where(blank_to_null("meeting_id").isNotNull() & F.col("videos").isNotNull())


def captions(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, schemas.CAPTIONS, "*.json")


def entity_lists(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Name lists of several optional files, with the category they came from.

    Patterns that match nothing are skipped, as a missing list only narrows the result.
    """
    frames = []
    for path in paths:
        try:
            frames.append(
                spark.read.schema(schemas.STANDARD_ENTITIES).option("multiLine", True).json(path)
                .select(F.explode_outer("entities").alias("category", "names"))
            )
        except Exception as error:  # missing path is part of the contract
            if "PATH_NOT_FOUND" not in str(error):
                raise
    if not frames:
        return spark.createDataFrame([], "category string, name string")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select("category", F.explode("names").alias("name"))


def entity_db(spark: SparkSession, path: str) -> DataFrame:
    """Entity database map files as flat rows."""
    df = spark.read.schema(schemas.ENTITY_DB).option("multiLine", True).json(path)
    rows = lambda kind: df.select(F.lit(kind).alias("kind"), F.explode(kind).alias("name", "e")).select("kind", "name", "e.*")
    return rows("people").unionByName(rows("organizations"))


def casing_config(spark: SparkSession, path: str) -> DataFrame:
    """The four lists of the casing config as (list, term) rows."""
    df = spark.read.schema(schemas.CASING_CONFIG).option("multiLine", True).json(path)
    lists = ["acronyms", "neighborhoods", "street_suffixes", "skip_words"]
    pairs = F.array(*[F.struct(F.lit(n).alias("list"), F.col(n).alias("terms")) for n in lists])
    return df.select(F.explode(pairs).alias("p")).select("p.list", F.explode("p.terms").alias("term"))


def country_names(spark: SparkSession, path: str) -> DataFrame:
    """Both names of each country, distinct."""
    df = spark.read.option("header", True).csv(path)
    official, shown = blank_to_null("official_name_en"), blank_to_null("CLDR display name")
    names = df.select(F.explode(F.array(F.coalesce(official, shown), shown)).alias("name"))
    return names.where(F.col("name").isNotNull()).distinct()


def files_with_bytes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Document bytes for hashing and sniffing."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)


def meeting_metadata(meeting_df: DataFrame) -> DataFrame:
    """One metadata row per meeting file; a name that does not parse is dropped."""
    name = r"^meeting_(\d+)_(\d{4}-\d{2}-\d{2})\.json$"
    return meeting_df.where(F.col("file_name").rlike(name)).select(
        F.col("file_name").alias("filename"),
        F.regexp_extract("file_name", name, 1).alias("meetingId"),
        F.regexp_extract("file_name", name, 2).alias("date"),
        F.col("meetingType"),
        F.col("meetingDate").alias("meetingDateFull"),
        F.coalesce(F.size("agendaItems"), F.lit(0)).alias("agendaItemCount"),
        F.col("sourceUrl"),
    )


def write_files(contents: DataFrame, folder: str) -> int:
    """Write (name, content) rows as files of those names below `folder`; the number of files written.

    Any store that the Arrow file systems know will do.  A file is written whole under its own name, so a
    retried task writes the same file again."""
    from pyarrow import fs

    folder = folder if ":" in folder else f"file://{folder}"
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)

    def write(rows):
        target, at = fs.FileSystem.from_uri(folder)
        for name, content in rows:
            with target.open_output_stream(f"{at}/{name}") as out:
                out.write((content or "").encode())
            yield 1

    # rows come in batches of a few MB, however long a content is; an Arrow batch has a number of rows
    return contents.select("name", "content").rdd.mapPartitions(write).sum()

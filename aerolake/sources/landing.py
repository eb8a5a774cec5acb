"""Landing zone: gzipped JSON documents in, incremental file streams out.

Spark chooses the physical part-file names of what it writes, but the
ids encoded in a landing file name (location, sensor, city) must survive.
Documents written by Spark therefore carry their logical landing file name
in a top-level ``landing_file`` field; readers take the name from that
field when present, else from the physical file name (``_metadata``), so
files dropped by an external downloader work unchanged.
"""

from __future__ import annotations

import gzip
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

NAME_FIELD = "landing_file"
# A document that is no JSON (a download that was cut off) keeps its text here.
CORRUPT_FIELD = "_corrupt_record"

# Landing file-name patterns of the three feeds.
LOCATIONS_GLOB = "[a-zA-Z]*-locations*.json.gz"
MEASUREMENTS_GLOB = "[0-9]*.json.gz"
WEATHER_GLOB = "openmeteo*.json.gz"
SPARK_PART_GLOB = "part-*.json.gz"


def land_json(docs: DataFrame, path: str, name_col: str | None = None) -> None:
    """Append documents as gzip JSON, one document per line.

    ``name_col`` holds the logical landing file name of each document; it is
    written as the document's ``landing_file`` field.  Files are as many as
    write tasks, not as many as documents.
    """
    if name_col and name_col != NAME_FIELD:
        docs = docs.withColumnRenamed(name_col, NAME_FIELD)
    docs.write.mode("append").option("compression", "gzip").json(path)


def land_files(docs: DataFrame, path: str, name_col: str, cut_col: str | None = None) -> None:
    """Write each document as a gzip JSON file of its own, named by ``name_col``
    plus ``.gz``, indented, as the downloader leaves it.

    Where ``cut_col`` is true the file holds the first half of the text only: a
    download that broke off.  Files are written by the executors, into the shared
    folder ``path``, under a hidden name and then renamed, so a reader never sees
    half a file and a second attempt replaces the first.
    """
    names = [c for c in docs.columns if c not in (name_col, cut_col)]
    rows = docs.select(F.col(name_col).cast("string"), F.to_json(F.struct(*names), {"pretty": "true"}),
                       F.col(cut_col).cast("boolean") if cut_col else F.lit(False))

    def write(batches):
        from pyarrow import fs

        where, base = fs.FileSystem.from_uri(path)
        where.create_dir(base, recursive=True)
        for batch in batches:
            for name, text, cut in zip(*(c.to_pylist() for c in batch.columns)):
                hidden = f"{base}/_{uuid.uuid4().hex}"
                with where.open_output_stream(hidden, compression=None) as out:
                    out.write(gzip.compress((text[:len(text) // 2] if cut else text).encode(),
                                            compresslevel=6, mtime=0))
                target = f"{base}/{name}.gz"
                if where.get_file_info(target).type != fs.FileType.NotFound:
                    where.delete_file(target)
                where.move(hidden, target)
            yield batch.slice(0, 0)

    rows.mapInArrow(write, rows.schema).write.format("noop").mode("overwrite").save()


def json_stream(spark: SparkSession, path: str, schema: StructType, glob: str,
                max_files: int | None = None, multiline: bool = False,
                max_bytes: int | None = None, corrupt: bool = False) -> DataFrame:
    """Incremental stream of new JSON files under ``path``.

    Seen files are tracked in the query checkpoint, so a rerun reads only
    files that arrived since.  Each micro-batch is bounded either by
    ``max_bytes`` of new files (a soft bound: a batch takes at least one
    file) or by ``max_files``; the two are exclusive.  Gzip files are not
    splittable, so parallelism is per file.  ``multiline`` reads one whole
    document per file (downloader files); Spark-landed files hold one
    document per line.  With ``corrupt`` a document that cannot be parsed
    keeps its text in ``CORRUPT_FIELD``, all its other fields NULL.
    """
    extra = [NAME_FIELD, *([CORRUPT_FIELD] if corrupt else [])]
    schema = StructType(schema.fields + [StructField(n, StringType()) for n in extra
                                         if n not in schema.fieldNames()])
    r = (spark.readStream.format("json").schema(schema)
         .option("multiLine", str(multiline).lower())
         .option("columnNameOfCorruptRecord", CORRUPT_FIELD)
         .option("pathGlobFilter", glob))
    r = rate_limit(r, max_files, max_bytes)
    df = r.load(path)
    return df.withColumn("_landing_name", F.coalesce(F.col(NAME_FIELD), file_name())).drop(NAME_FIELD)


def file_name():
    """The name of a row's file; the reader gives it in its URL form (a space as
    ``%20``), in which a plus sign stands for itself."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def rate_limit(reader, max_files: int | None, max_bytes: int | None):
    """Bound a file stream's micro-batches by files or by bytes."""
    if max_files:
        return reader.option("maxFilesPerTrigger", int(max_files))
    if max_bytes:
        return reader.option("maxBytesPerTrigger", int(max_bytes))
    return reader


def source_name_col():
    return F.col("_landing_name")


def sample_schema(spark: SparkSession, path: str, glob: str, multiline: bool = True,
                  sampling_ratio: float = 1.0) -> StructType:
    """Infer the schema of landed files once (batch read of a sample).

    Used to write or review the fixed schemas of ``schemas.py``; streams of
    ``json_stream`` run with a fixed schema, so a new field in a file is ignored
    rather than changing the table.  ``evolving.py`` infers and widens instead.
    """
    return (spark.read.option("multiLine", str(multiline).lower()).option("pathGlobFilter", glob)
            .option("samplingRatio", sampling_ratio).json(path).schema)

"""Documents whose fields are not declared: types are inferred, the schema is
stored beside the stream's checkpoint, and widened when a field appears.

Every micro-batch is looked at whole before it is parsed, so a field is never lost
because a sample did not hold it.  A version of the schema is written before the
first rows that need it; each row knows the version that it was parsed with, and
older rows are read as the latest version (new fields NULL, numbers widened).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .landing import NAME_FIELD, file_name, rate_limit
from .tables import try_read

VERSIONS = "version int, schema_json string"
VERSION = "schema_version"


def stored_versions(spark: SparkSession, path: str) -> dict[int, T.StructType]:
    """Every stored schema by version; empty before the first call."""
    table = try_read(spark, path, VERSIONS)
    rows = [] if table is None else table.collect()  # one row per version
    return {r.version: T.StructType.fromJson(json.loads(r.schema_json))
            for r in sorted(rows, key=lambda r: r.version)}


def store_version(spark: SparkSession, path: str, version: int, schema: T.StructType) -> None:
    spark.createDataFrame([(version, schema.json())], VERSIONS).coalesce(1).write.mode(
        "append").parquet(path)


def plain(dtype: T.DataType) -> T.DataType | None:
    """An inferred type as it is stored: fractions as DOUBLE, mixed values as
    STRING (their JSON text), and None where only NULLs were seen."""
    if isinstance(dtype, T.NullType):
        return None
    if isinstance(dtype, T.DecimalType):
        return T.DoubleType() if dtype.scale else T.LongType()
    if isinstance(dtype, T.VariantType):
        return T.StringType()
    if isinstance(dtype, T.ArrayType):
        inner = plain(dtype.elementType)
        return None if inner is None else T.ArrayType(inner)
    if isinstance(dtype, T.StructType):
        kept = [(f.name, plain(f.dataType)) for f in dtype.fields]
        return T.StructType([T.StructField(n, t) for n, t in kept if t is not None])
    return dtype


def inferred(texts: Column) -> Column:
    """Aggregate: the type that holds every JSON text of a column."""
    return F.schema_of_variant_agg(F.try_parse_json(texts))


def infer(docs: DataFrame, column: str) -> T.StructType:
    """The fields of the JSON objects in ``column``, in one distributed pass."""
    text = docs.agg(inferred(F.col(column)).alias("s")).first().s
    if not text or not text.startswith("OBJECT<"):
        return T.StructType()
    found = T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))
    return plain(found) or T.StructType()


def widen(old: T.DataType, new: T.DataType) -> T.DataType:
    """A type for the values of both: fields of either, the wider number, else
    STRING."""
    if old == new:
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known = {f.name: f.dataType for f in new.fields}
        kept = [T.StructField(f.name, widen(f.dataType, known.pop(f.name))
                              if f.name in known else f.dataType) for f in old.fields]
        return T.StructType(kept + [T.StructField(n, t) for n, t in known.items()])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widen(old.elementType, new.elementType))
    numbers = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    if isinstance(old, numbers) and isinstance(new, numbers):
        whole = isinstance(old, numbers[:2]) and isinstance(new, numbers[:2])
        return T.LongType() if whole else T.DoubleType()
    return T.StringType()


def hinted(schema: T.DataType, hints: dict[str, str], at: str = "") -> T.DataType:
    """``schema`` with the declared types of ``hints``, by path; the elements of an
    array are named ``element``.  A hinted field that was not seen is added."""
    if at in hints:
        return T.DataType.fromDDL(hints[at])
    below = [h[len(at):].lstrip(".").split(".")[0] for h in hints
             if h.startswith(f"{at}." if at else "") and h != at]
    here = lambda name: f"{at}.{name}" if at else name
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(hinted(schema.elementType, hints, here("element")))
    if not isinstance(schema, T.StructType):
        if not below:
            return schema
        if below[0] == "element":
            return T.ArrayType(hinted(T.StructType(), hints, here("element")))
        schema = T.StructType()
    known = {f.name: f.dataType for f in schema.fields}
    for name in below:
        known.setdefault(name, T.NullType())
    return T.StructType([T.StructField(n, hinted(t, hints, here(n))) for n, t in known.items()])


def conform(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """``value`` of an older version's type as the newer version's, fields by name."""
    if old == new:
        return value
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known = {f.name: f.dataType for f in old.fields}
        parts = [conform(value.getField(f.name), known[f.name], f.dataType).alias(f.name)
                 if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
                 for f in new.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: conform(x, old.elementType, new.elementType))
    if isinstance(new, T.StringType) and isinstance(old, (T.StructType, T.ArrayType)):
        return F.to_json(value)
    return value.cast(new)


class EvolvingFeed:
    """One feed of JSON documents with a stored schema, below ``root``.

    ``hints`` declares the types of some nested fields.  ``whole_files`` reads one
    document per file, else one per line.
    """

    def __init__(self, spark: SparkSession, root: str, hints: dict[str, str] | None = None):
        self.spark, self.hints = spark, hints or {}
        self.schemas = f"{root}/_schema"
        self.checkpoint = f"{root}/_checkpoint"
        self.path = f"{root}/rows"

    def ingest(self, landing: str, glob: str, whole_files: bool = False,
               max_files: int | None = None, max_bytes: int | None = None) -> list[int]:
        """Read what has landed since the last call; gives the versions added.

        A document that is no JSON object gives a row of NULLs with its text in
        ``_corrupt_record``.  A batch that is run again overwrites its own rows.
        """
        from ..streaming.ingest import run_available

        reader = (self.spark.readStream.format("text").option("pathGlobFilter", glob)
                  .option("wholetext", str(whole_files).lower()))
        texts = rate_limit(reader, max_files, max_bytes).load(landing).select(
            F.col("value"), file_name().alias("source_file_name"),
            F.current_timestamp().alias("bronze_load_ts"))
        added: list[int] = []

        def each_batch(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            version, schema = self._grown(spark, batch, added)
            parsed = batch.select(
                F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("d"),
                F.when(F.try_parse_json("value").isNull(), F.col("value")).alias("_corrupt_record"),
                "source_file_name", "bronze_load_ts")
            (parsed.write.mode("overwrite")
             .parquet(f"{self.path}/{VERSION}={version}/batch={batch_id}"))

        run_available(texts, self.checkpoint, foreach_batch=each_batch)
        return added

    def _grown(self, spark, batch: DataFrame, added: list[int]) -> tuple[int, T.StructType]:
        versions = stored_versions(spark, self.schemas)
        last = max(versions, default=0)
        old = versions.get(last, T.StructType())
        new = hinted(widen(old, infer(batch, "value")), self.hints)
        if last and new == old:
            return last, old
        store_version(spark, self.schemas, last + 1, new)
        added.append(last + 1)
        return last + 1, new

    def read(self) -> DataFrame | None:
        """Every row so far as the latest version: its fields, ``_corrupt_record``,
        the file's name (a document's own name where it has one), load time and
        version.  None before the first document."""
        versions = stored_versions(self.spark, self.schemas)
        if not versions:
            return None
        latest = versions[max(versions)]
        parts = []
        for version, schema in versions.items():
            stored = T.StructType([
                T.StructField("d", schema), T.StructField("_corrupt_record", T.StringType()),
                T.StructField("source_file_name", T.StringType()),
                T.StructField("bronze_load_ts", T.TimestampType())])
            rows = try_read(self.spark, f"{self.path}/{VERSION}={version}", stored)
            if rows is None:
                continue  # stored by a batch that has not written its rows yet
            named = [conform(F.col(f"d.`{f.name}`"), known, f.dataType) if known is not None
                     else F.lit(None).cast(f.dataType)
                     for f, known in ((f, {g.name: g.dataType for g in schema.fields}.get(f.name))
                                      for f in latest.fields)]
            name = F.col("source_file_name")
            if NAME_FIELD in schema.fieldNames():
                name = F.coalesce(F.col(f"d.{NAME_FIELD}").cast("string"), name)
            parts.append(rows.select(
                *[c.alias(f.name) for c, f in zip(named, latest.fields) if f.name != NAME_FIELD],
                "_corrupt_record", name.alias("source_file_name"), "bronze_load_ts",
                F.lit(version).alias(VERSION)))
        out = None
        for part in parts:
            out = part if out is None else out.unionByName(part)
        return out

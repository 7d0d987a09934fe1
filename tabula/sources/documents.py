"""Nested JSON run documents (info / data maps / inputs), read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STR = T.StringType()
# The fields of a dataset in a run document.
DATASET_FIELDS = ("digest", "name", "profile", "schema", "source", "source_type")

RUN_DOCUMENT = T.StructType(
    [
        T.StructField(
            "info",
            T.StructType(
                [
                    T.StructField("artifact_uri", _STR),
                    T.StructField("end_time", T.LongType()),
                    T.StructField("experiment_id", _STR),
                    T.StructField("lifecycle_stage", _STR),
                    T.StructField("run_id", _STR),
                    T.StructField("run_name", _STR),
                    T.StructField("run_uuid", _STR),
                    T.StructField("start_time", T.LongType()),
                    T.StructField("status", _STR),
                    T.StructField("user_id", _STR),
                ]
            ),
        ),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("metrics", T.MapType(_STR, T.DoubleType())),
                    T.StructField("params", T.MapType(_STR, _STR)),
                    T.StructField("tags", T.MapType(_STR, _STR)),
                ]
            ),
        ),
        T.StructField(
            "inputs",
            T.StructType(
                [
                    T.StructField(
                        "dataset_inputs",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("dataset", T.StructType([T.StructField(n, _STR) for n in DATASET_FIELDS])),
                                    T.StructField(
                                        "tags",
                                        T.ArrayType(T.StructType([T.StructField("key", _STR), T.StructField("value", _STR)])),
                                    ),
                                ]
                            )
                        ),
                    )
                ]
            ),
        ),
    ]
)


def read_run_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per run document: the info fields flattened, the three maps and the dataset inputs."""
    docs = spark.read.schema(RUN_DOCUMENT).option("multiLine", True).json(path)
    return docs.select("info.*", F.col("data.metrics").alias("metrics"), F.col("data.params").alias("params"),
                       F.col("data.tags").alias("tags"), F.col("inputs.dataset_inputs").alias("dataset_inputs"))


def explode_map(docs: DataFrame, map_col: str) -> DataFrame:
    """Long (run_id, key, value) rows from one of the maps."""
    return docs.select("run_id", F.explode(map_col).alias("key", "value"))


def explode_inputs(docs: DataFrame) -> DataFrame:
    """One row per run and dataset it consumed: run_id, the dataset's fields, its tags as a map."""
    rows = docs.select("run_id", F.explode("dataset_inputs").alias("i"))
    tags = F.map_from_entries(F.coalesce("i.tags", F.array().cast("array<struct<key:string,value:string>>")))
    return rows.select("run_id", "i.dataset.*", tags.alias("tags"))


def document_shape(df: DataFrame, col: str, depth: int = 3) -> DataFrame:
    """(path, kind, n): what JSON documents in a text column of unknown shape hold, down to ``depth`` names. Text that
    is no JSON is counted with path and kind ``invalid``; null texts are left out.

    Documents are parsed once, as variants; a level of names is exploded at a time, with the counts of each
    task combined before they are shuffled, so a document's size and not the number of shapes is what a task holds.
    """
    text = F.col(f"`{col}`").cast("string")
    parsed = df.where(text.isNotNull()).select(F.try_parse_json(text).alias("v"))
    kind = lambda v: F.regexp_replace(F.schema_of_variant(v), r"[<(].*", "")
    level = parsed.select(
        F.when(F.col("v").isNull(), F.lit("invalid")).otherwise(F.lit("$")).alias("path"), "v",
        F.when(F.col("v").isNull(), F.lit("invalid")).otherwise(kind(F.col("v"))).alias("kind"),
    )
    found = level.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n"))
    for _ in range(depth):
        inner = level.where("kind = 'OBJECT'").select("path", "v").lateralJoin(
            df.sparkSession.tvf.variant_explode(F.col("v").outer()).select(F.col("key").alias("_key"), F.col("value").alias("_value"))
        )
        level = inner.select(F.concat("path", F.lit("."), "_key").alias("path"), F.col("_value").alias("v"), kind(F.col("_value")).alias("kind"))
        found = found.unionByName(level.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n")))
    return found


def document_values(df: DataFrame, col: str, paths: dict[str, tuple[str, str]], keep: list[str]) -> DataFrame:
    """``keep`` plus one column per entry of ``paths`` (name -> (path, type)) taken out of JSON documents; a path that
    a document lacks, a value of another type and text that is no JSON give null."""
    parsed = df.select(*keep, F.try_parse_json(F.col(f"`{col}`").cast("string")).alias("_document"))
    return parsed.select(*keep, *[F.try_variant_get("_document", path, kind).alias(name) for name, (path, kind) in paths.items()])

"""Readers (S1–S7, S9): every reader returns a DataFrame with an explicit schema;
nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, n_cols: int, sep: str = " ", label_last: bool = True) -> DataFrame:
    """Headerless numeric table (space or comma separated) → (features array<double>, label int).

    A trailing separator yields one empty extra column, which is dropped.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.DoubleType()) for i in range(n_cols + 1)])
    df = spark.read.csv(path, sep=sep, header=False, schema=schema, ignoreTrailingWhiteSpace=True)
    cols = [f"_c{i}" for i in range(n_cols)]
    if label_last:
        return df.select(F.array(*cols[:-1]).alias("features"), F.col(cols[-1]).cast("int").alias("label"))
    return df.select(F.col(cols[0]).cast("int").alias("label"), F.array(*cols[1:]).alias("features"))


def read_labelled_rows(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Text lines 'label, v1, v2, ...' → (label int, features array<double>)."""
    t = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    parts = F.split(F.trim("value"), sep)
    return t.select(parts[0].cast("int").alias("label"),
                    F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda x: F.trim(x).cast("double")).alias("features"))


ANNOTATION_SCHEMA = T.StructType([
    T.StructField("categories", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("supercategory", T.StringType())]))),
    T.StructField("images", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("file_name", T.StringType()),
        T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))),
    T.StructField("annotations", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("image_id", T.LongType()), T.StructField("category_id", T.LongType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType()))]))),
])


def read_annotations(spark: SparkSession, path: str, multi_line: bool = False) -> dict[str, DataFrame]:
    """S3: annotation JSON → categories, images and annotations tables.

    Objects on one line each are split among tasks as lines; with ``multi_line`` a file is one object, of any size, and
    is split among tasks at the objects of its lists.
    """
    if multi_line:
        from lodestar.sources.annotations import read_annotation_file

        lists = read_annotation_file(spark, path, ANNOTATION_SCHEMA)
    else:
        raw = spark.read.json(path, schema=ANNOTATION_SCHEMA)
        lists = {name: raw.select(F.explode(name).alias("o")).select("o.*") for name in ANNOTATION_SCHEMA.fieldNames()}
    boxes = [F.col("bbox")[i].cast("int").alias(n) for i, n in enumerate(["x", "y", "w", "h"])]
    return lists | {"annotations": lists["annotations"].select("id", "image_id", "category_id", *boxes)}


def read_feature_bundle(spark: SparkSession, path: str) -> DataFrame:
    """Parallel id / feature lists → one row per id (null features dropped)."""
    b = spark.read.parquet(path)
    z = b.select(F.explode(F.arrays_zip("ids", "features")).alias("z"))
    return z.select(F.col("z.ids").alias("id"), F.col("z.features").alias("features")).where(F.col("features").isNotNull())


def read_partitioned(spark: SparkSession, path: str, split: str | None = None, category: int | None = None) -> DataFrame:
    """A table partitioned by (split, category_id); filters prune partitions at planning time."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.where(F.col("split") == split)
    if category is not None:
        df = df.where(F.col("category_id") == category)
    return df


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A stored weight matrix as (model_id, layer, i, values)."""
    return spark.read.parquet(path)


def image_catalog(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """Which image files exist (path, size, modification time); decoding is not done here."""
    b = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return b.select("path", "length", "modificationTime").where(F.col("length") > 0)


def with_images(df: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` has an image in the catalog."""
    return df.join(catalog.select(key).distinct(), key, "left_semi")

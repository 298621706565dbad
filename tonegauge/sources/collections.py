"""Document collections, through their Spark connector or an export."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_collection(
    spark: SparkSession, collection: str, database: str | None = None,
    uri: str | None = None, export: str | None = None, schema: StructType | None = None,
    label: str = "mongodb",
) -> DataFrame:
    """A collection without its object id, tagged with its source.

    With ``export`` the records come from JSON lines; otherwise the session must
    have the MongoDB connector on its class path.  An empty collection is an error.
    """
    if export is not None:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.json(export)
    else:
        reader = spark.read.format("mongodb").option("collection", collection)
        for key, value in (("connection.uri", uri), ("database", database)):
            reader = reader.option(key, value) if value else reader
        df = (reader.schema(schema) if schema is not None else reader).load()
    if df.isEmpty():
        raise ValueError(f"collection {collection} is empty")
    return df.drop("_id").withColumn("metadata_source", F.lit(label))

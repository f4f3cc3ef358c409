"""Equipment documents: a JSON export, or a collection through a connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.columns import pick
from millrace.schemas import EQUIPMENT_DOCUMENT

# Output column -> path in the document. The sensors array stays nested.
FLAT_EQUIPMENT = {
    "equipamento_id": "_id",
    "nome": "name",
    "tipo": "type",
    "fabrica_id": "factory.id",
    "fabrica_nome": "factory.name",
    "latitude": "factory.location.lat",
    "longitude": "factory.location.lng",
    "sensors": "sensors",
    "periodicidade_manutencao": "maintenance_schedule",
    "instalado_em": "installed_at",
    "status": "status",
}


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EQUIPMENT_DOCUMENT).json(path)


def collection_documents(
    spark: SparkSession, uri: str, database: str, collection: str
) -> DataFrame:
    """Needs the MongoDB Spark connector on the classpath."""
    return (
        spark.read.schema(EQUIPMENT_DOCUMENT)
        .format("mongodb")
        .option("connection.uri", uri)
        .option("database", database)
        .option("collection", collection)
        .load()
    )


def flatten_equipment(documents: DataFrame) -> DataFrame:
    return pick(documents, FLAT_EQUIPMENT)

"""JSON messages: envelopes of the topics that are read and written."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from milepost.schemas import ACTIVITY_EVENT, RELEASE_TYPE


def decode_rows(messages: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """Messages holding a JSON array of rows (or one bare row) to rows.

    Text that is no JSON gives no rows.
    """
    parsed = F.from_json(F.col(column).cast("string"), ArrayType(schema))
    return messages.select(F.explode(parsed).alias("row")).select("row.*")


def decode_object(messages: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """Messages holding one JSON object each; junk gives a row of nulls."""
    return messages.select(F.from_json(F.col(column).cast("string"), schema).alias("row")).select("row.*")


def first_user_phone(datas: Column) -> Column:
    """Phone of the first user in a user event's payload; null when missing or empty."""
    phone = F.get_json_object(datas, "$[0].User.Phone")
    return F.when(phone != "", phone)


def event_message(df: DataFrame) -> DataFrame:
    """Event rows as messages: a JSON array with one event."""
    row = F.struct(*[F.col(name) for name in ACTIVITY_EVENT.names])
    return df.select(F.to_json(F.array(row)).alias("value"))


def row_message(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as messages: a bare JSON object each, nulls written out."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def feature() -> Column:
    """A live report as a GeoJSON point."""
    geometry = F.struct(F.array("lng", "lat").alias("coordinates"), F.lit("Point").alias("type"))
    properties = F.struct(
        F.col("id"),
        F.col("user_heading").alias("heading"),
        F.col("expired_display_time").alias("expiredDisplayTimeUnix"),
        F.coalesce("cell_id", F.lit("")).alias("cellId"),
        F.col("number_of_view").alias("numberOfView"),
        F.col("number_of_confirm").alias("numberOfConfirm"),
        F.col("number_of_rejection").alias("numberOfRejection"),
        F.col("minimization_hex_color").alias("minimizationHexColor"),
    )
    return F.struct(geometry.alias("geometry"), properties.alias("properties"), F.lit("Feature").alias("type"))


def feature_collection(trans_id: Column, features: Column, total: Column) -> Column:
    data = F.struct(features.alias("features"), F.lit("FeatureCollection").alias("type"))
    message = F.struct(
        trans_id.alias("trans_id"),
        F.lit(RELEASE_TYPE).alias("message_type"),
        data.alias("data"),
        total.alias("total_records"),
    )
    return F.to_json(message, {"ignoreNullFields": "false"})

"""Declared input schemas. Every field is nullable: malformed input must not stop a scan."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed: the fields of each entity. `{id}` is the type of its identifier.
FIELDS = {
    "products": (
        "id {id}, title string, price double, description string, category string, image string, "
        "rating struct<rate: double, count: int>"
    ),
    "users": (
        "id {id}, email string, username string, password string, phone string, __v int, "
        "name struct<firstname: string, lastname: string>, "
        "address struct<city: string, street: string, number: int, zipcode: string, "
        "geolocation: struct<lat: string, long: string>>"
    ),
}
ID_TYPES = ("int", "bigint", "string")


def schema_ddl(entity: str, id_type: str = "int") -> str:
    if entity not in FIELDS:
        raise ValueError(f"unknown entity {entity!r}, expected one of {sorted(FIELDS)}")
    if id_type not in ID_TYPES:
        raise ValueError(f"unknown id type {id_type!r}, expected one of {ID_TYPES}")
    return FIELDS[entity].format(id=id_type)


def entity_schema(entity: str, id_type: str = "int") -> T.StructType:
    """Schema of an entity. Ids that outgrow an int need `id_type="bigint"`: they would read as NULL."""
    return T.StructType.fromDDL(schema_ddl(entity, id_type))


def __getattr__(name: str) -> T.StructType:
    """`PRODUCTS` and `USERS`, the schemas with int ids. Spark parses them, so they are made when a session is there."""
    if name in ("PRODUCTS", "USERS"):
        return entity_schema(name.lower())
    raise AttributeError(name)

"""SILVER: flattened, normalised, quality-flagged rows, the latest one per id.

`*_checked` has a row for every input row and moves no data. `products` and
`users` first take the latest bronze row of every id, the only shuffle, and then
check what is left: cleaning is row by row, so the result is the same as cleaning
first, while derived columns are neither shuffled nor computed for old versions.
Rows without an id cannot be versioned; they belong to the quarantine.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.functions import numeric, predicates, text
from layerforge.functions.audit import AsOf, audit_time
from layerforge.operators import quality
from layerforge.operators.dedup import latest_per_key, newest_first
from layerforge.operators.merge import evolved_union
from layerforge.sources.scans import BROKEN, broken_reason

# The category taxonomy and, below, the tags of the rules.
CATEGORIES = {
    "men's clothing": "mens_clothing",
    "women's clothing": "womens_clothing",
    "jewelery": "jewelry",
    "electronics": "electronics",
}


def with_typed_id(bronze: DataFrame, id_type: str) -> DataFrame:
    """Cast the id before rows are told apart by it: an id that does not cast is no id, `"07"` is 7."""
    return bronze.withColumn("id", F.col("id").try_cast(id_type))


def line_rules(carry: Sequence[str]) -> list[quality.Rule]:
    """Rules on the line itself, where its text is carried: it did not parse, or not all of its fields did."""
    if BROKEN not in carry:
        return []
    reason = broken_reason()
    return [("line_not_json", reason == "not_json"), ("field_mistyped", reason == "field_mistyped")]


def tags(entity: str) -> list[str]:
    """The tags that rows of an entity can have."""
    rules = product_rules() if entity == "products" else user_rules()
    return [tag for tag, _ in [*rules, *line_rules((BROKEN,))]]


def latest_versions(bronze: DataFrame, ties: Sequence[str] | None = None) -> DataFrame:
    """Newest row per id, rows without a timestamp last.

    All rows of one run share `processed_at`, so it does not take part. `ties` are
    the columns that tell versions with equal timestamps apart.
    """
    return latest_per_key(bronze, "id", newest_first("ingestion_ts"), ties=ties)


# ------------------------------------------------------------------ products


def flat_products(
    bronze: DataFrame, as_of: AsOf = None, id_type: str = "int", carry: Sequence[str] = ()
) -> DataFrame:
    """Flatten the rating, trim text, round the price; the category is still raw. `carry` names columns to keep."""
    return bronze.select(
        F.col("id").try_cast(id_type).alias("id"),
        F.trim("title").alias("title"),
        numeric.cents(F.col("price")).alias("price"),
        F.trim("description").alias("description"),
        text.lower_trimmed(F.col("category")).alias("category_raw"),
        "image",
        F.col("rating.rate").cast("double").alias("rating_rate"),
        F.col("rating.count").cast("int").alias("rating_count"),
        "ingestion_ts",
        audit_time(as_of).alias("processed_at"),
        *carry,
    )


def nullify_products(df: DataFrame) -> DataFrame:
    """NULL for negative prices and counts, rates out of range and non-web images."""
    price, rate = F.col("price"), F.col("rating_rate")
    count, image = F.col("rating_count"), F.col("image")
    return df.withColumns(
        {
            "price": numeric.null_if(price, price < 0),
            "rating_rate": numeric.null_if(
                rate, ~rate.between(numeric.RATE_LOW, numeric.RATE_HIGH)
            ),
            "rating_count": numeric.null_if(count, count < 0),
            "image": numeric.null_if(
                image, predicates.mismatches(image, predicates.URL_PATTERN)
            ),
        }
    )


def product_rules() -> list[quality.Rule]:
    return [
        ("id_null", F.col("id").isNull()),
        ("title_empty", predicates.blank(F.col("title"))),
        ("price_invalid", F.col("price").isNull()),
        ("category_unmapped", F.col("category") == quality.UNKNOWN_CATEGORY),
    ]


def products_checked(
    bronze: DataFrame,
    as_of: AsOf = None,
    taxonomy: Mapping[str, str] | DataFrame = CATEGORIES,
    id_type: str = "int",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every product row, cleaned and flagged. The taxonomy is a mapping or a table."""
    flat = flat_products(bronze, as_of, id_type, carry)
    categorise = (
        quality.with_category_table if isinstance(taxonomy, DataFrame) else quality.with_category
    )
    return quality.with_issues(
        nullify_products(categorise(flat, "category_raw", taxonomy)), [*product_rules(), *line_rules(carry)]
    )


def products(
    bronze: DataFrame,
    as_of: AsOf = None,
    taxonomy: Mapping[str, str] | DataFrame = CATEGORIES,
    id_type: str = "int",
    ties: Sequence[str] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The latest version of every product, cleaned and flagged."""
    latest = latest_versions(with_typed_id(bronze, id_type), ties)
    return products_checked(latest, as_of, taxonomy, id_type, carry)


# --------------------------------------------------------------------- users


def flat_users(
    bronze: DataFrame, as_of: AsOf = None, id_type: str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Flatten name and address, normalise text, parse coordinates. The password is left out."""
    first = text.title_case(F.col("name.firstname"))
    last = text.title_case(F.col("name.lastname"))
    street = text.squeezed_title_case(F.col("address.street"))
    return bronze.select(
        (F.col("id") if id_type is None else F.col("id").try_cast(id_type)).alias("id"),
        text.lower_trimmed(F.col("email")).alias("email"),
        text.lower_trimmed(F.col("username")).alias("username"),
        text.phone_digits(F.col("phone")).alias("phone"),
        first.alias("firstname"),
        last.alias("lastname"),
        text.joined(" ", first, last).alias("full_name"),
        text.title_case(F.col("address.city")).alias("city"),
        street.alias("street"),
        F.col("address.number").alias("number"),
        text.upper_trimmed(F.col("address.zipcode")).alias("zipcode"),
        text.joined(", ", street, F.col("address.number")).alias("address_line"),
        numeric.plain_double(F.col("address.geolocation.lat")).alias("lat"),
        numeric.plain_double(F.col("address.geolocation.long")).alias("long"),
        F.col("__v").alias("_v"),
        "file_origin",
        "ingestion_ts",
        audit_time(as_of).alias("processed_at"),
        *carry,
    )


def user_rules() -> list[quality.Rule]:
    """A missing e-mail is an issue, a missing ZIP code is not."""
    return [
        ("id_null", F.col("id").isNull()),
        ("email_invalid", F.col("email").isNull() | F.col("dq_email_invalid")),
        ("username_empty", predicates.blank(F.col("username"))),
        ("zipcode_invalid", F.col("dq_zip_invalid")),
        ("geolocation_invalid", F.col("dq_geo_invalid")),
    ]


def users_checked(
    bronze: DataFrame, as_of: AsOf = None, id_type: str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Every user row, cleaned and flagged. Without `id_type` the id keeps its type."""
    flagged = flat_users(bronze, as_of, id_type, carry).withColumns(
        {
            "dq_email_invalid": predicates.mismatches(F.col("email"), predicates.EMAIL_PATTERN),
            "dq_zip_invalid": predicates.mismatches(F.col("zipcode"), predicates.ZIP_PATTERN),
            "dq_geo_invalid": predicates.off_the_globe(F.col("lat"), F.col("long")),
        }
    )
    return quality.with_issues(flagged, [*user_rules(), *line_rules(carry)])


def users(
    bronze: DataFrame,
    as_of: AsOf = None,
    ties: Sequence[str] | None = None,
    id_type: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The latest version of every user, cleaned and flagged."""
    typed = bronze if id_type is None else with_typed_id(bronze, id_type)
    return users_checked(latest_versions(typed, ties), as_of, id_type, carry)


# ---------------------------------------------------------------- quarantine


def quarantine(latest: DataFrame, keyless: DataFrame) -> DataFrame:
    """Latest rows with an issue, and every checked row that has no id."""
    return evolved_union(quality.quarantined(latest), quality.without_key(keyless, "id"))

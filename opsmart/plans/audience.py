"""Customer audiences and their phone numbers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from opsmart.functions.phone import CALLING_CODES, e164
from opsmart.functions.text import blank_to_null


def audience(customers: DataFrame, addresses: DataFrame) -> DataFrame:
    """Customers with an e-mail address, at their default address."""
    home = addresses.filter("is_default").select(
        F.col("customer_id").alias("id"), "city", "zip", "country", "country_code", "phone"
    )
    people = customers.filter(F.col("email").isNotNull()).select("id", "email", "first_name", "last_name")
    return people.join(home, "id", "inner")


def audience_export(members: DataFrame) -> DataFrame:
    """The columns an ad audience takes; the country is its two-letter code."""
    return members.select(
        "email", "first_name", "last_name", "zip", F.col("country_code").alias("country"), "phone"
    )


@dataclass(frozen=True)
class Phones:
    all: DataFrame       # every member, phone in E.164 or NULL
    changed: DataFrame   # id and phone of members whose number was understood
    failed: DataFrame    # id and original of members whose number was not
    counts: DataFrame    # one row: parsed, failed, blank


def normalise_phones(members: DataFrame, codes: dict = CALLING_CODES, default: str = "US", key: str = "id") -> Phones:
    """Bring phones to E.164 in one projection. A number that cannot be read
    becomes NULL; blank ones become NULL too."""
    raw = blank_to_null(F.col("phone"))
    parsed = e164(raw, F.col("country_code"), codes, default)
    worked = members.withColumns({"_raw": raw, "_parsed": parsed})
    good, bad = F.col("_parsed").isNotNull(), F.col("_raw").isNotNull() & F.col("_parsed").isNull()
    return Phones(
        all=worked.withColumn("phone", F.col("_parsed")).drop("_raw", "_parsed"),
        changed=worked.filter(good).select(key, F.col("_parsed").alias("phone")),
        failed=worked.filter(bad).select(key, F.col("_raw").alias("phone")),
        counts=worked.agg(
            F.count_if(good).alias("parsed"), F.count_if(bad).alias("failed"),
            F.count_if(F.col("_raw").isNull()).alias("blank"),
        ),
    )

"""Form answers as patient payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.functions.times import us_date_to_iso

# Payload field and the question whose first answer fills it.
QUESTIONS = {
    "fname": "First Name",
    "mname": "Middle Name",
    "lname": "Last Name",
    "sex": "Sex",
    "dob": "Date of Birth (MM/DD/YYYY)",
    "ht": "Height (inches)",
    "wt": "Weight (pounds)",
    "cn": "Contact Number (Area Code - Phone Number)",
    "ms": "Marital Status",
    "addrstreet": "Address - Street",
    "addrcity": "Address - City",
    "addrstate": "Address - State",
    "addrzip": "Address - ZipCode",
    "addrstart": "Address - Living since",
    "addruse": "Address - Use",
    "email": "Email Address",
}
DATE_FIELDS = ("dob",)


def _answer(named_values: Column, field: str) -> Column:
    first = F.try_element_at(F.try_element_at(named_values, F.lit(QUESTIONS[field])), F.lit(1))
    return us_date_to_iso(first) if field in DATE_FIELDS else first


def form_payload(df: DataFrame, named_values: str = "named_values") -> DataFrame:
    """The first answer to each question, as one JSON payload. Unanswered fields are left out."""
    fields = [_answer(F.col(named_values), f).alias(f) for f in QUESTIONS]
    return df.withColumn("payload", F.to_json(F.struct(*fields)))

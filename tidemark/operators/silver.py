"""Bronze to silver: typed, flagged and enriched rows. No row is dropped."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import lenient_date, lenient_double, lenient_int
from tidemark.functions.marks import instant


def is_valid(amount: Column) -> Column:
    """True for a positive amount (NaN counts as positive), else false; never NULL."""
    return F.coalesce(amount > 0, F.lit(False))


def category_code(category: Column) -> Column:
    return F.upper(category)


def event_day(transaction_date: Column) -> Column:
    return F.date_format(transaction_date, "yyyy-MM-dd")


def has_customer_id(customer_id: Column) -> Column:
    return customer_id.isNotNull()


def discount_amount(amount: Column, discount_pct: Column) -> Column:
    """Zero without a discount; NULL if the discount applies to no amount or does not parse."""
    return F.when(discount_pct.isNull(), F.lit(0.0)).otherwise(amount * lenient_double(discount_pct))


def to_silver(bronze: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """All silver columns in two projections, which Catalyst folds into the scan's.

    ``amount``, ``quantity``, ``transaction_date`` and ``dt`` replace the bronze
    columns of that name; every other bronze column passes through.
    """
    types = {field.name: field.dataType for field in bronze.schema.fields}
    typed = bronze.withColumns(
        {
            "processed_at": instant(as_of),
            "amount": lenient_double(F.col("amount")),
            "quantity": lenient_int(F.col("quantity"), types["quantity"]),
            "transaction_date": lenient_date(F.col("transaction_date"), types["transaction_date"]),
        }
    )
    return typed.withColumns(
        {
            "is_valid": is_valid(F.col("amount")),
            "category_code": category_code(F.col("category")),
            "dt": event_day(F.col("transaction_date")),
            "has_customer_id": has_customer_id(F.col("customer_id")),
            "discount_amount": discount_amount(F.col("amount"), F.col("discount_pct")),
        }
    )

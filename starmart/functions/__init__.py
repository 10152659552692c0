"""Column expressions; all native, none needs a Python worker."""

from starmart.functions.columns import count_non_null, count_null, quoted, strip, to_int_or_null
from starmart.functions.dates import sas_days_to_date, text_to_date

__all__ = ["count_non_null", "count_null", "quoted", "sas_days_to_date", "strip", "text_to_date", "to_int_or_null"]

"""Column expressions shared by the cleaners. All of them run in the JVM.

Casts use the ``try_`` forms, so a malformed value becomes null whether or not the
session runs in ANSI mode.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letter in front of each business ID, the clock pattern (one or two
# hour digits) and the stand-ins for values that are missing.
ID_PREFIX = {
    "appointment_id": "A",
    "patient_id": "P",
    "doctor_id": "D",
    "treatment_id": "T",
    "bill_id": "B",
}
EVENT_PATTERN = "yyyy-MM-dd H:mm:ss"
UNKNOWN = "UNKNOWN"
DEFAULT_BRANCH = "Central Hospital"

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardize_id(c: ColumnOrName, prefix: str, id_type: str = "bigint") -> Column:
    """``D101`` -> ``101``; null when what is left after removing the letter is no number."""
    return F.replace(_col(c).cast("string"), F.lit(prefix), F.lit("")).try_cast(id_type)


def standard_ids(*names: str, id_type: str = "bigint") -> dict[str, Column]:
    """``standardize_id`` for columns that carry one of the known business IDs."""
    return {n: standardize_id(n, ID_PREFIX[n], id_type) for n in names}


def title_clean(c: ColumnOrName) -> Column:
    """First letter of each blank-separated word in upper case, outer blanks removed."""
    return F.trim(F.initcap(_col(c)))


def full_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    """Both parts with one blank between; a missing part is left out."""
    return F.concat_ws(" ", _col(first), _col(last))


def address_region(address: ColumnOrName) -> Column:
    """Second word of an address (``789 Pine Rd`` -> ``Pine``), null when there is none."""
    return F.get(F.split(_col(address), " "), F.lit(1))


def as_date(c: ColumnOrName) -> Column:
    return _col(c).try_cast("date")


def as_real(c: ColumnOrName) -> Column:
    return _col(c).try_cast("float")


def cents(c: ColumnOrName) -> Column:
    """Money as whole cents, halves away from zero; null for NaN.

    Sums of whole numbers are exact and do not depend on the order of rows, and cost a
    fraction of sums of decimals.
    """
    amount = _col(c).cast("double")
    return (F.signum(amount) * F.floor(F.abs(amount) * 100 + 0.5)).try_cast("bigint")


def money(total_cents: ColumnOrName) -> Column:
    """A sum of ``cents`` as an exact amount."""
    return (_col(total_cents).cast("decimal(20,0)") / F.lit(100)).cast("decimal(22,2)")


def date_key(c: ColumnOrName) -> Column:
    """Date as the number yyyyMMdd, by arithmetic instead of text."""
    d = as_date(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def event_timestamp(date: ColumnOrName, time: ColumnOrName) -> Column:
    """Date plus clock text; null when either part is missing or does not parse."""
    return F.try_to_timestamp(
        F.concat_ws(" ", as_date(date).cast("string"), _col(time)), F.lit(EVENT_PATTERN))


def run_date(as_of: dt.date | str | None = None) -> Column:
    """The date a run counts as today; without one, the clock's."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def age_in_years(birth_year: ColumnOrName, as_of: dt.date | str | None = None) -> Column:
    """Calendar-year difference, as the warehouse defines age."""
    return F.year(run_date(as_of)) - _col(birth_year)

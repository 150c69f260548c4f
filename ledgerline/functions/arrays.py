"""Array, conditional and money expressions (AR1-AR5, CD2, MA1, MA2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed values that must equal the reference's behaviour: option slot -> the
# option names (case-folded) that fill it.
OPTION_ALIASES = {
    "option1": ("option1", "title"),
    "option2": ("option2", "size"),
    "option3": ("option3", "color"),
}
AVAILABLE_QUANTITY_NAME = "available"


def first_or_null(arr) -> Column:
    """AR1: first element, null for a null or empty array (``get`` never
    raises, unlike ``arr[0]`` under ANSI)."""
    return F.get(as_col(arr), 0)


def first_match(arr, field: str, values, value_field: str | None = None) -> Column:
    """AR2: first element whose ``field`` (case-folded) is in ``values``;
    returns that element, or its ``value_field`` when given."""
    vals = [v.lower() for v in values]
    hit = F.get(F.filter(as_col(arr), lambda x: F.lower(x[field]).isin(*vals)), 0)
    return hit[value_field] if value_field else hit


def joined_set(arr, sep: str = ", ") -> Column:
    """AR3: distinct, sorted, joined text of an array (null elements dropped)."""
    return F.array_join(F.array_sort(F.array_distinct(as_col(arr))), sep)


def unwrap_edges(conn) -> Column:
    """AR4: connection ``{edges: [{node: x}]}`` -> ``[x]``; null -> empty."""
    edges = as_col(conn)["edges"]
    return F.coalesce(F.transform(edges, lambda e: e["node"]), F.array())


def weight_unit(c, default: str = "kg") -> Column:
    """CD2: ``grams`` -> ``g``, otherwise lower case, missing -> default."""
    c = F.lower(as_col(c))
    return F.when(c == "grams", F.lit("g")).otherwise(F.coalesce(c, F.lit(default)))


def available_quantity(quantities) -> Column:
    """AR2: quantity named ``available`` in a list of ``{name, quantity}``, 0
    when absent."""
    hit = F.get(F.filter(as_col(quantities), lambda q: q["name"] == AVAILABLE_QUANTITY_NAME), 0)
    return F.coalesce(hit["quantity"], F.lit(0))


def round_half_up(c, places: int = 2, precision: int = 38) -> Column:
    """MA1: decimal rounding HALF_UP (``round`` is HALF_UP on decimals)."""
    return F.round(as_col(c).cast(f"decimal({precision},{max(places, 6)})"), places)


def decimal_product(a, b, places: int = 2, a_type: str = "decimal(18,4)",
                    b_type: str = "decimal(10,4)") -> Column:
    """MA1: ``round(Decimal(a) * Decimal(b), places)`` HALF_UP."""
    return F.round(as_col(a).cast(a_type) * as_col(b).cast(b_type), places)


def int_quantity(c) -> Column:
    """MA2: integer cast of a quantity (truncates)."""
    return as_col(c).cast("int")


def distinct_of_lists(lists) -> Column:
    """AG15: the sorted distinct values of a list of lists (of a group that is gathered in one row anyway)."""
    return F.array_sort(F.array_distinct(F.flatten(as_col(lists))))

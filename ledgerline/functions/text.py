"""Text column expressions (ST1-ST19).

All helpers return ``Column`` objects built from Spark SQL functions, so they
stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed values that must equal the reference's behaviour.
GID_ROOT = "gid://shopify/"                     # global-id prefix root
ADDRESS_QUERY_MARKER = "?model_name=CustomerAddress"
RETURN_INVOICE_PREFIX = "61-"                   # invoices that are returns
BLANK_SENTINELS = ("nan", "False")              # whole values read as ''
NULL_SENTINEL = "null"                          # whole value read as null
LONE_AMPERSAND = r"&(?!#?\w+;)"                 # '&' not starting an entity


def strip_gid(c, obj_type: str = "Order") -> Column:
    """ST1: last ``/`` segment when the value starts with the object's global
    id prefix, otherwise the value unchanged (null and '' pass through)."""
    c = as_col(c)
    prefix = f"{GID_ROOT}{obj_type}/"
    return F.when(c.startswith(prefix), F.element_at(F.split(c, "/"), -1)).otherwise(c)


def strip_gid_after_prefix(c, obj_type: str = "Product") -> Column:
    """ST2: null or '' -> null; text after the prefix when present; else as is."""
    c = as_col(c)
    prefix = f"{GID_ROOT}{obj_type}/"
    return (F.when(c.isNull() | (c == ""), F.lit(None).cast("string"))
            .when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30))
            .otherwise(c))


def cut_query_suffix(c, marker: str = ADDRESS_QUERY_MARKER) -> Column:
    """ST3: drop a ``?...`` suffix from ids that carry the marker."""
    c = as_col(c)
    return F.when(c.contains(marker), F.substring_index(c, "?", 1)).otherwise(c)


def py_float_text(c) -> Column:
    """Text of a double as Python's ``str(float)`` prints it for ordinary
    magnitudes (``12345678.0`` rather than Java's ``1.2345678E7``)."""
    c = as_col(c)
    plain = F.regexp_replace(c.cast("decimal(38,10)").cast("string"), r"0+$", "")
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain))


def key_text(*cols, sep: str = "-", null_marker: str = "None",
             float_cols: tuple = ()) -> Column:
    """ST4/ST5: composite key ``sep.join(str(part))``.

    A null part prints as ``null_marker`` (``None`` for text, ``nan`` for float
    columns in the source), never skipped: bare ``concat_ws`` skips nulls and
    would let different keys collide.  Parts named in ``float_cols`` print as
    Python floats.
    """
    parts = []
    for c in cols:
        name = c if isinstance(c, str) else None
        col = as_col(c)
        if name is not None and name in float_cols:
            txt = py_float_text(col)
            marker = "nan"
        else:
            txt = col.cast("string")
            marker = null_marker
        parts.append(F.coalesce(txt, F.lit(marker)))
    return F.concat_ws(sep, *parts)


def key_if_all(*cols, sep: str = "-") -> Column:
    """ST6: ``sep``-joined key when every part is non-null and non-empty, else ''."""
    cs = [as_col(c).cast("string") for c in cols]
    ok = None
    for c in cs:
        cond = c.isNotNull() & (c != "")
        ok = cond if ok is None else ok & cond
    return F.when(ok, F.concat_ws(sep, *cs)).otherwise(F.lit(""))


def first_word(c) -> Column:
    """ST12: text before the first space (whole value if none)."""
    return F.element_at(F.split(as_col(c), " ", 2), 1)


def rest_words(c) -> Column:
    """ST12: text after the first space, '' when there is none."""
    return F.coalesce(F.get(F.split(as_col(c), " ", 2), 1), F.lit(""))


def sale_event_name(invoice_id, store=None) -> Column:
    """ST13: event label of a retail sale; returns (invoice ``61-...``) get
    their own label; ``store`` (upper-cased) is appended when given."""
    inv = as_col(invoice_id)
    base = F.when(inv.startswith(RETURN_INVOICE_PREFIX), F.lit("[NC] Placed retail return")) \
        .otherwise(F.lit("Placed Retail Order"))
    if store is None:
        return base
    return F.concat(base, F.lit(" - "), F.upper(as_col(store).cast("string")))


def repair_ampersands(c) -> Column:
    """ST14: escape ``&`` that does not start an entity reference."""
    return F.regexp_replace(as_col(c), LONE_AMPERSAND, "&amp;")


def html_unescape(c) -> Column:
    """ST15: unescape the five predefined entities, ``&amp;`` last so that
    ``&amp;lt;`` becomes ``&lt;`` and not ``<``."""
    c = as_col(c)
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'")):
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def blank_sentinels(c, sentinels=BLANK_SENTINELS) -> Column:
    """ST16: whole-value sentinels (``nan``, ``False``) become ''."""
    c = as_col(c)
    return F.when(c.isin(*sentinels), F.lit("")).otherwise(c)


def null_sentinel(c, sentinel: str = NULL_SENTINEL) -> Column:
    """ST17: the text ``null`` becomes a real null."""
    return F.nullif(as_col(c), F.lit(sentinel))


def html_link(base_url: str, id_col, label_col) -> Column:
    """PR17/ST19: ``<a href="{base}{id}" target="_blank">{label}</a>``."""
    return F.format_string('<a href="%s%s" target="_blank">%s</a>', F.lit(base_url),
                           as_col(id_col).cast("string"), as_col(label_col).cast("string"))


def address_text(street, city) -> Column:
    """ST19: ``"{street}, {city}"`` when either part is non-empty, else ''
    (a missing part prints as '', so one side may be empty around the comma)."""
    s = F.coalesce(as_col(street).cast("string"), F.lit(""))
    c = F.coalesce(as_col(city).cast("string"), F.lit(""))
    return F.when((s != "") | (c != ""), F.concat(s, F.lit(", "), c)).otherwise(F.lit(""))


def split_list(c, sep: str = ", ") -> Column:
    """ST12: list text -> array; null or '' -> empty array."""
    c = as_col(c)
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.split(c, sep))

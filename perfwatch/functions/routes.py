"""Column expressions that standardise route and device-type spellings.

All built-in functions, so they stay inside whole-stage codegen.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perfwatch.config import DEVICE_TYPE_ALIASES, ROUTE_ALIASES, VALID_DEVICE_TYPES


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal_map(pairs) -> Column:
    """Constant map; written as one SQL literal so it costs one call to
    build (Catalyst folds it to a literal either way)."""
    return F.expr("map(" + ", ".join(_sql_str(v) for pair in pairs for v in pair) + ")")


# Cut at the first ? or #, skip surrounding spaces, one leading "/" and one
# trailing "/"; the rest is the path body.
_ROUTE_BODY = r"^ */?([^?#]*?)/? *(?:[?#]|\z)"


def clean_route(col: Column | str) -> Column:
    """Path part of a route: cut at the first ``?`` or ``#``, trim spaces,
    lower-case, make sure it starts with ``/`` and drop one trailing ``/``
    (a bare ``/`` stays).  NULL stays NULL.

    One anchored regular expression does the cutting and trimming (its input
    is used once), so the expression stays small even where the optimizer
    copies it into a pushed-down filter."""
    c = F.col(col) if isinstance(col, str) else col
    # the pattern only looks at " ", "/", "?" and "#", which have no case, so
    # lower-casing after the cut touches the path only, not the query string
    return F.concat(F.lit("/"), F.lower(F.regexp_extract(c, _ROUTE_BODY, 1)))


def canonical_route(col: Column | str) -> Column:
    """``clean_route`` then the alias table; unknown routes pass through."""
    cleaned = clean_route(col)
    return F.coalesce(_literal_map(ROUTE_ALIASES)[cleaned], cleaned)


def canonical_device_type(col: Column | str, valid=VALID_DEVICE_TYPES) -> Column:
    """lower+trim, alias table, then anything outside ``valid`` (NULL
    included) becomes ``unknown``.  Valid types map to themselves in the
    lookup table, so the input is read once."""
    c = F.col(col) if isinstance(col, str) else col
    table = tuple((k, v) for k, v in DEVICE_TYPE_ALIASES if v in valid) + tuple((v, v) for v in valid)
    return F.coalesce(_literal_map(table)[F.lower(F.trim(c))], F.lit("unknown"))


def url_path(col: Column | str) -> Column:
    """Path of an absolute URL (scheme and authority removed); a value
    without ``scheme://`` is returned unchanged.  Query and fragment are left
    for ``clean_route`` to cut."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")

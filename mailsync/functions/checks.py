"""Row checks as Column predicates (F2-F6). All JVM-side; nothing is evaluated row by row in Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsync import constants as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(text) -> Column:
    """Null, empty, or only white space and control characters (tab, newline and the like included)."""
    return F.coalesce(_col(text), F.lit("")).rlike(r"\A[\x00-\x20\p{Z}]*\z")


def has_attrs(attributes, names) -> Column:
    """true when every named attribute is present (not null)."""
    cond = F.lit(True)
    for n in names:
        cond = cond & _col(attributes)[n].isNotNull()
    return cond


def require_attrs(records: DataFrame, names, attributes: str = "attributes") -> tuple[DataFrame, DataFrame]:
    """split records into (ok, failed). Failed ones keep their content and attributes unchanged."""
    ok = has_attrs(attributes, names)
    return records.filter(ok), records.filter(~ok)


def is_full_load(token) -> Column:
    """a null or blank token means a full load (blank rule applied everywhere, deliberately)."""
    return is_blank(token)


def request_token(token) -> Column:
    """The token a page chain is requested with: ``''`` for a full load, else the token itself."""
    return F.when(is_full_load(token), F.lit("")).otherwise(_col(token))


def token_changed(old, new) -> Column:
    """a token is emitted only when it differs from the one the chain was asked with.

    A null new token (last page without a delta link) is never emitted.
    """
    return _col(new).isNotNull() & ~_col(new).eqNullSafe(_col(old))


def valid_json(text) -> Column:
    """the option validator: blank, or holding an expression (``${...}``, checked again once
    rendered), or parsing as JSON."""
    t = _col(text)
    return (is_blank(t) | t.contains("${")
            | F.try_parse_json(t).isNotNull())


def json_kind(text) -> Column:
    """``OBJECT``, ``ARRAY``, a scalar type name, or null when the text does not parse."""
    v = F.try_parse_json(_col(text))
    s = F.schema_of_variant(v)
    return F.when(v.isNull(), F.lit(None)).otherwise(F.regexp_extract(s, r"^([A-Z]+)", 1))


def valid_method(method) -> Column:
    """F6 part: the method, compared without case, is one of the five allowed ones."""
    return F.upper(_col(method)).isin(*C.REQUEST_METHODS)


def valid_request(method, url, body) -> Column:
    """method allowed, URL not empty, and POST/PUT/PATCH carry a JSON-object body."""
    m = F.upper(_col(method))
    needs_body = m.isin(*C.REQUEST_METHODS_WITH_BODY)
    body_ok = F.coalesce(json_kind(body) == "OBJECT", F.lit(False))
    return (F.coalesce(valid_method(method), F.lit(False))
            & F.coalesce(F.length(_col(url)) > 0, F.lit(False))
            & (~needs_body | body_ok))

"""Projections and row functions (P1, P4, P5, P8-P12, P14, U1) as Column expressions."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync import schemas as S
from mailsync.functions.checks import is_blank


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_list(fields: str | None) -> list[str]:
    """A comma-separated field list; blank means all fields (empty list)."""
    if fields is None or not fields.strip():
        return []
    return [f.strip() for f in fields.split(",") if f.strip()]


def select_fields(df: DataFrame, fields: str | None) -> DataFrame:
    """Keep the listed top-level fields of a typed view; a blank list keeps all of them."""
    names = field_list(fields)
    if not names:
        return df
    return df.select(*[F.col(f"`{n}`") for n in names])


def ddl_subset(ddl: str, fields: str | None) -> str:
    """The part of an entity DDL naming only the listed fields (for pruned ``from_json``).

    The list is free text: a field that the DDL does not know is kept as its raw JSON text."""
    names = field_list(fields)
    if not names:
        return ddl
    parts = {p.strip().split(" ", 1)[0].strip("`"): p for p in _split_top_level(ddl)}
    known = [p for name, p in parts.items() if name in names]
    return ", ".join(known + [f"`{n}` STRING" for n in dict.fromkeys(names) if n not in parts])


def select_json_fields(content, ddl: str, fields: str | None) -> Column:
    """P1 on raw item JSON: the item re-written with only the listed top-level fields.

    Fields of the DDL come typed; any other asked-for field keeps its raw JSON value. A field that
    the item lacks is left out."""
    names = field_list(fields)
    if not names:
        return F.to_json(F.from_json(_col(content), ddl, S.JSON_TS_OPTIONS), S.JSON_TS_OPTIONS)
    known = {p.strip().split(" ", 1)[0].strip("`") for p in _split_top_level(ddl)}
    other = [n for n in dict.fromkeys(names) if n not in known]
    typed = ", ".join(p for p in _split_top_level(ddl) if p.strip().split(" ", 1)[0].strip("`") in names)
    out = F.to_json(F.from_json(_col(content), typed, S.JSON_TS_OPTIONS), S.JSON_TS_OPTIONS) if typed else F.lit("{}")
    if not other:
        return out
    value = F.try_variant_get(F.try_parse_json(_col(content)), "$", "map<string,variant>")
    raw = [F.concat(F.lit(json.dumps(n) + ":"), F.to_json(F.try_element_at(value, F.lit(n)))) for n in other]
    more = F.array_join(F.filter(F.array(*raw), lambda x: x.isNotNull()), ",")
    inner = F.substring(out, 2, F.length(out) - 2)
    return F.when(out.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", F.nullif(inner, F.lit("")), F.nullif(more, F.lit(""))), F.lit("}")))


def _split_top_level(ddl: str) -> list[str]:
    out, depth, cur = [], 0, []
    for ch in ddl:
        if ch == "<":
            depth += 1
        elif ch == ">":
            depth -= 1
        if ch == "," and depth == 0:
            out.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
    if cur:
        out.append("".join(cur))
    return [p.strip() for p in out if p.strip()]


def inherit(parent_attrs, extra) -> Column:
    """Child attributes = parent attributes overlaid by the new ones (new wins).

    Common case first: when the key sets do not overlap, a plain ``map_concat`` (code-generated).
    Otherwise one ``map_zip_with`` over both maps, so each side is evaluated once (a lambda over
    the parent that looked keys up in the new map would re-evaluate the new map per entry)."""
    a, b = _col(parent_attrs), _col(extra)
    disjoint = ~F.arrays_overlap(F.map_keys(a), F.map_keys(b))
    return F.when(disjoint, F.map_concat(a, b)).otherwise(
        F.map_zip_with(a, b, lambda k, old, new: F.coalesce(new, old)))


def attrs(**named) -> Column:
    """A ``MAP<STRING,STRING>`` from keyword pairs; null values are left out."""
    return attrs_of(named)


def attrs_of(mapping: dict) -> Column:
    """Same as :func:`attrs` for names that are not Python identifiers.

    Rows whose values are all present take a plain (code-generated) ``create_map``; only rows with
    a missing value go through the filtering form."""
    vals = {k: _col(v).cast("string") for k, v in mapping.items()}
    all_present = F.lit(True)
    for v in vals.values():
        all_present = all_present & v.isNotNull()
    flat = []
    for k, v in vals.items():
        flat += [F.lit(k), v]
    pairs = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in vals.items()]
    filtered = F.map_from_entries(F.filter(F.array(*pairs), lambda e: e["value"].isNotNull()))
    return F.when(all_present, F.create_map(*flat)).otherwise(filtered)


def attachment_attrs(content_type, name) -> Column:
    """P5: ``content-type`` and ``mime.type`` (same value) and ``attachment_file_name``."""
    return attrs_of({C.ATTR_CONTENT_TYPE: content_type, C.ATTR_MIME_TYPE: content_type,
                     C.ATTR_ATTACHMENT_FILE_NAME: name})


_PLACEHOLDER = re.compile(r"\$\{([^{}]+)\}")
_PLAIN_NAME = re.compile(r"[^\s:()'\"]+")


def template_parts(template: str | None) -> list[tuple[str, str]]:
    """Split a template on the driver into ("lit", text) / ("attr", name) parts."""
    if template is None:
        return []
    parts, pos = [], 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(("lit", template[pos:m.start()]))
        name = m.group(1).strip()
        if not _PLAIN_NAME.fullmatch(name):
            raise ValueError(f"only plain attribute names can be substituted, not ${{{name}}}")
        parts.append(("attr", name))
        pos = m.end()
    if pos < len(template):
        parts.append(("lit", template[pos:]))
    return parts


def render(template: str | None, attributes="attributes") -> Column:
    """Plain ``${name}`` substitution from the record's attributes, in one pass.

    The template is configuration, so it is split once on the driver; each record then evaluates a
    single ``concat`` of literals and map lookups (a missing attribute renders as ``''``). A null
    template renders as null.
    """
    if template is None:
        return F.lit(None).cast("string")
    parts = template_parts(template)
    if not parts:
        return F.lit("")
    cols = [F.lit(v) if kind == "lit" else F.coalesce(_col(attributes)[v], F.lit(""))
            for kind, v in parts]
    return cols[0] if len(cols) == 1 else F.concat(*cols)


def json_options(text) -> dict[str, Column]:
    """A JSON object of options -> ordered ``MAP<STRING,STRING>`` (key order kept).

    ``ok`` is false when the text is not empty and is not a JSON object whose values are all
    scalars (a nested or null value has no string form). Empty or null text gives no options.
    """
    t = _col(text)
    empty = t.isNull() | (t == "")
    m = F.from_json(t, "map<string,string>")
    kinds = _kinds_of(t)
    scalars = F.forall(kinds, lambda k: ~(k.startswith("OBJECT") | k.startswith("ARRAY") | (k == "VOID")))
    ok = empty | (F.coalesce(scalars, F.lit(False)) & m.isNotNull())
    return {"options": F.when(empty, F.create_map().cast("map<string,string>")).otherwise(m), "ok": ok}


def _kinds_of(t: Column) -> Column:
    mv = F.try_variant_get(F.try_parse_json(t), "$", "map<string,variant>")
    return F.transform(F.map_values(mv), lambda v: F.schema_of_variant(v))


def recipients(csv) -> Column:
    """P10: a comma-separated address list -> ``ARRAY<STRUCT<emailAddress: STRUCT<address>>>``.

    Java rules: null or length <= 3 gives an empty list; split on ``,`` with no trim; trailing empty
    parts are dropped, inner ones kept; a list of only commas is empty.
    """
    s = _col(csv)
    stripped = F.regexp_replace(s, r",+$", "")
    parts = F.split(stripped, ",")
    wrapped = F.transform(parts, lambda x: F.struct(F.struct(x.alias("address")).alias("emailAddress")))
    empty = F.array().cast(S.RECIPIENT_DDL)
    return (F.when(s.isNull() | (F.length(s) <= 3) | (stripped == ""), empty)
            .otherwise(wrapped.cast(S.RECIPIENT_DDL)))


def mail_body(body, content) -> Column:
    """P11 (mail): an empty or null rendered body falls back to the record content."""
    b = _col(body)
    return F.when(b.isNull() | (F.length(b) == 0), _col(content)).otherwise(b)


def request_data(data, content) -> Column:
    """P11 (request): **blank** data falls back to the record content."""
    d = _col(data)
    return F.when(is_blank(d), _col(content)).otherwise(d)


def mail_enums(body_type, importance, save_to_sent) -> dict[str, Column]:
    """Upper-case enums ``HTML/TEXT`` and ``LOW/NORMAL/HIGH``; save-to-sent as a boolean.

    ``save_to_sent`` follows Java ``Boolean.parseBoolean`` on the trimmed text: only ``true`` in any
    case is true, anything else false; a null value cannot be unboxed and fails the record.
    """
    bt = F.upper(_col(body_type))
    imp = F.upper(_col(importance))
    sv = _col(save_to_sent)
    ok = (F.coalesce(bt.isin(*C.MAIL_BODY_TYPES), F.lit(False))
          & F.coalesce(imp.isin(*C.MAIL_IMPORTANCES), F.lit(False))
          & sv.isNotNull())
    return {"body_type": bt, "importance": imp,
            "save_to_sent": F.lower(F.regexp_replace(sv, r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")) == "true", "ok": ok}


def mailbox_path(user) -> Column:
    """``me`` in any case is the caller's own mailbox, else that user's."""
    u = _col(user)
    return F.when(F.lower(u) == "me", F.lit("/me")).otherwise(F.concat(F.lit("/users/"), u))


def with_literals(df: DataFrame, named: dict) -> DataFrame:
    """Extra named attributes evaluated once per batch (dynamic properties)."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in named.items()})

"""Nested records that arrive as JSON text: lenient parsing and clean-up into typed structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import str_list
from .text import safe_cell

def parse_variant(c: Column) -> Column:
    """JSON of unknown shape as VARIANT; text that is none as null."""
    return F.try_parse_json(c)


#: Parts of a Python literal: quoted texts, what is between them, and a quote that is never closed.
_PARTS = r"""("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|[^'"]+|.)"""


def pythonic_to_json(c: Column) -> Column:
    """A Python literal (either quotes, None, True, False, lists and dicts) as JSON text; words inside texts stay."""

    def part(p: Column) -> Column:
        inner = F.substring(p, F.lit(2), F.length(p) - 2)
        quoted = F.concat(F.lit('"'), F.replace(F.replace(inner, F.lit("\\'"), F.lit("'")), F.lit('"'), F.lit('\\"')), F.lit('"'))
        bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(p, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
        return F.when(p.startswith("'") & (F.length(p) > 1), quoted).when(p.startswith('"'), p).otherwise(bare)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PARTS), F.lit(1)), part), "")


def parse_struct(c: Column, schema: str) -> Column:
    """JSON or Python-literal text by schema; null if it is neither."""
    literal = pythonic_to_json(c)
    return F.coalesce(F.when(parse_variant(c).isNotNull(), F.from_json(c, schema)), F.when(parse_variant(literal).isNotNull(), F.from_json(literal, schema)))


def group_of(c: Column) -> Column:
    """The group of `{rank, group}` text; the words nan, none and null are none."""
    return F.nullif(safe_cell(F.coalesce(F.get_json_object(c, "$.group"), F.get_json_object(pythonic_to_json(c), "$.group"))), F.lit(""))


#: Fields of a performed company or project: what it is called here, and the names it may have in a source, the first first.
CONDUCT_FIELDS = {
    "company": {"name": ("company_name",), "region": ("region",), "keywords": ("company_keyword",), "purposes": ("company_purpose_list",), "patents": ("company_patent",), "papers": ()},
    "project": {"name": ("project_name", "과제명"), "region": (), "keywords": ("project_keyword", "키워드_project"), "purposes": (), "patents": ("patent",), "papers": ("paper",)},
}
LISTS = ("keywords", "purposes", "patents", "papers")


def conduct_list(c: Column, prefix: str) -> Column:
    """array<struct<id, name, region, keywords, purposes, patents, papers>> from a list, as JSON or Python literal, of
    {<prefix>_id, <prefix>_name, <prefix>_info: {...}}, whichever of their names the fields have.

    A company is called as its record says, a project as its information says, else its record. Texts are trimmed, blank
    list values dropped; entries with neither an id nor any information are left out. Text that is no list gives an empty one.
    """
    fields = CONDUCT_FIELDS[prefix]
    lists = [n for k in LISTS for n in fields[k]]
    named = [n for k in ("name", "region") for n in fields[k]]
    info = ", ".join([f"`{n}`:string" for n in named] + [f"`{n}`:array<string>" for n in lists])
    record = ", ".join(f"`{n}`:string" for n in (f"{prefix}_id", *fields["name"]))
    schema = f"array<struct<{record},`{prefix}_info`:struct<{info}>>>"
    raw = F.when(c.rlike(r"^\s*\["), parse_struct(c, schema))

    def first(x: Column, names: tuple[str, ...]) -> Column:
        return F.coalesce(*[F.nullif(safe_cell(x[n]), F.lit("")) for n in names], F.lit("")) if names else F.lit("")

    def clean(x: Column) -> Column:
        i = x[f"{prefix}_info"]
        values = lambda k: str_list(F.coalesce(*[F.when(F.size(i[n]) > 0, i[n]) for n in fields[k]], F.array().cast("array<string>"))).alias(k)
        name = first(x, fields["name"])
        name = F.coalesce(F.nullif(first(i, fields["name"]), F.lit("")), name) if prefix == "project" else name
        return F.struct(safe_cell(x[f"{prefix}_id"]).alias("id"), name.alias("name"), first(i, fields["region"]).alias("region"), *map(values, LISTS))

    some = lambda x: (F.concat(x["id"], x["name"], x["region"]) != "") | (F.size(x["keywords"]) + F.size(x["purposes"]) + F.size(x["patents"]) + F.size(x["papers"]) > 0)
    return F.filter(F.transform(F.coalesce(raw, F.array().cast(schema)), clean), some)


def without_field(a: Column, field: str) -> Column:
    """An array of structs without one field (an embedding, before it is shown)."""
    return F.transform(a, lambda x: x.dropFields(field))

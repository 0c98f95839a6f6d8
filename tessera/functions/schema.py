"""JSON Schema compiled to a column: the first error of a document held as a variant, in the order of the schema's keywords."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keywords that are compiled; others are refused, so that nothing passes unchecked.
KEYWORDS = ("type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern", "minItems", "maxItems", "uniqueItems", "items", "required", "additionalProperties", "properties")
#: Words that say nothing about a document's validity.
SILENT = ("$schema", "$id", "title", "description", "default", "examples", "$comment")


def kind(value: Column) -> Column:
    """The JSON type of a variant: null for a missing one."""
    said = F.schema_of_variant(value)
    number = said.rlike("^(BIGINT|INT|SMALLINT|TINYINT)$") | said.rlike(r"^DECIMAL\(\d+,0\)$")
    return F.when(said == "VOID", "null").when(said.startswith("OBJECT"), "object").when(said.startswith("ARRAY"), "array").when(said == "STRING", "string").when(said == "BOOLEAN", "boolean").when(number, "integer").when(said.isNotNull(), "number")


def _as(value: Column, of: str) -> Column:
    return F.try_variant_get(value, "$", of)


def first_error(document: Column, schema: dict | bool, at: str = "$") -> Column:
    """Path and keyword of the first error, null for a valid document. Paths of array items end in []."""
    errors = [F.when(bad, F.lit(f"{at}: {word}")) if isinstance(bad, Column) else bad[0] for word, bad in _checks(document, schema, at)]
    return F.coalesce(*errors) if errors else F.lit(None).cast("string")


def _checks(value: Column, schema: dict | bool, at: str) -> list:
    """(keyword, condition) or (keyword, [column with an error of a deeper place]) in order."""
    if isinstance(schema, bool):
        return [] if schema else [("false", F.lit(True))]
    if unknown := [k for k in schema if k not in (*KEYWORDS, *SILENT)]:
        raise ValueError(f"{at}: keywords that aren't compiled: {', '.join(sorted(unknown))}")
    is_ = kind(value)
    text, number, items = _as(value, "string"), _as(value, "double"), _as(value, "array<variant>")
    a_text, a_number, an_array, an_object = is_ == "string", is_.isin("integer", "number"), is_ == "array", is_ == "object"
    integral = is_.eqNullSafe(F.lit("integer")) | (a_number & (number == F.floor(number)))
    names = F.map_keys(_as(value, "map<string,variant>"))
    out: list = []
    for word in KEYWORDS:
        if word not in schema:
            continue
        want = schema[word]
        if word == "type":
            fits = F.lit(False)
            for t in [want] if isinstance(want, str) else want:
                fits = fits | (a_number if t == "number" else integral if t == "integer" else is_ == t)
            out.append((word, ~F.coalesce(fits, F.lit(False))))
        elif word in ("enum", "const"):
            out.append((word, ~_one_of(is_, value, want if word == "enum" else [want])))
        elif word == "minimum":
            out.append((word, a_number & (number < want)))
        elif word == "maximum":
            out.append((word, a_number & (number > want)))
        elif word == "exclusiveMinimum":
            out.append((word, a_number & (number <= want)))
        elif word == "exclusiveMaximum":
            out.append((word, a_number & (number >= want)))
        elif word == "minLength":
            out.append((word, a_text & (F.char_length(text) < want)))
        elif word == "maxLength":
            out.append((word, a_text & (F.char_length(text) > want)))
        elif word == "pattern":
            out.append((word, a_text & ~text.rlike(want)))
        elif word == "minItems":
            out.append((word, an_array & (F.size(items) < want)))
        elif word == "maxItems":
            out.append((word, an_array & (F.size(items) > want)))
        elif word == "uniqueItems" and want:
            said = F.transform(items, lambda x: F.to_json(x))
            out.append((word, an_array & (F.size(F.array_distinct(said)) < F.size(items))))
        elif word == "items":
            found = F.filter(F.transform(items, lambda x: first_error(x, want, f"{at}[]")), lambda e: e.isNotNull())
            out.append((word, [F.when(an_array, F.get(found, 0))]))
        elif word == "required":
            for name in want:
                out.append((f"required {name}", an_object & ~F.array_contains(names, name)))
        elif word == "additionalProperties" and want is False:
            known = F.array(*map(F.lit, schema.get("properties", {}))) if schema.get("properties") else F.array().cast("array<string>")
            out.append((word, an_object & (F.size(F.array_except(names, known)) > 0)))
        elif word == "properties":
            for name, inner in want.items():
                part = F.element_at(_as(value, "map<string,variant>"), name)
                out.append((word, [F.when(an_object & F.array_contains(names, name), first_error(part, inner, f"{at}.{name}"))]))
    return out


def _one_of(is_: Column, value: Column, allowed: list) -> Column:
    found = F.lit(False)
    for v in allowed:
        if v is None:
            same = is_ == "null"
        elif isinstance(v, bool):
            same = (is_ == "boolean") & (_as(value, "boolean") == v)
        elif isinstance(v, (int, float)):
            same = is_.isin("integer", "number") & (_as(value, "double") == float(v))
        elif isinstance(v, str):
            same = (is_ == "string") & (_as(value, "string") == v)
        else:
            raise ValueError("only scalars are compiled in enum and const")
        found = found | F.coalesce(same, F.lit(False))
    return found

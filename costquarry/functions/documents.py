"""JSON documents as VARIANT values: read once, merged by fields, and one text and digest for equal documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costquarry.functions.scalars import valid_json

FIELDS = "map<string, variant>"


def document(text: Column) -> Column:
    """The VARIANT of one whole JSON value; null for broken text, text behind the value, and an object that names a field twice."""
    return F.when(valid_json(text), F.try_parse_json(text))


def fields(doc: Column) -> Column:
    """The fields of a document by name; null if it is no object."""
    return F.try_variant_get(doc, "$", FIELDS)


def merged(doc: Column, other: Column) -> Column:
    """Both documents' fields, those of `other` where both have one; nested objects are replaced, not merged. Null if one is no object."""
    a, b = fields(doc), fields(other)
    kept = F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k))
    return F.to_variant_object(F.map_concat(kept, b))


def with_fields(doc: Column, **values: Column) -> Column:
    """A document with further fields, which replace those of their names; a null value is a JSON null."""
    return merged(doc, F.to_variant_object(F.struct(*(v.alias(k) for k, v in values.items()))))


def without_fields(doc: Column, *names: str) -> Column:
    return F.to_variant_object(F.map_filter(fields(doc), lambda k, _: ~k.isin(*names)))


def canonical(doc: Column) -> Column:
    """A document as text: fields sorted by name at every depth, no spaces, letters as they are, decimals without trailing zeros.

    Numbers with an exponent are doubles and keep a point, so 1e3 (1000.0) is another text than 1000.
    """
    return F.to_json(doc)


def digest(doc: Column) -> Column:
    """SHA-256 of the canonical text, the same for documents that differ in spaces and order of fields only."""
    return F.sha2(canonical(doc), 256)

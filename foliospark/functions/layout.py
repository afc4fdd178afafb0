"""Column functions on layout elements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark import constants as K


def element_type(raw_type: Column) -> Column:
    """Known types pass through; missing or foreign ones become ``unknown``."""
    return F.when(raw_type.isin(*K.ELEMENT_TYPES), raw_type).otherwise(K.UNKNOWN_TYPE)


def element_text(kind: Column, text: Column, table_body: Column) -> Column:
    """The text, or for tables the table body in its place."""
    return F.coalesce(F.when(kind == K.TABLE_TYPE, table_body).otherwise(text), F.lit(""))


def metadata(**columns: Column) -> Column:
    """Map of the metadata keys that are present."""
    entries = F.map_from_arrays(
        F.array(*[F.lit(k) for k in K.METADATA_KEYS]),
        F.array(*[columns[k].cast("string") for k in K.METADATA_KEYS]),
    )
    return F.map_filter(entries, lambda _, value: value.isNotNull())


def is_translatable(kind: Column | str = "element_type") -> Column:
    kind = F.col(kind) if isinstance(kind, str) else kind
    return kind.isin(*K.TRANSLATABLE_TYPES)

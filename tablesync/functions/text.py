"""Name templates such as ``{{catalog_name}}`` resolved per row."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholders understood in settings strings.
PLACEHOLDERS = (
    "catalog_name",
    "schema_name",
    "table_name",
    "source_name",
    "target_name",
)


def substitute(template: Column, values: Mapping[str, Column]) -> Column:
    """Replace every ``{{name}}`` in ``template`` by the column ``values[name]``.

    Placeholders without a value stay as they are.
    """
    out = template
    for name in PLACEHOLDERS:
        if name in values:
            out = F.replace(out, F.lit("{{" + name + "}}"), F.coalesce(values[name].cast("string"), F.lit("")))
    return out

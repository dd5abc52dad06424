from tablesync.functions.columns import (  # noqa: F401
    comparable,
    evidence_map,
    map_as_text,
    original,
)
from tablesync.functions.urls import remap_url, replace_url  # noqa: F401
from tablesync.functions.text import substitute  # noqa: F401

"""Storage-URL rewriting as Column expressions.

A mapping is an ordered list of ``(source_prefix, target_prefix)`` pairs.
Small mappings are folded into one ``CASE`` expression (no join); large
mapping tables go through :func:`tablesync.operators.metadata.remap_url_table`.
"""

from __future__ import annotations

from typing import Optional, Sequence, Tuple

from pyspark.sql import Column
from pyspark.sql import functions as F

Mapping = Sequence[Tuple[str, str]]


def _norm(prefix: str) -> str:
    return prefix if prefix.endswith("/") else prefix + "/"


def remap_url(url: Column, mapping: Mapping) -> Column:
    """Map ``url`` to the target of the longest matching source prefix.

    Matching ignores case and only happens on a ``/`` boundary, so
    ``s3://bucketX/y`` does not match ``s3://bucket/``.  The tail after the
    prefix is kept; a URL equal to the prefix without its slash maps to the
    target as given.  No match gives null.
    """
    lower = F.lower(url)
    ordered = sorted(mapping, key=lambda kv: len(kv[0].rstrip("/")), reverse=True)
    expr = F.lit(None).cast("string")
    # build from the shortest up so the longest prefix is tested first
    for src, tgt in reversed(ordered):
        s = _norm(src).lower()
        bare = s.rstrip("/")
        tail = F.substr(url, F.lit(len(s) + 1))
        hit = lower.startswith(s)
        exact = lower == F.lit(bare)
        mapped = F.when(hit, F.concat(F.lit(_norm(tgt)), tail)).when(exact, F.lit(tgt))
        expr = F.when(hit | exact, mapped).otherwise(expr)
    return expr


def remapped(url: str, mapping: Mapping) -> Optional[str]:
    """:func:`remap_url` of one known URL, without a Spark job."""
    for src, tgt in sorted(mapping, key=lambda kv: len(kv[0].rstrip("/")), reverse=True):
        s = _norm(src)
        if url.lower().startswith(s.lower()):
            return _norm(tgt) + url[len(s):]
        if url.lower() == s.rstrip("/").lower():
            return tgt
    return None


def replace_url(text: Column, mapping: Mapping, first_only: bool = True) -> Column:
    """Replace source URLs inside free text by their targets, ignoring case.

    ``first_only``: stop after the first mapping (in the given order) that
    occurs in the text; otherwise apply every mapping in order.
    """
    out = text
    if first_only:
        expr = text
        for src, tgt in reversed(list(mapping)):
            s = src.rstrip("/")
            pat = "(?i)" + _quote(s)
            expr = F.when(F.lower(text).contains(s.lower()), F.regexp_replace(text, pat, _repl(tgt.rstrip("/")))).otherwise(expr)
        return expr
    for src, tgt in mapping:
        s = src.rstrip("/")
        out = F.regexp_replace(out, "(?i)" + _quote(s), _repl(tgt.rstrip("/")))
    return out


def _quote(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _repl(s: str) -> str:
    # Java replacement string: escape backslash and dollar
    return s.replace("\\", "\\\\").replace("$", "\\$")

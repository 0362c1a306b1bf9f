"""String column functions: tokenizing, HTML stripping, slugs, sort keys.

All are built-in Spark expressions (JVM side, whole-stage codegen); the same
patterns run unchanged in DuckDB, which is what the oracle SQL relies on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a maximal run of letters or digits (Unicode classes).
TOKEN_PATTERN = r"[\p{L}\p{N}]+"

# The HTML entities decoded after tag stripping, in this order.
HTML_ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
]

# Accent folding for sortable keys (lower + ASCII fold).
FOLD_FROM = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
FOLD_TO = "aaaaaaceeeeiiiinooooouuuuyy"


def tokens(col: Column | str) -> Column:
    """``plain`` analyzer: lower-case, split into letter/digit runs."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)


def strip_html(col: Column | str) -> Column:
    """Plain text of an HTML string (DOC-12).

    Drops script/style blocks and comments, replaces tags by a space, decodes
    the common entities and collapses whitespace.
    """
    c = F.col(col) if isinstance(col, str) else col
    c = F.regexp_replace(c, r"(?is)<script[^>]*>.*?</script>", " ")
    c = F.regexp_replace(c, r"(?is)<style[^>]*>.*?</style>", " ")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    c = F.regexp_replace(c, r"<[^>]*>", " ")
    for ent, rep in HTML_ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(rep))
    c = F.regexp_replace(c, r"[ \t\n\r]+", " ")
    return F.trim(c)


def html_title(col: Column | str) -> Column:
    """Text inside the first <title> element, entities decoded."""
    c = F.col(col) if isinstance(col, str) else col
    t = F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1)
    for ent, rep in HTML_ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(rep))
    return F.trim(t)


def slug(col: Column | str) -> Column:
    """Sanitized slug: lower-case, runs of other characters become one '-'."""
    c = F.col(col) if isinstance(col, str) else col
    s = F.regexp_replace(F.lower(F.translate(F.lower(c), FOLD_FROM, FOLD_TO)), r"[^a-z0-9]+", "-")
    return F.regexp_replace(s, r"^-+|-+$", "")


def slug_py(value: str) -> str:
    """Python twin of :func:`slug` for argument normalization on the driver."""
    import re

    v = value.lower().translate(str.maketrans(FOLD_FROM, FOLD_TO))
    v = re.sub(r"[^a-z0-9]+", "-", v)
    return v.strip("-")


def sortable(col: Column | str) -> Column:
    """``.sortable`` key: lower-case and ASCII-folded, whole values of any length."""
    c = F.col(col) if isinstance(col, str) else col
    return F.translate(F.lower(c), FOLD_FROM, FOLD_TO)


def first_line(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.substring_index(c, "\n", 1))


def token_phrase_like(col: Column, phrase: str) -> Column:
    """Token phrase match (meta LIKE): the phrase tokens occur contiguously."""
    q = " ".join(_py_tokens(phrase))
    if not q:
        return F.lit(False)
    joined = F.concat(F.lit(" "), F.array_join(tokens(col), " "), F.lit(" "))
    return F.instr(joined, f" {q} ") > 0


def _py_tokens(text: str) -> list[str]:
    import regex

    return regex.findall(r"[\p{L}\p{N}]+", text.lower())


py_tokens = _py_tokens

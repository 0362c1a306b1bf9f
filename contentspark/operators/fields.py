"""Search field selection (TXT-8, TXT-18, SCR-3) for post-like tables.

Field names follow the document paths: ``post_title``, ``post_excerpt``,
``post_content``, ``author_name``, ``terms.<taxonomy>.name``,
``meta.<key>.value``, ``attachments.attachment.content``. Multi-valued paths
are joined with spaces into one text per (document, field).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.operators.analysis import unpivot_fields

# Default searched fields.
DEFAULT_FIELDS = ["post_title", "post_excerpt", "post_content"]
# Default weights (title, content, excerpt, author name 1; tag and category names 1).
DEFAULT_WEIGHTS = {"post_title": 1.0, "post_content": 1.0, "post_excerpt": 1.0, "author_name": 1.0,
                   "terms.post_tag.name": 1.0, "terms.category.name": 1.0}


def field_column(path: str) -> Column:
    """Text column for one field path."""
    if path.startswith("terms.") and path.endswith(".name"):
        tax = path[len("terms."):-len(".name")]
        return F.array_join(F.transform(F.col("terms")[tax], lambda t: t["name"]), " ")
    if path.startswith("meta.") and path.endswith(".value"):
        key = path[len("meta."):-len(".value")]
        return F.array_join(F.transform(F.col("meta")[key], lambda x: x["value"]), " ")
    return F.col(path)


def resolve_fields(search_fields=None, taxonomies: list[str] | None = None, meta: list[str] | None = None,
                   author_name: bool = False) -> list[str]:
    """TXT-8: the default fields plus taxonomy names, meta values and the author name when asked."""
    fields = list(search_fields or DEFAULT_FIELDS)
    fields += [f"terms.{t}.name" for t in (taxonomies or [])]
    fields += [f"meta.{k}.value" for k in (meta or [])]
    if author_name:
        fields.append("author_name")
    return fields


def field_rows(posts: DataFrame, fields: list[str], extra: list[str] | None = None,
               attachments: DataFrame | None = None) -> DataFrame:
    """(doc_id, field, text[, extra]) rows for the selected fields of ``posts``.

    TXT-18: ``attachments`` (doc_id, content) adds ``attachments.attachment.content`` rows.
    """
    rows = unpivot_fields(posts, "id", {f: field_column(f) for f in fields}, extra=extra)
    rows = rows.filter(F.col("text") != "")
    if attachments is not None:
        att = attachments.select(F.col("doc_id"), *[F.col(c) for c in (extra or [])],
                                 F.lit("attachments.attachment.content").alias("field"), F.col("content").alias("text"))
        rows = rows.unionByName(att)
    return rows


def searchable_types(weights: DataFrame) -> DataFrame:
    """SCR-6: post types with at least one enabled field (others are excluded from search)."""
    return weights.filter(F.col("enabled")).select("post_type").distinct()


def decay_enabled(mode: str, post_types: list[str] | None) -> bool:
    """SCR-8: decay switch: 'off'; 'off_products' (off when only products are searched);
    'off_with_products' (off whenever products are included); anything else on."""
    types = set(post_types or [])
    if mode == "off":
        return False
    if mode == "off_products" and types == {"product"}:
        return False
    if mode == "off_with_products" and "product" in types:
        return False
    return True


# Fields whose presence turns fuzziness off (id searches are exact).
ID_FIELDS = ["ID", "post_id", "post_parent"]


def effective_fuzziness(fields: list[str], fuzziness):
    """FLT-13: searching an id field removes fuzziness from every clause."""
    return 0 if set(fields) & set(ID_FIELDS) else fuzziness


def fuzzy_clause_weights(weight_rows, post_type: str) -> dict[str, float]:
    """SCR-5: {field: weight} of the enabled, fuzzy fields of a type (weight 0 -> 1).

    ``weight_rows`` is the weighting configuration as (post_type, field,
    enabled, weight, fuzzy) tuples - a settings list, not data.
    """
    return {f: float(w or 1) for t, f, enabled, w, fz in weight_rows if t == post_type and enabled and fz}


def type_weights(weight_rows, post_type: str) -> dict[str, float]:
    """SCR-1/2: {field: weight} of the enabled fields of a type (weight 0 -> 1)."""
    return {f: float(w or 1) for t, f, enabled, w, fz in weight_rows if t == post_type and enabled}

"""contentspark: content search and analytics as Spark jobs.

Build denormalized documents from relational content tables, filter them with
nested taxonomy / meta / date conditions, rank them in bulk (a table of queries
against a table of documents), count facets, walk hierarchies, suggest and
correct, keep derived tables in step with a change stream, and report.
"""

from contentspark.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]

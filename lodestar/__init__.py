"""lodestar: a Spark-native listing pipeline.

Stored pages become listings through link discovery, content selection,
validated extraction, order-faithful de-duplication and a keyed upsert; the
stored listings feed ranked picks, rendered messages, digests, run reports,
data-quality checks, text search and row-visibility views.  Every step is a
DataFrame plan; Arrow-batched Python runs only where no built-in expression
exists (HTML parsing, URL resolution, the LCS kernel of the fuzzy score).
"""

from lodestar.session import get_session, checkpoint_dir  # noqa: F401

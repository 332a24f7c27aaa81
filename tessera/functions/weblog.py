"""Access-log column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the original job's for identical page keys):
# the request-tracing parameter appended by the web front end, a lower-case
# hex GUID, which is stripped from the query string before grouping.
LOG_ID_PATTERN = "X-ARR-LOGID=[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"


def strip_log_id(query: Column | str) -> Column:
    q = F.col(query) if isinstance(query, str) else query
    return F.regexp_replace(q, LOG_ID_PATTERN, "")


def page_key(stem: Column | str = "cs_uristem", query: Column | str = "cs_uriquery") -> Column:
    """``stem?query`` without the tracing id; a null query leaves the stem."""
    s = F.col(stem) if isinstance(stem, str) else stem
    return F.concat_ws("?", s, strip_log_id(query))

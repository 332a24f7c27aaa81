"""tessera — reusable, parameterised PySpark DataFrame operators for everyday
analytics jobs: activity ranking with a breakdown, web access log summaries,
sensor banding and enrichment, free-text n-gram mining and lexicon sentiment.

Every public function takes DataFrames (and plain parameters) and returns a
lazy DataFrame.  Nothing is collected to the driver; Catalyst plans the work.
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming", "adapters", "session"]

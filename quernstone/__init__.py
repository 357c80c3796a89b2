"""An analytics engine for wiki-style knowledge bases on Spark."""

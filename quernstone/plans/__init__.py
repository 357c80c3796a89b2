"""Whole jobs: the test corpus, the crawl, the incremental update."""

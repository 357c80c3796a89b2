"""DataFrame operators of the knowledge-base engine."""

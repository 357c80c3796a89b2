"""Column functions: text, wiki markup, front matter."""

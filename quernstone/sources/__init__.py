"""Sources and sinks: listings, the wiki API, Markdown files, images."""

"""Column-level helpers: dates, cut-date resolution and text extraction."""

"""DataFrame-to-DataFrame operators of the Silver, Gold, quality and audit steps."""

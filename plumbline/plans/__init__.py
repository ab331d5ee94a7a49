"""Composite plans: the build job, serving queries, measures and narration."""

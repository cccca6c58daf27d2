"""Composed plans: cleaning, catalogs, the analysis pipeline, reports, registered queries."""

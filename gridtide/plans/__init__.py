"""Named views and reports over the analysis tables, and the rebuild of those tables."""

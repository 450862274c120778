"""Content-curation analytics on Spark: feeds and pages in, marts, notes and newsletters out."""

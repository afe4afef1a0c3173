"""End-to-end jobs: curation, dimensions, facts and the full load."""

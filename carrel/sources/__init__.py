"""Reading and writing: MARC, files, HTML and stage tables."""

"""jobgrain: job-posting, company and salary analytics as plain Spark jobs.

Sub-packages
------------
functions   column expressions (text, location, title, text-encoded lists)
operators   DataFrame-to-DataFrame building blocks (keys, dedup, joins, audits)
sources     landing readers, processed files, tables and their publication
plans       cleaning, raw / normalized / star layers, serving queries, batch job
streaming   incremental landing ingest and incremental insert-if-absent
"""

__version__ = "0.1.0"

"""Parameters that the registered queries share with their SQL statements."""

from __future__ import annotations

EMBED_DIMS = 256
# Hyperplane buckets: tables of so many planes each.
LSH_TABLES, LSH_BITS = 64, 6
# Approximate searches ask for the neighbours of every row whose id this divides.
ASKED_EVERY = 20
# Folders that the orders are written to as files: their number does not grow with the orders.
CASE_FOLDERS = 16
# Texts of each language that the n-gram model counts.
LANGUAGE_SAMPLE = 50

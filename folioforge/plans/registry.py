"""Registered queries and their SQL."""

from __future__ import annotations

from folioforge.plans import alignments, documents, files, pages, sequences, tables

QUERIES: dict = {**documents.QUERIES, **tables.QUERIES, **sequences.QUERIES, **files.QUERIES, **pages.QUERIES, **alignments.QUERIES}
SQL: dict = {**documents.SQL, **tables.SQL, **files.SQL, **pages.SQL, **alignments.SQL}

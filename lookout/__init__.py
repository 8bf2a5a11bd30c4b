"""lookout -- document search and faceted ranking on Spark.

Public entry points (all ``DataFrame -> DataFrame``):

* :class:`lookout.index.SearchIndex` -- write-once postings, stems, idf,
  weighted index and vocabulary of a corpus, with ``conjunctive``,
  ``ranked`` and ``two_stage`` searches over query batches.
* :mod:`lookout.functions.text` -- the text normaliser and field cleaners
  as column expressions.
* :mod:`lookout.operators` -- corpus statistics, searches and filters
  (``search``), places (``places``), geography (``geo``), page extraction
  (``extract``), route feasibility (``routes``), stemming (``stemming``).
* :mod:`lookout.sources` -- input tables, place TSV/CSV/text I/O, page
  files, persisted postings.
* :mod:`lookout.streaming` -- incremental ingest of pages and documents.
* :mod:`lookout.session` -- session defaults and the shared checkpoint
  folder.
"""

__version__ = "0.1.0"

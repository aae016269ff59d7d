"""Training-data pipeline operators.

Ten operators over ``documents`` and ``embeddings``; nothing else in the
library imports this subpackage.  ``queries.py`` registers one query per
operator.  Shared conventions:

* a null text counts as an empty text, a null ``doc_id`` sorts last;
* a row is identified by where it lies (file hash, row index), so repeated or
  null ids never merge two rows;
* operators read only the columns they name, so extra columns are ignored.
"""

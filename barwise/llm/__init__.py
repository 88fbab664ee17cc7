"""Training-data operators: cleaning, deduplication, classification, packing.

Each operator module documents its method, its parameters and its results for
nulls, empty and long texts, repeated rows and empty tables.  Inputs are read
by column name (``doc_id``, ``text`` and so on); other columns are ignored, so
their names cannot clash.
"""

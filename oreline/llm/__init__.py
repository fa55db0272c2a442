"""Operators for preparing training text: each works on whole texts, as Spark jobs over all rows."""

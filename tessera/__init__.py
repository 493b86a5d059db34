"""tessera: a PySpark star-schema analytics library.

Raw landed records go to typed, audited tables, then to a star schema (dimensions with
surrogate keys, quartiles and an unknown member; a fact table with checked grain and
foreign keys), then to quality reports and rate / share / ranking / trend / correlation marts.
Every operator is a lazy DataFrame -> DataFrame function with column names as parameters.
"""

__version__ = "0.1.0"

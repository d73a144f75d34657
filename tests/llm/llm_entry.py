"""The registered queries of the text operators."""

import __spark_entry__ as spark_entry

QUERIES = spark_entry.queries()

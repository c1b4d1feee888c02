"""Training-data pipeline operators (PII, language, tokens, quality, mixing,
sequences, near-duplicates, decontamination).  Nothing outside this package
imports it; ``queries.QUERIES`` and ``sql.SQL`` are picked up by
``__spark_entry__.py`` when the package is present."""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with the plan, so that
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""strata — layered (bronze / silver / gold) data pipelines on PySpark.

Every rule is a Column expression, so each job is one Spark plan that
Catalyst optimises and whole-stage codegen compiles; nothing runs row by
row in Python.
"""

__version__ = "0.1.0"

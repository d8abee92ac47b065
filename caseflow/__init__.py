"""caseflow: support-ticket analytics and retrieval as plain Spark jobs.

Every public function takes DataFrames (or a SparkSession plus a path) and
returns DataFrames.  Nothing is collected to the driver except scalars that
a caller explicitly asks for.
"""

__version__ = "0.1.0"

"""spanforge: distributed text mining and entity labelling on Spark DataFrames.

Every public operator takes and returns a ``DataFrame`` (or ``Column``) and is
built from Spark's own column functions, joins and windows, so a whole job is one
lazy plan that Catalyst optimises and the cluster executes.
"""

__version__ = "0.1.0"

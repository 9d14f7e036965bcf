"""martflow: sales file drops to analytical marts, expressed in Spark.

Every public function takes DataFrames (and, where it must read or write,
the SparkSession) and returns lazy DataFrames; nothing is collected to the
driver except bounded control values (a distinct header set, a size check).
"""

__version__ = "0.1.0"

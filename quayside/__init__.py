"""quayside: a Spark-native lakehouse for clickstream, transaction, partner and
payment feeds.

Every public function takes and returns DataFrames (or Columns); nothing pulls
rows through the driver. See README.md for the module map.
"""

__version__ = "0.1.0"

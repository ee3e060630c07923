"""kindred: mining a catalog of items that carry text, label sets and a rank.

Every public function takes and returns Spark DataFrames.  See README.md for
the map from package to operator.
"""

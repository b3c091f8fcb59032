"""Mobile-app advertising analytics as plain PySpark DataFrame functions.

Every public function takes DataFrames (and plain parameters) and returns a lazy
DataFrame. Nothing here collects, caches or changes the session.
"""

__version__ = "0.1.0"

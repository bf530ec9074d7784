"""Table and stream operators for observation data, on Spark DataFrames.

Sub-packages:

* ``functions`` -- column expressions (numbers, bands, text, dates)
* ``sources``   -- file, line and topic readers
* ``operators`` -- DataFrame -> DataFrame steps
* ``streaming`` -- starting, bounding and sinking streaming queries
* ``plans``     -- whole jobs composed of the above
"""

__version__ = "0.1.0"

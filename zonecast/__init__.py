"""zonecast: pitch-outcome analytics as Spark DataFrame operators.

Every operator takes a DataFrame plus column-name parameters and returns a
DataFrame; nothing is collected except small fitted state (medians, category
lists, bin bounds) whose size is bounded by the number of columns.
"""

__version__ = "0.1.0"

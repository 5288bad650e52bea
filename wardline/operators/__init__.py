"""One function per step of the analysis, each from DataFrames to a DataFrame.

How the steps stay even at scale
--------------------------------
* Facts and visits are reduced to one row per patient and day (or less) *before*
  they meet another table, with partial aggregation on the map side.  A patient or
  code that holds a third of all rows then sends a handful of rows per map task.
* Mapping tables and cohorts are joined without hints: the planner broadcasts a side
  only when its known size is under the session's limit, and shuffles otherwise.
* Calendar and length-of-stay counts are differences summed along the calendar, so
  no date is ever paired with every patient.
* The only windows without a partition run over report rows: at most one per calendar
  day, or one per output line.
"""

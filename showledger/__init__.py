"""showledger: a PySpark engine for canonical title/unit catalogs.

Every public operator takes and returns DataFrames (or Columns); nothing is
collected to the driver except plan-time constants whose size is fixed by the
number of partitions or by a caller-supplied parameter list.
"""

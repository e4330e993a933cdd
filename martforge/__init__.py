"""martforge: batch sales / incident / person-record analytics on Spark DataFrames.

Layout
------
functions/  Column -> Column cleaning and parsing helpers (dates, ints, regexes)
sources/    XML, CSV and HTML readers, table sinks (materialize)
operators/  keys (dense ids, first-per-key, look-ups), marts, reports,
            quality checks, upsert, person timelines
plans/      end-to-end loaders that wire sources and operators together
streaming/  foreachBatch adapter for the batch upsert
views       mapping of the shared Parquet test tables onto the logical tables
"""

from martforge.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]

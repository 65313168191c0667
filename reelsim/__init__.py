"""reelsim: content-based catalogue search and recommendation on Spark.

Every operation takes DataFrames and returns DataFrames.  The heavy work
(text cleaning, TF-IDF fit, scoring, ranking, evaluation, profiles) is
declared with the DataFrame API so Catalyst plans it; there are no Python
UDFs on the hot path.
"""

from reelsim.session import get_spark, checkpoint_dir  # noqa: F401

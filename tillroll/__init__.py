"""tillroll: monthly retail monitoring on Spark DataFrames.

Raw transaction lines -> ``clean_lines`` -> month-grain tables (KPIs,
coverage, retention, concentration, cohorts, return drivers, report frames).
Every operator is a lazy ``DataFrame -> DataFrame`` function.
"""

from tillroll.operators import *  # noqa: F401,F403
from tillroll.sources import load_csv, retail_lines, save_table  # noqa: F401

__version__ = "0.1.0"

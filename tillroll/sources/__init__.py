from tillroll.sources.csv import load_csv  # noqa: F401
from tillroll.sources.retail_lines import retail_lines  # noqa: F401
from tillroll.sources.sinks import read_table_back, save_table  # noqa: F401
from tillroll.sources.tables import read_table  # noqa: F401

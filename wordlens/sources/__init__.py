from wordlens.sources.tables import read_table, table_path  # noqa: F401
from wordlens.sources.urls import (  # noqa: F401
    arrivals,
    land,
    line_count,
    url_file,
    url_records,
)

from wordlens.sinks.tables import GrowingTable, TableSink, open_table, read_saved, save_table  # noqa: F401

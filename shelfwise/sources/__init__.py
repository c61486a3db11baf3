from shelfwise.sources.tables import interactions, read_table, table

__all__ = ["interactions", "read_table", "table"]

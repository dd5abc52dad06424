from tablesync.sources.tables import column_facts, load  # noqa: F401

from lumen.sources.tables import (  # noqa: F401
    describe_table,
    file_inventory,
    load_table,
    preview,
    read_csv,
    row_count,
    sanitize_columns,
    save_table,
    scan_table,
    show_tables,
    write_csv,
)

from tessera.sources.readers import (read_csv, read_delimited, read_lines, read_tsv, read_tsv_headerless, read_w3c_by_name,
                                     read_w3c_log, skip_lines)
from tessera.sources.records import read_records, write_records
from tessera.sources.rejects import quarantine, scan_delimited, scan_json
from tessera.sources.schemas import (LEXICON_COLUMNS, LEXICON_SCHEMA, MESSAGE_JSON_SCHEMA, PART_SCHEMA, PRODUCTS_SCHEMA,
                                     WEBLOG_SCHEMA, ZONE_SCHEMA)
from tessera.sources.sinks import write_csv
from tessera.sources.tables import calendar, open_log_table, refresh_days, write_log_table

__all__ = [
    "read_csv", "read_delimited", "read_lines", "read_tsv", "read_tsv_headerless", "read_w3c_log", "skip_lines", "write_csv",
    "read_w3c_by_name", "read_records", "write_records", "quarantine", "scan_delimited", "scan_json", "calendar", "open_log_table",
    "refresh_days", "write_log_table",
    "WEBLOG_SCHEMA", "MESSAGE_JSON_SCHEMA", "PART_SCHEMA", "PRODUCTS_SCHEMA", "LEXICON_COLUMNS", "LEXICON_SCHEMA", "ZONE_SCHEMA",
]

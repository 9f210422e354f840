from profilespark.sources.readers import read_csv_text, read_table
from profilespark.sources.writers import result_json, write_table

__all__ = ["read_csv_text", "read_table", "result_json", "write_table"]

from .files import layer_path, read_table, read_versions, with_source_index, write_table
from .gates import accepted_files, judge_files, quarantine_lines
from .jdbc import read_jdbc, write_jdbc

__all__ = ["layer_path", "read_table", "read_versions", "with_source_index", "write_table", "accepted_files",
           "judge_files", "quarantine_lines", "read_jdbc", "write_jdbc"]

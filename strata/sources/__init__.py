"""Sources: record CSV files (tagged, header-checked) and zip archives of them."""

from strata.sources.records import (
    city_files,
    city_sources,
    discover,
    drop_alias_row,
    file_headers,
    header_rows,
    list_files,
    read_records,
    read_tagged,
    spark_path,
    tag_by_file,
)
from strata.sources.zip_members import read_zip_members, tag_by_member, zip_member_list

__all__ = [
    "city_files", "city_sources", "discover", "drop_alias_row", "file_headers", "header_rows",
    "list_files", "read_records", "read_tagged", "read_zip_members", "spark_path", "tag_by_file",
    "tag_by_member", "zip_member_list",
]

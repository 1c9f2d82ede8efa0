"""Reading and writing of landed pages and segment tables."""

from .pages import read_page_archive, read_page_index, read_raw_pages, save_raw_pages
from .segments import (
    export_subset,
    read_segments_csv,
    read_segments_jsonl,
    read_segments_years,
    write_segments_by_year,
    write_segments_csv,
    write_segments_json,
    write_segments_jsonl,
)

__all__ = [
    "export_subset",
    "read_page_archive",
    "read_page_index",
    "read_raw_pages",
    "read_segments_csv",
    "read_segments_jsonl",
    "read_segments_years",
    "save_raw_pages",
    "write_segments_by_year",
    "write_segments_csv",
    "write_segments_json",
    "write_segments_jsonl",
]

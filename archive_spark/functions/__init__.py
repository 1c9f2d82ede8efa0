"""Column functions; all of them are compositions of built-in expressions."""

from .dates import date_from_url, month_number, parse_flexible_date, year_from_text
from .meta import meta_first, reporters
from .text import (
    concat_text,
    headline_title,
    or_default,
    program_duration,
    py_strip,
    split_title_date,
    time_range,
)
from .urls import host_of, id_from_url, page_file_name, page_slug, resolve_all, resolve_url, url_key

__all__ = [
    "concat_text",
    "date_from_url",
    "headline_title",
    "host_of",
    "id_from_url",
    "meta_first",
    "month_number",
    "or_default",
    "page_file_name",
    "page_slug",
    "parse_flexible_date",
    "program_duration",
    "py_strip",
    "reporters",
    "resolve_all",
    "resolve_url",
    "split_title_date",
    "time_range",
    "url_key",
    "year_from_text",
]

"""Readers: delimited and sectioned text, archives, listing pages, tables."""

from .archives import explode_archives, member_lines, read_archives, route_members
from .delimited import read_delimited, read_delimited_checked
from .ledger import Ledger
from .links import extract_links, new_files, resolve_links
from .sections import read_sectioned, section_lines
from .tables import read_parquet, read_table

__all__ = [
    "Ledger",
    "explode_archives",
    "read_archives",
    "route_members",
    "member_lines",
    "read_delimited",
    "read_delimited_checked",
    "extract_links",
    "new_files",
    "resolve_links",
    "read_sectioned",
    "section_lines",
    "read_parquet",
    "read_table",
]

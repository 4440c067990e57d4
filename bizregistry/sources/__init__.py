from .archives import (
    expand_archives,
    list_archives,
    list_members,
    read_archived_delimited,
    skipped_archives,
)
from .delimited import detect_header, first_records, read_delimited, with_provenance
from .entries import index_members
from .format import register_zip_lines
from .landed import land_archives, landed_files, read_landed, remove_stale
from .links import extract_links, page_links
from .schemas import FAMILIES, Family

__all__ = [
    "FAMILIES",
    "Family",
    "detect_header",
    "expand_archives",
    "extract_links",
    "first_records",
    "index_members",
    "land_archives",
    "landed_files",
    "list_archives",
    "list_members",
    "page_links",
    "read_archived_delimited",
    "read_delimited",
    "read_landed",
    "register_zip_lines",
    "remove_stale",
    "skipped_archives",
    "with_provenance",
]

"""Reading and writing tables."""

from starmart.sources.publish import (
    APPEND,
    PERIODS,
    REPLACE,
    Publication,
    PublishConflictError,
    published_tables,
    read_manifest,
    read_published,
    register_published,
    remove_abandoned,
)
from starmart.sources.readers import (
    literal_table,
    read_by_name,
    read_delimited,
    read_dictionary,
    read_dictionary_lines,
    read_fact,
    read_table,
)
from starmart.sources.writers import (
    refresh_partitions,
    register_views,
    remove_folder,
    subfolders,
    write_table,
)

__all__ = [
    "APPEND",
    "PERIODS",
    "REPLACE",
    "Publication",
    "PublishConflictError",
    "literal_table",
    "published_tables",
    "read_by_name",
    "read_delimited",
    "read_dictionary",
    "read_dictionary_lines",
    "read_fact",
    "read_manifest",
    "read_published",
    "read_table",
    "refresh_partitions",
    "register_published",
    "register_views",
    "remove_abandoned",
    "remove_folder",
    "subfolders",
    "write_table",
]

"""Raw landing: untyped readers, cursor derivation, named sources."""

from ledgerline.sources.raw import (
    RAW_COLUMNS,
    SourceRegistry,
    add_updated_at,
    land,
    raw_schema,
    read_untyped_csv,
)

__all__ = ["RAW_COLUMNS", "SourceRegistry", "add_updated_at", "land", "raw_schema",
           "read_untyped_csv"]

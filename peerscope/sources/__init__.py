"""Sources and sinks: the claim fixture roll-up, raw files, exclusion lists, outputs."""

from peerscope.sources.fixture import exclusions_from_tables, provider_years_raw, providers_raw
from peerscope.sources.files import (
    read_exclusions_csv,
    read_multi_year,
    read_providers_csv,
    read_table,
    profile_source,
    write_json_metrics,
    write_table,
)

__all__ = [
    "exclusions_from_tables",
    "provider_years_raw",
    "providers_raw",
    "read_exclusions_csv",
    "read_multi_year",
    "read_providers_csv",
    "read_table",
    "profile_source",
    "write_json_metrics",
    "write_table",
]

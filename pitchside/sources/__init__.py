from .snapshot import (
    bootstrap_array, conform, json_flatten, parse_json_column, read_bootstrap,
    read_documents, read_fixture_pages, read_history_pages, scan_elements,
    scan_fixtures, scan_gameweeks, scan_history, scan_positions, scan_teams,
)

__all__ = [
    "bootstrap_array", "conform", "json_flatten", "parse_json_column", "read_bootstrap",
    "read_documents", "read_fixture_pages", "read_history_pages", "scan_elements",
    "scan_fixtures", "scan_gameweeks", "scan_history", "scan_positions", "scan_teams",
]

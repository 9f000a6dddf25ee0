"""Sources and sinks: raw RT_FLOW syslog, CSV, parquet stages, fixtures from driver tables."""

from .syslog import read_syslog_lines, parse_lines, parse_syslog, parse_accounting, reject_diagnostics
from .fixtures import flows, render_lines
from .files import read_sessions_csv, write_csv, write_stage, read_stage

__all__ = [
    "read_syslog_lines", "parse_lines", "parse_syslog", "parse_accounting", "reject_diagnostics",
    "flows", "render_lines",
    "read_sessions_csv", "write_csv", "write_stage", "read_stage",
]

"""Column expressions. Every function returns a ``Column`` and stays JVM-side."""

from .net import (ip_to_int, is_private_ip, protocol_name, action_of, is_well_known_port,
                  is_high_port, is_privileged_port)
from .numeric import safe_div, log1p0, as_flag
from .timefn import syslog_timestamp, any_timestamp, is_night

__all__ = [
    "ip_to_int", "is_private_ip", "protocol_name", "action_of", "is_well_known_port",
    "is_high_port", "is_privileged_port", "safe_div", "log1p0", "as_flag",
    "syslog_timestamp", "any_timestamp", "is_night",
]

"""Network column functions: IP arithmetic, RFC 1918 test, protocol / action lookups, port flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import EVENT_ACTIONS, PRIVATE_RANGES, PROTOCOL_NAMES, WELL_KNOWN_PORTS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ip_to_int(ip) -> Column:
    """Dotted quad → a·2^24 + b·2^16 + c·2^8 + d as BIGINT; anything unparsable → 0.

    Octets are not range-checked and parts after the fourth are ignored; fewer than
    four numeric parts gives 0 (same as a failed conversion).
    """
    parts = F.split(_col(ip).cast("string"), r"\.")
    weights = [16777216, 65536, 256, 1]
    terms = [F.get(parts, i).try_cast("bigint") * F.lit(w) for i, w in enumerate(weights)]
    return F.coalesce(reduce(lambda a, b: a + b, terms), F.lit(0).cast("bigint"))


def _quad(ip: str) -> int:
    a, b, c, d = (int(x) for x in ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def is_private_ip(ip) -> Column:
    """1 when the address falls in an RFC 1918 range (bounds inclusive), else 0."""
    v = ip_to_int(ip)
    cond = reduce(lambda a, b: a | b,
                  [v.between(_quad(lo), _quad(hi)) for lo, hi in PRIVATE_RANGES])
    return cond.cast("int")


def protocol_name(protocol_num_text) -> Column:
    """Protocol name for the number as written in the log; unknown numbers stay as text."""
    m = F.create_map(*[F.lit(x) for kv in PROTOCOL_NAMES.items() for x in kv])
    t = _col(protocol_num_text)
    return F.coalesce(F.try_element_at(m, t), t)


def action_of(event_type) -> Column:
    """close / create / deny from the (case-insensitive) event type, else unknown."""
    m = F.create_map(*[F.lit(x) for kv in EVENT_ACTIONS.items() for x in kv])
    return F.coalesce(F.try_element_at(m, F.upper(_col(event_type))), F.lit("unknown"))


def is_well_known_port(port) -> Column:
    return F.coalesce(_col(port).isin(WELL_KNOWN_PORTS).cast("int"), F.lit(0))


def is_high_port(port) -> Column:
    return F.coalesce((_col(port) > 1024).cast("int"), F.lit(0))


def is_privileged_port(port) -> Column:
    return F.coalesce((_col(port) < 1024).cast("int"), F.lit(0))

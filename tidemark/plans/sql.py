"""Pieces of the checking SQL shared by several queries."""

VIEWS = """(SELECT event_id, ts, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS item
    FROM events WHERE event_type = 'view')"""

HOUR = 3600


def bucket(ts: str, size: int, offset: int = 0) -> str:
    """Start of the fixed window of `size` seconds a time lies in."""
    us, off = size * 1_000_000, offset * 1_000_000
    return f"make_timestamp((epoch_us({ts}) - ({off})) // {us} * {us} + ({off}))"


def hops(rows: str, size: int, slide: int, ts: str = "ts") -> str:
    """Every row once per sliding window it lies in, with window_start and window_end."""
    us = slide * 1_000_000
    start = f"(epoch_us(r.{ts}) // {us} * {us} - i * {us})"
    return f"""(SELECT r.*, make_timestamp({start}) AS window_start,
        make_timestamp({start} + {size * 1_000_000}) AS window_end
        FROM {rows} r, range({size // slide}) g(i))"""


def timers(candidates: str, keys: str, limit: str) -> str:
    """A recursive `arms`: the first candidate of a run arms, then the first one past the limit."""
    same = " AND ".join(f"c.{k.strip()} = a.{k.strip()}" for k in keys.split(","))
    named = ", ".join(f"c.{k.strip()}" for k in keys.split(","))
    return f"""arms AS (
        SELECT {keys}, min(ts) AS armed FROM {candidates} GROUP BY {keys}
        UNION ALL
        SELECT {named}, min(c.ts) FROM arms a JOIN {candidates} c
            ON {same} AND c.ts > a.armed + {limit} GROUP BY {named})"""

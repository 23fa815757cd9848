"""Wall clocks of consecutive hours."""

from datetime import datetime, timedelta


def utc_hours(start: str, zone: str, hours: int) -> list[tuple[datetime, datetime]]:
    """(UTC, local) wall clocks of consecutive hours from a local start."""
    import pandas as pd

    local = pd.date_range(pd.Timestamp(start, tz=zone), periods=hours, freq="h")
    return [
        (u.to_pydatetime().replace(tzinfo=None), w.to_pydatetime().replace(tzinfo=None))
        for u, w in zip(local.tz_convert("UTC"), local)
    ]


def hours_from(start: str, count: int, minutes: int = 60) -> list[datetime]:
    first = datetime.fromisoformat(start)
    return [first + timedelta(minutes=minutes * k) for k in range(count)]

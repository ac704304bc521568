"""What tests of panels share; not in conftest.py, since a conftest of a subfolder takes that module name."""

from datetime import datetime, timedelta


def at(hour: float) -> datetime:
    """Local time, ``hour`` hours after the start of 2024."""
    return datetime(2024, 1, 1) + timedelta(hours=hour)

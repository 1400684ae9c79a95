"""Road-sensor stream analytics as plain DataFrame functions."""

from kerbstream.config import JobConfig

__all__ = ["JobConfig"]

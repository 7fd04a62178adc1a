"""Settings kept in a properties file."""

from __future__ import annotations


def load_settings(path: str) -> dict[str, str]:
    """`name=value` lines as a dict; blank lines and comments are skipped."""
    settings = {}
    with open(path, encoding="utf-8") as lines:
        for line in lines:
            line = line.strip()
            if line and line[0] not in "#!":
                name, _, value = line.partition("=")
                settings[name.strip()] = value.strip()
    return settings


def with_prefix(settings: dict[str, str], prefix: str) -> dict[str, str]:
    """The settings under a prefix, without it; e.g. the options of one reader."""
    return {name[len(prefix) :]: value for name, value in settings.items() if name.startswith(prefix)}

"""The bounds every job works under."""

from __future__ import annotations

import dataclasses
import os
from collections.abc import Mapping
from dataclasses import dataclass

_MIB = 1 << 20

# Lowest setting an override may reach, per field of ``Limits``.
_FLOORS = {
    "max_input_bytes": _MIB,
    "max_output_bytes": 64 * 1024,
    "timeout_secs": 10,
    "max_archive_members": 1,
    "max_archive_bytes": _MIB,
    "max_jobs": 4,
    "max_elements": 0,
    "max_element_chars": 64,
    "max_row_bytes": _MIB,
    "max_converter_bytes": 64 * _MIB,
}


@dataclass(frozen=True)
class Limits:
    """Immutable bounds, passed to each operator.

    Bounds that leave a typed error have defaults.  Those that would cut a
    result (``max_output_bytes``, ``max_elements``, ``max_element_chars``) or
    drop finished jobs (``max_jobs``) are off, ``None``, until a job asks for
    them, and what they cut is counted in the result.  The constructor takes any value, so that a job can be run under tighter
    bounds than an operator's environment may ask for; ``from_env`` is the
    guarded way in.
    """

    max_input_bytes: int = 200 * _MIB
    max_output_bytes: int | None = None
    timeout_secs: int = 600
    max_archive_members: int = 512
    max_archive_bytes: int = 512 * _MIB
    max_jobs: int | None = None
    max_elements: int | None = None
    max_element_chars: int | None = None
    max_row_bytes: int = 1024 * _MIB  # of one merged archive; Spark's rows end at 2 GiB
    max_converter_bytes: int | None = 4096 * _MIB  # of data a converter's process may hold

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, prefix: str = "LEAFMILL_") -> "Limits":
        """Defaults, overridden by ``<prefix><FIELD>``.

        Text that is no integer leaves the default; a number under the floor
        becomes the floor.
        """
        env = os.environ if env is None else env
        chosen = {}
        for field in dataclasses.fields(cls):
            try:
                chosen[field.name] = max(int(env[prefix + field.name.upper()]), _FLOORS[field.name])
            except (KeyError, ValueError):
                continue
        return cls(**chosen)

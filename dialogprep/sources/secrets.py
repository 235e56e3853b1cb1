"""Secrets file: a JSON object mapping phrases to replacement tokens.

This is a small configuration file, so it is read on the driver and turned
into an ordered list of (phrase, token) pairs that become column literals.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import SparkSession

from dialogprep.sources.listing import path_exists, read_small_text

log = logging.getLogger(__name__)


def parse_secrets(raw_text: str, strict: bool = False) -> list[tuple[str, str]]:
    """Ordered (lower-cased phrase, token) pairs; blank phrases dropped.

    Phrases equal after lower-casing keep the first position and the last
    token. Anything but a JSON object gives an empty list, or raises
    ValueError when ``strict``.
    """
    try:
        raw = json.loads(raw_text)
        problem = None if isinstance(raw, dict) else "it is not a JSON object"
    except ValueError as exc:
        problem = str(exc)
    if problem:
        if strict:
            raise ValueError(f"secrets file can't be used: {problem}")
        log.warning("secrets file can't be used: %s", problem)
        return []
    mapping: dict[str, str] = {}
    for phrase, token in raw.items():
        if phrase.strip():
            mapping[phrase.lower()] = str(token)
    return list(mapping.items())


def load_secrets(path: str | None, spark: SparkSession | None = None) -> list[tuple[str, str]]:
    """Read a secrets file; a missing file gives an empty list.

    A file that exists but holds no JSON object raises: going on without its
    phrases would let them through unredacted.

    With a session the path is resolved like any Spark path (a path without
    a scheme means the cluster's default file system); without one it is a
    local file.
    """
    if path is None:
        return []
    if spark is None:
        try:
            with open(path, encoding="utf-8") as fh:
                text = fh.read()
        except OSError:
            return []
        return parse_secrets(text, strict=True)
    return parse_secrets(read_small_text(spark, path), strict=True) if path_exists(spark, path) else []

"""Columns, widths and the event contract."""

from __future__ import annotations

# Fixed values from here to CHARSET: names, order, widths and rules of the event record, which must be these for right results.
RAW = "shard_id string, sequence_number string, partition_key string, arrival_ts timestamp, data binary"
#: String fields in the order in which they are checked, with their widths, and whether they must be there.
WIDTHS = {"app_name": 64, "app_version": 64, "event_version": 64, "event_id": 36, "event_type": 256, "client_id": 36, "level_id": 64}
REQUIRED = ("app_name", "event_version", "event_id", "event_type", "event_timestamp", "client_id")
#: Every field in the order of checks.
CHECKED = ("app_name", "app_version", "event_version", "event_id", "event_type", "event_timestamp", "client_id", "level_id", "position_x", "position_y")
POSITIONS = ("position_x", "position_y")
EVENT_COLUMNS = ("app_name", "app_version", "event_version", "event_id", "event_type", "event_timestamp", "server_timestamp", "client_id", "level_id", "position_x", "position_y")
NOT_NULL = ("event_id", "event_type", "event_timestamp", "server_timestamp")
#: Fixed value: the parser's character class: its range A-z also lets through [ \ ] ^ _ and the backtick. The strict one does not.
CHARSET = r"\A[-a-zA-z0-9_. ]*\z"
STRICT_CHARSET = r"\A[-a-zA-Z0-9_. ]*\z"
#: Fixed value: the form of ids.
UUID = r"\A[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\z"
_NAME = r"\A[A-Za-z0-9-_.]+\z"
#: The patterns that producers promise to keep.
CONTRACT_PATTERNS = {"app_name": _NAME, "app_version": _NAME, "event_version": _NAME, "event_id": UUID, "event_type": _NAME, "client_id": UUID, "level_id": r"\A[A-Za-z0-9-_]+\z"}
#: Two variants of the contract differ in what must be there.
CONTRACT_REQUIRED = {"current": ("app_name", "event_version", "event_id", "event_type", "event_timestamp", "client_id"), "older": ("app_name", "app_version", "event_id", "event_type", "event_timestamp", "client_id")}

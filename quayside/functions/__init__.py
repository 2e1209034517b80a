"""Column expressions (JVM-side, no UDFs)."""

from quayside.functions.json import (
    bytes_outcome, is_json, json_bigint, json_outcome, json_scalar, text_to_bigint, utf8_text, with_is_json, with_json_scalar,
)
from quayside.functions.text import (
    date_text, epoch_micros, epoch_millis, epoch_seconds, framed, from_epoch_micros,
    message_text, padded_id, status_class, truncate_to_millis, iso_text,
)

__all__ = [
    "bytes_outcome", "utf8_text", "is_json", "json_outcome", "json_scalar", "text_to_bigint", "json_bigint", "with_is_json", "with_json_scalar",
    "date_text", "epoch_micros", "epoch_millis", "epoch_seconds", "framed", "from_epoch_micros",
    "message_text", "padded_id", "status_class", "truncate_to_millis", "iso_text",
]

from tideline.functions.parse import (
    csv_fields,
    parse_clicks,
    parse_json,
    parse_pairs,
    parse_temperatures,
    tokens,
)
from tideline.functions.register import register_functions
from tideline.functions.scalar import java_hash, user_func
from tideline.functions.times import duration_us, epoch_ms, from_epoch_ms, micros, span

__all__ = [
    "csv_fields", "parse_clicks", "parse_json", "parse_pairs", "parse_temperatures", "tokens",
    "register_functions", "java_hash", "user_func",
    "duration_us", "epoch_ms", "from_epoch_ms", "micros", "span",
]

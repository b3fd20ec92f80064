"""Result writers (K1-K6, K10, K11). ``versions`` has tables replaced at once."""

from wayfare.sinks.files import (
    write_key_value_text,
    write_routed,
    write_single_row,
    write_lines,
    write_average_delay,
    write_named_parts,
    dump,
)

__all__ = ["write_key_value_text", "write_routed", "write_single_row", "write_lines", "write_average_delay",
           "write_named_parts", "dump"]

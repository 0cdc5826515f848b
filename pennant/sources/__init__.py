from pennant.sources.bucketed import read_bucketed, write_bucketed
from pennant.sources.files import (
    number_lines,
    read_crosswalk,
    read_csv,
    read_facts,
    read_game_log,
    unpivot_slots,
    write_table,
)
from pennant.sources.lines import Roles, as_lines, line_order, line_slot, lines_from_csv, union_lines

__all__ = [
    "Roles", "as_lines", "line_order", "line_slot", "lines_from_csv", "number_lines", "read_bucketed", "read_crosswalk",
    "read_csv", "read_facts", "read_game_log", "union_lines", "unpivot_slots", "write_bucketed", "write_table",
]

from .arrays import aligned_cells
from .clock import dep_time_24h, display_time, with_split_departure
from .text import paste, quoted, to_number

__all__ = [
    "aligned_cells", "dep_time_24h", "display_time", "paste", "quoted", "to_number", "with_split_departure",
]

from .cleaning import clean_trip_stops, fill_placeholder, filter_route_group, select_columns
from .joining import attach_stop_order, bounded, fits, natural_left_join
from .ranking import ranked
from .reshaping import pivot_grid, stop_columns, unpivot_grid
from .stacking import stack

__all__ = [
    "attach_stop_order", "bounded", "clean_trip_stops", "fill_placeholder", "filter_route_group", "fits",
    "natural_left_join", "pivot_grid", "ranked", "select_columns", "stack", "stop_columns",
    "unpivot_grid",
]

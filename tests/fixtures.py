"""Hand-worked inputs and outputs."""

from tripgrid.schemas import STOP_ORDER, TRIP_STOPS, text_schema

# departure, time, meridian, sortable time, printed time
CLOCK = [
    ("530a", 530, "a", 530, "530a"),
    ("0530a", 530, "a", 530, "0530a"),
    ("1215a", 1215, "a", 1215, "1215a"),
    ("1200p", 1200, "p", 1200, "1200p"),
    ("1215p", 1215, "p", 1215, "1215p"),
    ("100p", 100, "p", 1300, "100p"),
    ("1159p", 1159, "p", 2359, "1159p"),
    ("1200x", 1200, "x", 1200, "1200a"),
    ("1201x", 1201, "x", 2401, "1201a"),
    ("1215x", 1215, "x", 2415, "1215a"),
    ("130x", 130, "x", 2530, "130a"),
    ("1159x", 1159, "x", 3559, "1159a"),
    ("530am", 530, "am", 530, "530am"),
    ("130pm", 130, "pm", 130, "130pm"),
    ("0a", 0, "a", 0, "0a"),
    ("5:30p", None, None, None, "5:30p"),
    ("530", None, None, None, "530"),
    ("530P", None, None, None, "530P"),
    ("", None, None, None, ""),
    ("xx130x", None, None, None, "ax130x"),
    (None, None, None, None, None),
]

NAMES = {"10": "Main St.", "20": "Elm, N", "30": "Depot", "40": "Yard"}


def trip(number, route, stops, direction="East", op_day="Weekday", event=None):
    """One trip's rows; ``stops`` is a list of (stop, departure)."""
    return [
        (number, route, direction, f"P{stop}", stop, NAMES.get(stop, f"Stop {stop}"), op_day, departure, event)
        for stop, departure in stops
    ]


# Two merged routes, one direction.
GRID_TRIPS = [
    *trip("T1", "18", [("30", "530a"), ("30", "530a"), ("10", "540a")]),
    *trip("T2", "24", [("10", "1215x"), ("20", "1225x"), ("30", "1235x")]),
    *trip("T3", "24", [("20", "700a"), ("30", "5:30p")]),
    *trip("T4", "24", [("30", "600a")], op_day="Saturday", event="School"),
    *trip("T5", "24", [("10", "500a"), ("40", "505a")]),
    *trip("T6", "Car", [("10", "510a")]),
    *trip("T7", None, [("10", "511a")]),
    *trip("T8", "24", [("10", "512a")], direction="North"),
]
GRID_ORDER = [
    ("18", "East", "30", "1"), ("18", "East", "10", "2"),
    ("24", "East", "10", "1"), ("24", "East", "20", "2"), ("24", "East", "30", "3"),
    ("24", "North", "10", "1"),
]
GRID_HEADER = ["Depot - 30", "Main St. - 10", "Elm, N - 20"]
GRID_ROWS = [
    (1, "T1 - Weekday", "18", "", ["530a", "540a", "....."]),
    (2, "T4 - Saturday", "24", "School", ["600a", ".....", "....."]),
    (3, "T2 - Weekday", "24", "", ["1235a", "1215a", "1225a"]),
    (4, "T5 - Weekday", "24", "", [".....", "500a", "....."]),
    (5, "T3 - Weekday", "24", "", ["5:30p", ".....", "700a"]),
]


def trip_stops(spark, rows):
    return spark.createDataFrame(rows, text_schema(TRIP_STOPS))


def stop_order(spark, rows):
    return spark.createDataFrame(rows, text_schema(STOP_ORDER))

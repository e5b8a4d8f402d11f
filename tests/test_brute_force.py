"""Grids of random small inputs, against a walk through ordered rows in plain Python.

Spark has no row order; this test has: rows are sorted once, columns and trips are numbered as they
first appear, and trips are then sorted stably by their time at the busiest stop.
"""

import math
import random
import re

import pytest

from tests import fixtures as fx
from tripgrid import Timetable

GROUPS = {"a": ["1", "1L"], "b": ["7"]}
STOPS = ["10", "20", "30", "40", "50", "60"]


def _clock(text):
    found = re.fullmatch(r"([0-9]+)([a-z]+)", text or "")
    if not found:
        return math.inf
    time, meridian = float(found[1]), found[2]
    if meridian == "x" and time != 1200:
        return time + (1200 if time > 1200 else 2400)
    return time + 1200 if meridian == "p" and time < 1200 else time


def _inputs(rng):
    sheet = [
        (route, direction, stop, str(position))
        for route in ("1", "1L", "7") for direction in ("East", "West")
        for position, stop in enumerate(rng.sample(STOPS, 5))
    ]
    rows = []
    for number in range(150):
        route = rng.choice(["1", "1L", "7", "Car", "8", None])
        direction = rng.choice(["East", "West", "North"])
        departures = []
        for stop in rng.sample(STOPS, rng.randint(1, 6)):
            hour, minute = rng.randint(1, 12), rng.choice([0, 15, 30])
            text = f"{hour}{minute:02d}{rng.choice('apx')}"
            departures.append((stop, rng.choice([text, text, text, text, "0a", "5:30p", None])))
        rows += fx.trip(
            f"T{number}", route, departures, direction, rng.choice(["Weekday", "Sunday"]),
            rng.choice([None, None, "School"]),
        )
    rows += rng.choices(rows, k=60)
    rng.shuffle(rows)
    return rows, sheet


def _walk(rows, sheet):
    position = {(route, direction, stop): float(order) for route, direction, stop, order in sheet}
    group_of = {route: group for group, routes in GROUPS.items() for route in routes}
    grids = {}
    for number, route, direction, _, stop, name, day, text, event in set(rows):
        if route in group_of and direction != "North" and (route, direction, stop) in position:
            grids.setdefault((group_of[route], direction), []).append(
                (route, position[route, direction, stop], _clock(text), f"{number} - {day}", event or "",
                 f"{name} - {stop}", text)
            )
    result = {}
    for grid, lines in grids.items():
        columns, trips = {}, {}
        for route, _, time, trip, event, label, text in sorted(lines, key=lambda line: line[:6]):
            columns.setdefault(label, 0)
            columns[label] += 0 < time < math.inf
            shown = text.replace("x", "a", 1) if text else "....."
            trips.setdefault((trip, route, event), {})[label] = (time, shown)
        anchor = max(columns, key=columns.get)
        ranked = sorted(trips.items(), key=lambda item: item[1].get(anchor, (math.inf,))[0])
        result[grid] = list(columns), [
            (*trip, [cells.get(label, (0, "....."))[1] for label in columns]) for trip, cells in ranked
        ]
    return result


@pytest.mark.parametrize("seed", range(4))
def test_random_grids(spark, seed):
    rows, sheet = _inputs(random.Random(seed))
    with Timetable(fx.trip_stops(spark, rows), fx.stop_order(spark, sheet), groups=GROUPS) as timetable:
        headers = {(h.route_group, h.direction): h.stop_infos for h in timetable.headers.collect()}
        found = {grid: (stops, []) for grid, stops in headers.items()}
        for row in timetable.rows.orderBy("trip_rank").collect():
            found[row.route_group, row.direction][1].append((row.trp_op_day, row.route, row.evt_sta, row.cells))
    expected = _walk(rows, sheet)
    assert len(expected) == 4
    assert found == expected

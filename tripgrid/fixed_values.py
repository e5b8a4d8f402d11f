"""Values that decide what a timetable looks like."""

# Texts, patterns and tables that printed timetables depend on.
NOT_A_ROUTE = "Car"
DIRECTIONS = ("East", "West")
DEPARTURE_PATTERN = r"^(\d+)([a-z]+)$"
LABEL_SEPARATOR = " - "
MISSING_LABEL = "NA"
NO_EVENT = ""
EMPTY_CELL = "....."
ROUTE_GROUPS = {
    "1": ["1", "1L"],
    "2": ["2"],
    "3": ["3"],
    "7": ["7"],
    "9": ["9"],
    "10": ["10"],
    "13": ["13"],
    "14": ["14"],
    "15": ["15"],
    "16": ["16"],
    "23": ["23"],
    "24": ["24", "18"],
    "31": ["31"],
    "40": ["40"],
    "41": ["41"],
    "42": ["42"],
    "44": ["44"],
    "51": ["51", "52"],
    "54": ["54"],
    "60": ["60"],
    "61": ["61"],
    "66": ["66"],
    "67": ["67"],
    "69": ["69"],
    "73": ["73"],
    "80A": ["80A"],
    "81": ["81"],
    "83": ["83"],
    "84": ["84"],
    "84A": ["84A"],
    "93": ["93"],
    "94": ["94"],
    "99": ["99"],
    "411": ["411"],
    "413": ["413"],
    "432": ["432"],
    "434": ["434"],
    "501": ["501"],
    "504": ["504"],
    "671": ["671"],
    "672": ["672"],
    "673": ["673"],
    "674": ["674"],
    "A": ["A"],
    "C": ["C"],
}

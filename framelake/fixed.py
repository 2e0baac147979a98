"""Fixed values that results depend on."""

from __future__ import annotations

# Scene type followed by the raw scenes it covers.
SCENE_TAXONOMY = """
station bus_station/indoor train_station/platform railroad_track
parking parking_lot parking_garage/outdoor parking_garage/indoor garage/indoor garage/outdoor
gas gas_station
airfield airfield heliport landing_deck runway
ruin ruin trench
downtown downtown plaza
harbor harbor pier coast beach
park park picnic_area playground golf_course
alley alley boardwalk
crosswalk crosswalk
bridge bridge viaduct
village village windmill farm hayfield corn_field orchard
highway highway raceway
snowfield snowfield
neighborhood residential_neighborhood courtyard driveway loading_dock
wild field/wild marsh valley desert_road field_road forest forest_path forest_road mountain mountain_path
"""

# Fixed value: type of a frame none of whose scenes is in the taxonomy.
FALLBACK_SCENE = "street"

# Counters of the statistic table, in dashboard order.
SCENE_TYPES = ["airfield", "alley", "bridge", "crosswalk", "downtown", "gas", "harbor", "highway",
               "neighborhood", "park", "parking", "ruin", "snowfield", "station", "street", "wild", "village"]

# US state and district codes.
STATE_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA", "Colorado": "CO",
    "Connecticut": "CT", "Delaware": "DE", "District of Columbia": "DC", "Florida": "FL", "Georgia": "GA", "Hawaii": "HI",
    "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA",
    "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS",
    "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ",
    "New Mexico": "NM", "New York": "NY", "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK",
    "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD",
    "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA", "Washington": "WA",
    "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}

# Place labels of videos outside every region and of videos without coordinates.
OVERSEA, UNKNOWN = "Oversea", "Unknown"

# Suffix per power of one thousand.
MAGNITUDES = ["", " K", " M", " B", " T"]

# Colours of annotation boxes, picked by class number.
BOX_COLOURS = [
    "AliceBlue", "Chartreuse", "Aqua", "Aquamarine", "Azure", "Beige", "Bisque", "BlanchedAlmond", "BlueViolet", "BurlyWood",
    "CadetBlue", "AntiqueWhite", "Chocolate", "Coral", "CornflowerBlue", "Cornsilk", "Crimson", "Cyan", "DarkCyan",
    "DarkGoldenRod", "DarkGrey", "DarkKhaki", "DarkOrange", "DarkOrchid", "DarkSalmon", "DarkSeaGreen", "DarkTurquoise",
    "DarkViolet", "DeepPink", "DeepSkyBlue", "DodgerBlue", "FireBrick", "FloralWhite", "ForestGreen", "Fuchsia", "Gainsboro",
    "GhostWhite", "Gold", "GoldenRod", "Salmon", "Tan", "HoneyDew", "HotPink", "IndianRed", "Ivory", "Khaki", "Lavender",
    "LavenderBlush", "LawnGreen", "LemonChiffon", "LightBlue", "LightCoral", "LightCyan", "LightGoldenRodYellow", "LightGray",
    "LightGrey", "LightGreen", "LightPink", "LightSalmon", "LightSeaGreen", "LightSkyBlue", "LightSlateGray", "LightSlateGrey",
    "LightSteelBlue", "LightYellow", "Lime", "LimeGreen", "Linen", "Magenta", "MediumAquaMarine", "MediumOrchid",
    "MediumPurple", "MediumSeaGreen", "MediumSlateBlue", "MediumSpringGreen", "MediumTurquoise", "MediumVioletRed",
    "MintCream", "MistyRose", "Moccasin", "NavajoWhite", "OldLace", "Olive", "OliveDrab", "Orange", "OrangeRed", "Orchid",
    "PaleGoldenRod", "PaleGreen", "PaleTurquoise", "PaleVioletRed", "PapayaWhip", "PeachPuff", "Peru", "Pink", "Plum",
    "PowderBlue", "Purple", "Red", "RosyBrown", "RoyalBlue", "SaddleBrown", "Green", "SandyBrown", "SeaGreen", "SeaShell",
    "Sienna", "Silver", "SkyBlue", "SlateBlue", "SlateGray", "SlateGrey", "Snow", "SpringGreen", "SteelBlue", "GreenYellow",
    "Teal", "Thistle", "Tomato", "Turquoise", "Violet", "Wheat", "White", "WhiteSmoke", "Yellow", "YellowGreen",
]

# Statuses behind each choice of the status filter.
LEAD_STATUSES = {
    "open": ["Open - Not Contacted", "Working - Contacted"],
    "converted": ["Closed - Converted"],
    "lost": ["Closed - Not Converted"],
}


def scene_type_of() -> dict[str, str]:
    """Raw scene to scene type; a later line wins."""
    lines = [line.split(" ") for line in SCENE_TAXONOMY.strip().splitlines()]
    return {raw: line[0] for line in lines for raw in line[1:]}

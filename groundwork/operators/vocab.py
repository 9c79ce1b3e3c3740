"""Service vocabularies of the two categorizers.

Fixed values: these lists must equal the source application's category
lists exactly (names and order); they are written out as given.
"""

from __future__ import annotations

# Strict-rule categorizer (landscaping company), 55 entries.
STRICT_CATEGORIES = [
    "Straw Installation", "Straw Removal",
    "Cleaning/loading sidewalk debris", "Hauling sidewalk debris", "Spreading Debris at Stockpile",
    "Cleaning/Loading Debris",
    "Excavate Infiltration", "Supply Material (Infiltration)", "Install Infiltration",
    "Backfill Infiltration", "Compaction infiltration", "Relevel After Infiltration Backfill",
    "Initial Install of Slabs and Steps (Rear)", "Temporary Installation of Slabs and Steps (Front)",
    "Relevel Slabs",
    "Initial install of window wells",
    "Grading Work", "Topping Up Under Structures", "Filter Cloth Installation",
    "Regrading washouts due to heavy rains", "Grade & Sod Contract Completions",
    "Extra Deep Sod (125 feet)", "Removing filter cloth from rear yard",
    "Loading & Hauling Topsoil/Fill Stockpile Within Site", "Spreading at Stockpile",
    "Leveling at Stockpile",
    "Loading & Hauling Topsoil/Fill from Lots to Stockpile", "Loading & Hauling Topsoil/Fill from Lot to Lot",
    "Spreading Topsoil on Lots", "Spreading Topsoil", "Loading & Hauling Topsoil/Fill from Stockpile to Lots",
    "Importing Topsoil/Fill From Offsite", "Topsoil Placement for In-Betweens",
    "Spreading/Topping Up In-Betweens",
    "Removing Rocks & Debris from Topsoil",
    "Sod Removal", "Settlement Repairs", "Curb settlement repairs", "Sod Material for Curb Repair",
    "Driveway Edge Settlement Repairs", "Sod Material for Driveway Edge",
    "Miscellaneous", "Bin Management", "Indoor Cleaning", "Garbage Collection", "Brick Management",
    "Concrete Work", "Equipment Supply", "Garage Filling & Leveling", "Labor Supply", "Road Maintenance",
    "Wall & Fence Installation", "Water Management", "Drainage System Installation", "Sod Installation",
]

# Tiered categorizer (excavation company), 40 entries by level.
TIERED_LEVELS = {
    1: [
        "Ripping Basement", "Ripping Sewers", "Ripping Base", "Ripping Backfill",
        "Stockpile Sewer", "Stockpile Basement", "Backfill Basement", "Sewer Backfill",
        "Sewer Excavation", "Basement Excavation", "Double Cast Sewer", "Double Cast Basement",
        "Straw Installation", "Straw Removal", "Strip Topsoil prior to Excavation", "Driveway Cut",
    ],
    2: [
        "Loading Fill From Lots", "Loading Fill To Lots", "Haul From Stockpile", "Haul To Stockpile",
        "Loading Excess Fill Offsite", "Hauling Excess Fill Offsite", "Spreading At Stockpile",
        "Rough Grade", "Low Lots", "Base Condition", "Concrete Work", "Mud",
    ],
    3: [
        "General Stockpile", "Grade", "Releveling", "Spreading/Top Up",
        "Cast/ Double Cast", "General Straw", "Road", "Tarp", "Flagman", "Snow", "Ramp",
    ],
    4: ["Miscellaneous"],
}

TIERED_CATEGORIES = [name for level in sorted(TIERED_LEVELS) for name in TIERED_LEVELS[level]]

# Renames applied by the tiered categorizer before validation.
TIERED_RENAMES = {
    "Haul From Lots": "Haul To Stockpile",
    "Haul To Lots": "Haul From Stockpile",
    "Loading Fill To Stockpile": "Loading Fill From Lots",
    "Loading Fill From Stockpile": "Loading Fill To Lots",
}

# Company routing.
STRICT_COMPANY = "Aeon Landscaping"
TIERED_COMPANY = "AE3 Excavating"

NOT_SPECIFIED = "Not specified"
SETTLEMENT = "Settlement Repairs"
MISC = "Miscellaneous"
ERROR_TEXT = "Error in categorization"


def vocabulary_rows() -> list[tuple[str, str, int, int]]:
    """(mode, category, level, index) rows for a vocabulary DataFrame."""
    rows = [("strict", c, 1, i) for i, c in enumerate(STRICT_CATEGORIES)]
    i = 0
    for level in sorted(TIERED_LEVELS):
        for c in TIERED_LEVELS[level]:
            rows.append(("tiered", c, level, i))
            i += 1
    return rows

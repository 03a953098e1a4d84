"""Tables of names as data; every operator takes them as parameters and these are the defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The five areas in order of precedence, their ZIP codes, place names, and the names that fill an empty city.
AREAS = ["BROOKLYN", "QUEENS", "MANHATTAN", "BRONX", "STATEN ISLAND"]
ZIP_RANGES = {
    "MANHATTAN": "10001-10282",
    "BRONX": "10451-10475",
    "BROOKLYN": "11201-11240 11244-11256",
    "STATEN ISLAND": "10301-10314",
    "QUEENS": """11101 11102 11103 11104 11105 11106
        11354 11355 11356 11357 11358 11359 11360 11361 11362 11363 11364 11365 11366 11367
        11368 11369 11370 11371 11372 11373 11374 11375
        11377 11378 11379 11385
        11411 11412 11413 11414 11415 11416 11417
        11418 11419 11420 11421 11422 11423 11426 11427 11428 11429 11430 11432 11433 11434 11435 11436
        11451 11690 11691 11692 11693 11694 11697
        11004 11005""",
}
PLACES = {
    "BROOKLYN": """WILLIAMSBURG, PARK SLOPE, BUSHWICK, CROWN HEIGHTS, BEDFORD STUYVESANT, FLATBUSH, BAY RIDGE, SUNSET PARK,
        BENSONHURST, CONEY ISLAND, BROWNSVILLE, CANARSIE, BOROUGH PARK, SHEEPSHEAD BAY, BRIGHTON BEACH, DUMBO,
        DOWNTOWN BROOKLYN, FORT GREENE, CLINTON HILL, PROSPECT HEIGHTS, CARROLL GARDENS, COBBLE HILL, BOERUM HILL, RED HOOK,
        GOWANUS, GREENPOINT, EAST NEW YORK, CYPRESS HILLS, FLATLANDS, GRAVESEND, MARINE PARK, MILL BASIN,
        MIDWOOD, DYKER HEIGHTS, BATH BEACH, BROOKLYN""",
    "QUEENS": """ASTORIA, FLUSHING, JACKSON HEIGHTS, LONG ISLAND CITY, FOREST HILLS, JAMAICA, RIDGEWOOD, WOODSIDE, ELMHURST,
        CORONA, KEW GARDENS, HOWARD BEACH, BAYSIDE, WHITESTONE, FRESH MEADOWS, REGO PARK, SUNNYSIDE, MASPETH, MIDDLE VILLAGE,
        GLENDALE, OZONE PARK, SOUTH OZONE PARK, RICHMOND HILL, SOUTH RICHMOND HILL, KEW GARDENS HILLS, BRIARWOOD, HOLLIS,
        QUEENS VILLAGE, ROSEDALE, LAURELTON, SPRINGFIELD GARDENS, ST ALBANS, CAMBRIA HEIGHTS, BELLEROSE, FLORAL PARK,
        GLEN OAKS, NEW HYDE PARK, DOUGLASTON, LITTLE NECK, AUBURNDALE, EAST ELMHURST, COLLEGE POINT, MALBA, BEECHHURST,
        FAR ROCKAWAY, ARVERNE, ROCKAWAY BEACH, BELLE HARBOR, NEPONSIT, BREEZY POINT, BROAD CHANNEL, QUEENS""",
    "MANHATTAN": """HARLEM, UPPER WEST SIDE, UPPER EAST SIDE, MIDTOWN, CHELSEA, GREENWICH VILLAGE, SOHO, TRIBECA, CHINATOWN,
        LOWER EAST SIDE, WASHINGTON HEIGHTS, INWOOD, EAST HARLEM, MORNINGSIDE HEIGHTS, HAMILTON HEIGHTS, MANHATTANVILLE,
        WEST VILLAGE, EAST VILLAGE, GRAMERCY, MURRAY HILL, KIPS BAY, TURTLE BAY, SUTTON PLACE, YORKVILLE, LENOX HILL,
        CARNEGIE HILL, UPPER MANHATTAN, FINANCIAL DISTRICT, BATTERY PARK CITY, CIVIC CENTER, TWO BRIDGES, NOHO, NOLITA,
        LITTLE ITALY, BOWERY, ALPHABET CITY, STUYVESANT TOWN, PETER COOPER VILLAGE, ROOSEVELT ISLAND, MARBLE HILL, SUGAR HILL,
        STRIVERS ROW, CLINTON, HELLS KITCHEN, GARMENT DISTRICT, MIDTOWN EAST, MIDTOWN WEST, THEATER DISTRICT, TIMES SQUARE,
        KOREATOWN, NOMAD, FLATIRON, UNION SQUARE, MADISON SQUARE, NEW YORK, MANHATTAN""",
    "BRONX": """FORDHAM, RIVERDALE, KINGSBRIDGE, PELHAM BAY, MORRISANIA, HUNTS POINT, SOUNDVIEW, PARKCHESTER, THROGS NECK,
        CO OP CITY, WAKEFIELD, WILLIAMSBRIDGE, BAYCHESTER, EASTCHESTER, MORRIS PARK, VAN NEST, BELMONT, TREMONT, MOUNT HOPE,
        BEDFORD PARK, NORWOOD, WOODLAWN, SPUYTEN DUYVIL, FIELDSTON, JEROME PARK, CONCOURSE, HIGHBRIDGE, MOUNT EDEN, MELROSE,
        MOTT HAVEN, PORT MORRIS, LONGWOOD, CLASON POINT, CASTLE HILL, UNIONPORT, WESTCHESTER SQUARE, CITY ISLAND,
        COUNTRY CLUB, PELHAM GARDENS, BRONX""",
    "STATEN ISLAND": """ST GEORGE, NEW BRIGHTON, PORT RICHMOND, TOTTENVILLE, STAPLETON, CLIFTON, ROSEBANK, SOUTH BEACH,
        MIDLAND BEACH, NEW DORP, OAKWOOD, GREAT KILLS, ELTINGVILLE, ANNADALE, HUGUENOT, PRINCES BAY, PLEASANT PLAINS,
        CHARLESTON, ROSSVILLE, WOODROW, RICHMOND VALLEY, TRAVIS, CHELSEA, BLOOMFIELD, BULLS HEAD, WILLOWBROOK, TODT HILL,
        EMERSON HILL, LIGHTHOUSE HILL, DONGAN HILLS, GRANT CITY, ARROCHAR, STATEN ISLAND""",
}
CITY_OF_AREA = {"MANHATTAN": "NEW YORK", "BROOKLYN": "BROOKLYN", "QUEENS": "QUEENS", "BRONX": "BRONX", "STATEN ISLAND": "STATEN ISLAND"}

# agencies' names and groups.
AGENCY_NAMES = {
    "3-1-1": "311 Customer Service Center",
    "DCWP": "Department of Consumer and Worker Protection",
    "DEP": "Department of Environmental Protection",
    "DFTA": "Department for the Aging",
    "DHS": "Department of Homeless Services",
    "DOB": "Department of Buildings",
    "DOE": "Department of Education",
    "DOHMH": "Department of Health and Mental Hygiene",
    "DOITT": "Department of Information Technology and Telecommunications",
    "DOT": "Department of Transportation",
    "DPR": "Department of Parks and Recreation",
    "DSNY": "Department of Sanitation",
    "EDC": "Economic Development Corporation",
    "HPD": "Housing Preservation and Development",
    "NYPD": "New York Police Department",
    "OSE": "Office of Special Enforcement",
    "OTI": "Office of Technology and Innovation",
    "TLC": "Taxi and Limousine Commission",
    "OTHER": "Other Agencies",
}
AGENCY_GROUPS = {
    "Public Safety": "NYPD DOB",
    "City Services": "DSNY DOT DPR",
    "Environment & Utilities": "DEP",
    "Social Services": "DHS DFTA",
    "Education": "DOE",
    "Health": "DOHMH",
    "Regulatory & Licensing": "TLC DCWP",
    "Administration & Technology": "3-1-1 OTI DOITT EDC OSE",
    "Housing": "HPD",
}

# The rules of the type classifier, in order. Of each: substrings (with % inside as in LIKE), whole values,
# and pairs of a substring with one that must be absent.
TYPE_RULES: list[tuple[str, list[str], list[str], dict[str, str]]] = [
    (
        "Data Quality Issue",
        ["SELECT%FROM", "WINDOWS%WIN.INI", "WEB-INF", "NSLOOKUP", "SLEEP(", "XMLTYPE", "EVAL(", "OGNL", "ETC/PASSWD", "ECHO", "DECLARE @"],
        [],
        {},
    ),
    (
        "Internal/Test Data",
        ["TEST"],
        [
            "DSNY INTERNAL", "DPR INTERNAL", "ZTESTINT", "SRGOVG", "INTERNAL CODE", "ATF", "ZSYSTEST", "SG-99", "INCORRECT DATA", "NONCONST",
            "MISCELLANEOUS CATEGORIES", "BOROUGH OFFICE", "SPECIAL PROJECTS INSPECTION TEAM (SPIT)", "INVESTIGATIONS AND DISCIPLINE (IAD)",
            "PUBLIC PAYPHONE COMPLAINT", "EXECUTIVE INSPECTIONS", "FORENSIC ENGINEERING", "AHV INSPECTION UNIT", "SPECIAL OPERATIONS",
            "DISCIPLINE AND SUSPENSION", "REGISTRATION AND TRANSFERS", "SPECIAL NATURAL AREA DISTRICT (SNAD)", "FATF", "FCST",
        ],
        {},
    ),
    (
        "Tax & Property",
        ["ADVOCATE", "DOF PROPERTY", "DOF PARKING", "DOR LITERATURE"],
        ["SCRIE", "DRIE", "TAXPAYER ADVOCATE INQUIRY", "BENEFIT CARD REPLACEMENT"],
        {},
    ),
    (
        "Social Services",
        [
            "HOME DELIVERED MEAL", "ELDER", "SENIOR", "ALZHEIMER", "NORC", "HEAP", "DHS ADVANTAGE", "LEGAL SERVICES PROVIDER", "HOME CARE PROVIDER",
            "CASE MANAGEMENT", "TRANSPORTATION PROVIDER", "BEREAVEMENT", "HOMEBOUND",
        ],
        ["HOMELESS PERSON ASSISTANCE", "HOUSING OPTIONS", "WEATHERIZATION", "HOME REPAIR"],
        {},
    ),
    (
        "Noise",
        ["NOISE"],
        [],
        {},
    ),
    (
        "Building & Housing",
        [
            "BUILDING", "CONSTRUCTION", "HEAT", "HOT WATER", "PLUMBING", "ELEVATOR", "PAINT", "MOLD", "LEAD", "BOILER", "DOOR/WINDOW", "FLOORING", "FACADES",
            "SCAFFOLD", "WATER LEAK", "INDOOR SEWAGE", "COOLING TOWER",
        ],
        ["APPLIANCE", "VACANT APARTMENT", "EVICTION", "VACANT LOT", "LOT CONDITION", "UNSTABLE BUILDING", "ELECTRIC", "ELECTRICAL"],
        {},
    ),
    (
        "Street & Infrastructure",
        [
            "STREET", "SIDEWALK", "HIGHWAY", "BRIDGE", "TUNNEL", "TRAFFIC", "SNOW", "LIGHT", "SIGN", "PARKING", "DRIVEWAY", "CURB", "SEWER", "WATER SYSTEM",
            "WATER MAINTENANCE",
        ],
        [
            "OBSTRUCTION", "BENCH", "WAYFINDING", "LINKNYC", "BROKEN MUNI METER", "BROKEN PARKING METER", "MAINTENANCE OR FACILITY", "WATER CONSERVATION",
            "STANDING WATER", "CRANES AND DERRICKS", "UTILITY PROGRAM", "PUBLIC TOILET", "STALLED SITES",
        ],
        {},
    ),
    (
        "Sanitation & Cleanliness",
        [
            "GARBAGE", "SANITATION", "COLLECTION", "RECYCLING", "LITTER", "DIRTY", "UNSANITARY", "DUMPSTER", "DISPOSAL", "GRAFFITI", "DUMPING", "SWEEPING",
            "TRANSFER STATION", "FOAM BAN",
        ],
        ["OVERFLOWING LITTER BASKETS", "ADOPT-A-BASKET", "ELECTRONICS WASTE", "DERELICT BICYCLE", "ELECTRONICS WASTE APPOINTMENT", "INDUSTRIAL WASTE"],
        {},
    ),
    (
        "Parks & Environment",
        ["TREE", "PARK", "RODENT", "AIR QUALITY", "WATER QUALITY", "PLANT", "MOSQUITOES", "POISON IVY", "HARBORING BEES", "DOG", "WILDLIFE"],
        ["BEACH/POOL/SAUNA COMPLAINT", "LIFEGUARD", "VIOLATION OF PARK RULES", "OUTDOOR DINING", "STORM", "UPROOTED STUMP", "WOOD PILE REMAINING"],
        {"ANIMAL": "VEHICLE"},
    ),
    (
        "Transportation",
        ["TAXI", "VEHICLE", "FOR HIRE", "FHV", "FERRY", "BUS", "BIKE", "SCOOTER", "E-SCOOTER", "GREEN TAXI"],
        ["DERELICT VEHICLES", "ABANDONED VEHICLE", "BUS STOP SHELTER COMPLAINT"],
        {},
    ),
    (
        "Quality of Life",
        [
            "ILLEGAL", "HOMELESS", "VIOLATION", "DRUG", "ENCAMPMENT", "CONSUMER COMPLAINT", "DISORDERLY", "FIREWORKS", "NON-EMERGENCY POLICE", "ENFORCEMENT",
            "NONCOMPLIANCE",
        ],
        [
            "URINATING IN PUBLIC", "PANHANDLING", "SQUEEGEE", "DRINKING", "VENDING", "QUALITY OF LIFE", "POSTING ADVERTISEMENT", "VENDOR ENFORCEMENT",
            "OTHER ENFORCEMENT", "REAL TIME ENFORCEMENT", "SUSTAINABILITY ENFORCEMENT", "CANNABIS RETAILER", "LEANING BAR",
        ],
        {},
    ),
    (
        "Health & Safety",
        ["FOOD", "HEALTH", "SAFETY", "COVID", "ASBESTOS", "SMOKING", "HAZARD", "X-RAY", "RADIOACTIVE", "VACCINE", "FACE COVERING"],
        [
            "LIFEGUARD", "WINDOW GUARD", "TATTOOING", "TANNING", "PET SHOP", "PET SALE", "CALORIE LABELING", "SUMMER CAMP", "DAY CARE",
            "EMERGENCY RESPONSE TEAM (ERT)", "DRINKING WATER", "BOTTLED WATER",
        ],
        {},
    ),
    (
        "General Inquiry",
        ["REQUEST", "INQUIRY", "LITERATURE REQUEST", "QUESTION", "PROPERTY"],
        [
            "GENERAL", "COMMENTS", "FORMS", "SELECT MESSAGE TYPE...", "AGENCY", "OEM LITERATURE REQUEST", "LOST PROPERTY", "FOUND PROPERTY",
            "MASS GATHERING COMPLAINT",
        ],
        {},
    ),
    (
        "Education",
        ["SCHOOL", "TEACHING", "NO CHILD LEFT BEHIND"],
        [],
        {},
    ),
]
MALICIOUS = ["SELECT%FROM", "WINDOWS%WIN.INI", "WEB-INF", "NSLOOKUP"]
TESTS = (["TEST"], ["DSNY INTERNAL", "ZTESTINT", "ZSYSTEST", "NONCONST"])


def zip_areas(spark: SparkSession) -> DataFrame:
    """(zip, zip_area), from the ranges."""
    rows = []
    for area, ranges in ZIP_RANGES.items():
        for part in ranges.split():
            first, _, last = part.partition("-")
            rows += [(str(z), area) for z in range(int(first), int(last or first) + 1)]
    return spark.createDataFrame(rows, "zip string, zip_area string")


def place_areas(spark: SparkSession) -> DataFrame:
    """(place, place_area); a name in two areas belongs to the first in order."""
    seen: dict[str, str] = {}
    for area in AREAS:
        for name in PLACES[area].split(","):
            seen.setdefault(" ".join(name.split()), area)
    return spark.createDataFrame(sorted(seen.items()), "place string, place_area string")

"""Demo lookups and rules for the supplied tables, as rows for Spark and for the oracle SQL."""

TIER_1 = [
    ("ECONOMY", "SKIP"), ("MEDIUM", "SKIP"), ("PROMO", "EXCLUDE"), ("SMALL", "Manual"), ("LARGE", "Mechanical"),
]
TIER_2 = [
    ("small widget", "Removal"), ("red widget", "Removal"), ("blue widget", "Removal"), ("new widget", "Removal"),
    ("small gear", "SKIP"), ("large gear", "SKIP"), ("cold gear", "EXCLUDE"), ("hot ring", "Pile Burn"),
]
TIER_3 = [
    ("Brand#1", "Manual"), ("  Brand#2  ", "Mastication"), ("Brand#3", "Chemical"), ("Brand#4", "SKIP"),
    ("Brand#5", "Mulching"), ("Brand#6", "Seed"), ("Brand#7", "Manual"), ("Brand#8", "EXCLUDE"),
    ("Brand#9", "Manual"), ("Brand#9", "Mechanical"), ("null", "Never"),
]
TYPES = [
    ("ECONOMY", "Brand#1", "", "DELETE"), ("MEDIUM", "Brand#2", "", "Mechanical"), ("SMALL", "Brand#3", "None", "TREE CHECK"),
    ("SMALL", "Brand#3", "none", "Lop and Scatter"), ("LARGE", "Brand#4", "red rod", "Pile Fuels"),
    ("LARGE", "Brand#5", "", ""), ("PROMO", "Brand#6", "", "red widget"), ("STANDARD", "Brand#7", "", "Manual"),
]
FUNDS = [
    ("BUILDING", "Building Fund", "Federal"), ("MACHINERY", "Machinery, Heavy", "Federal"),
    ("HOUSEHOLD", "Other", "State"), ("AUTOMOBILE", "Road Fund", "State"), ("AUTOMOBILE", "Motor Fund", "Private"),
    ("FURNITURE", "Unknown", "Unknown"), ("FURNITURE|ZZZZ", "Joint Fund", "Federal"),
    ("1-URGENT", "Urgent Fund", "Federal"), ("2-HIGH", "Building Fund", "Federal"),
]
RULES = [
    ("red widget", "Mechanical"),
    ("(?:^| )red", "Manual"),
    ("widget", "Removal"),
    ("[^ ]+ ring", "Pile Fuels"),
    ("hot [^ ]+ ring", "Broadcast Burn"),
    ("anvil", "DELETE"),
    ("gizmo|licen[sc]e", "DELETE"),
    ("old bolt", "TREE CHECK"),
    ("gear", "Mastication"),
    ("cold rod", "Manual"),
    ("plate", "PLANT CHECK"),
    ("(?:^| )the(?: |$)", "Seed"),
]


def with_line_no(rows):
    return [(*r, i) for i, r in enumerate(rows)]

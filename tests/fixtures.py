"""Small raw inputs with known outcomes."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from orrery.operators.first_rows import ROW_ORDER
from orrery.schemas import AGENCY_RAW, RETAIL_RAW

PRODUCTS = [
    ("PRD101", "Laptop Pro", "Electronics", Decimal("899.99")),
    ("PRD102", "  Chinos  ", "Apparel", Decimal("45.00")),
    ("PRD999", "Demo Credit", "Electronics", Decimal("-50.00")),
    ("PRD888", "Enterprise Server", "Electronics", Decimal("99999.00")),
]
CUSTOMERS = [
    ("CUST101", "  John Smith  ", "JOHN.SMITH@EXAMPLE.COM", "USA", "2024-01-15"),
    ("CUST101", "John Smith duplicate", "dup@example.com", "US", "2024-01-15"),
    ("CUST102", "jane doe", "jane@example.com", "Canada", "NULL"),
    ("CUST103", "", None, "UK", "10/31/2024"),
]
SESSIONS = [
    ("SESS001", "CUST101", "2024-03-01", "Google", "Mobile", 5, 300, 0, 1),
    ("SESS002", "CUST102", "2024-03-02", "Direct", "Desktop", -2, 120, 0, 0),
    ("SESS003", "CUST999", "2024-03-03", "Organic", "Mobile", 10, 600, 0, 1),
    ("SESS004", "CUST101", "2024-03-04", "Social", "Desktop", 4, -10, 1, 0),
    ("SESS005", "CUST102", "2024-03-05", "Email", "Mobile", 3, 150, 0, 0),
]


def with_order(spark, rows, layout):
    """Rows as a DataFrame with their position in the list as row order."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout.fields)
    numbered = [(*row, i) for i, row in enumerate(rows)]
    return spark.createDataFrame(numbered, f"{fields}, {ROW_ORDER} long")


def retail_raw(spark, **rows):
    """The five raw retail tables, empty unless given."""
    return {name: with_order(spark, rows.get(name, []), layout) for name, layout in RETAIL_RAW.items()}


def agency_raw(spark):
    d, day = Decimal, dt.date
    rows = {
        "managers": [("M1", "  michael chang  ", "APAC", d(500000)), ("M2", "jane smith", "AMER", d(300000))],
        "clients": [
            ("C1", "  acme marketing agency corp  ", "Technology", "Gold", d(15000), day(2024, 1, 15), "M1"),
            ("C2", "globex corp", "Healthcare", "Silver", d(8000), day(2024, 2, 20), "M2"),
        ],
        "campaigns": [
            ("CAMP1", "C1", "Search Ads", "Google Ads", d(20000)),
            ("CAMP2", "C2", "Social Promo", "Facebook Ads", d(10000)),
        ],
        "ad_performance": [
            (day(2024, 3, 1), "CAMP1", "C1", d(1500), 50000, 1200, 45, d(12000)),
            (day(2024, 3, 2), "CAMP2", "C2", d(800), 20000, 600, 18, d(4800)),
        ],
        "client_billing": [
            (day(2024, 3, 31), "INV001", "C1", "M1", d(15000), d(1500), d(500), d(17000)),
            (day(2024, 3, 31), "INV002", "C2", "M2", d(8000), d(800), d(0), d(8800)),
        ],
    }
    return {name: spark.createDataFrame(rows[name], layout) for name, layout in AGENCY_RAW.items()}

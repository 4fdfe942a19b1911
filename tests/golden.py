"""A 92-day mart of nine SKUs and the tables a report on its last day must give.

Values over time are run lengths: ``3x20`` is the value 20 on three days in a row.
"""

from __future__ import annotations

from datetime import date, timedelta

FIRST = date(2019, 7, 1)
AS_OF = date(2019, 9, 30)
DAYS = [FIRST + timedelta(days=n) for n in range((AS_OF - FIRST).days + 1)]
REGION = "testing"


def unroll(runs: str) -> list[float]:
    values: list[float] = []
    for run in runs.split():
        times, value = run.split("x")
        values += [float(value)] * int(times)
    return values


# Input mart.
# SKU: category, supplier, payment terms, brand
SKUS = {
    "A001": ("EL", "VN_Supplier_A", "30 NET", "Abrand1"),
    "A002": ("EL", "VN_Supplier_A", "30 NET", "Abrand1"),
    "A003": ("EL", "VN_Supplier_A", "30 NET", "Abrand2"),
    "B001": ("FMCG", "VN_Supplier_B", "7 NET", "Bbrand1"),
    "B002": ("FMCG", "VN_Supplier_B", "7 NET", "Bbrand2"),
    "B003": ("FMCG", "VN_Supplier_B", "7 NET", "Bbrand3"),
    "C001": ("lifestyle", "VN_Supplier_C", "30 NET", "Cbrand1"),
    "C002": ("lifestyle", "VN_Supplier_C", "30 NET", "Cbrand2"),
    "C003": ("lifestyle", "VN_Supplier_C", "30 NET", "Cbrand2"),
}
COGS = {
    "A001": "92x0",
    "A002": "7x0 1x400 30x0 1x100 53x0",
    "A003": "4x0 1x90 58x0 1x90 1x120 27x0",
    "B001": "1x0 1x900 7x0 1x300 82x0",
    "B002": "19x0 1x1500 4x0 1x200 6x0 1x300 60x0",
    "B003": "71x0 1x200 20x0",
    "C001": "21x0 1x250 11x0 1x400 1x100 57x0",
    "C002": "50x0 1x800 41x0",
    "C003": "71x0 1x300 14x0 1x300 5x0",
}
UNITS = {
    "A001": "25x0 2x5 65x10",
    "A002": "3x0 4x20 29x0 2x25 54x20",
    "A003": "1x0 3x5 57x2 2x17 1x14 28x10",
    "B001": "1x30 7x0 2x10 82x0",
    "B002": "7x0 12x20 5x5 7x3 3x0 58x5",
    "B003": "63x0 4x5 4x50 21x30",
    "C001": "21x50 10x0 2x200 1x120 58x100",
    "C002": "32x0 5x10 13x50 42x10",
    "C003": "65x0 6x20 11x0 4x20 6x0",
}
INBOUND = {
    "A001": "25x0 1x50 1x0 1x50 64x0",
    "A002": "3x0 1x400 32x0 1x500 55x0",
    "A003": "1x0 1x150 59x0 1x450 30x0",
    "B001": "7x0 1x300 84x0",
    "B002": "7x0 1x2000 26x0 1x500 57x0",
    "B003": "63x0 1x50 3x0 1x450 24x0",
    "C001": "31x0 1x1000 60x0",
    "C002": "32x0 1x200 4x0 1x800 54x0",
    "C003": "65x0 1x300 16x0 1x300 9x0",
}
PAYABLES = {
    "A001": "25x0 2x50 28x100 2x50 35x0",
    "A002": "3x0 30x400 3x0 30x500 26x0",
    "A003": "1x0 30x150 30x0 30x450 1x0",
    "B001": "2x900 5x0 7x300 78x0",
    "B002": "7x0 7x2000 20x0 7x500 51x0",
    "B003": "63x0 4x50 3x500 4x450 18x0",
    "C001": "21x250 10x0 30x1000 31x0",
    "C002": "32x0 5x200 25x1000 5x800 25x0",
    "C003": "65x0 17x300 10x600",
}
INVENTORY = {
    "A001": "25x0 2x50 65x100",
    "A002": "3x0 4x400 29x0 2x500 54x400",
    "A003": "1x0 3x150 57x60 2x510 1x420 28x300",
    "B001": "1x900 7x0 2x300 82x0",
    "B002": "7x0 12x2000 5x500 7x300 3x0 58x500",
    "B003": "63x0 4x50 4x500 21x300",
    "C001": "21x250 10x0 2x1000 1x600 58x500",
    "C002": "32x0 5x200 13x1000 42x200",
    "C003": "65x0 6x300 11x0 4x300 6x0",
}

# Expected tables.
EXPECTED_TRACKING = [
    ("EL", "VN_Supplier_A", 3, 40, 800.0, "Abrand1", "Abrand2", "n.a.", "30 NET"),
    ("FMCG", "VN_Supplier_B", 3, 35, 800.0, "Bbrand1", "Bbrand2", "Bbrand3", "7 NET"),
    ("lifestyle", "VN_Supplier_C", 3, 110, 700.0, "Cbrand2", "Cbrand1", "n.a.", "30 NET"),
]
EXPECTED_MATRICES = {
    "cogs": {
        "VN_Supplier_A": "4x0 1x90 2x0 1x400 30x0 1x100 24x0 1x90 1x120 27x0",
        "VN_Supplier_B": "1x0 1x900 7x0 1x300 9x0 1x1500 4x0 1x200 6x0 1x300 39x0 1x200 20x0",
        "VN_Supplier_C": "21x0 1x250 11x0 1x400 1x100 15x0 1x800 20x0 1x300 14x0 1x300 5x0",
    },
    "inventory": {
        "VN_Supplier_A": "1x0 2x150 1x550 3x460 18x60 2x110 9x160 2x660 23x560 2x1010 1x920 "
        "28x800",
        "VN_Supplier_B": "1x900 6x0 1x2000 2x2300 9x2000 5x500 7x300 3x0 29x500 4x550 4x1000 "
        "21x800",
        "VN_Supplier_C": "21x250 10x0 1x1000 1x1200 1x800 3x700 13x1500 15x700 6x1000 11x700 "
        "4x1000 6x700",
    },
    "payable": {
        "VN_Supplier_A": "1x0 2x150 22x550 2x600 4x650 2x500 3x100 19x600 2x550 4x500 5x950 "
        "25x450 1x0",
        "VN_Supplier_B": "2x900 5x0 7x2300 20x0 7x500 22x0 4x50 3x500 4x450 18x0",
        "VN_Supplier_C": "21x250 10x0 1x1000 5x1200 24x2000 1x1000 3x800 2x1100 15x300 10x600",
    },
    "inbound": {
        "VN_Supplier_A": "1x0 1x150 1x0 1x400 21x0 1x50 1x0 1x50 8x0 1x500 24x0 1x450 30x0",
        "VN_Supplier_B": "7x0 1x2300 26x0 1x500 28x0 1x50 3x0 1x450 24x0",
        "VN_Supplier_C": "31x0 1x1000 1x200 4x0 1x800 27x0 1x300 16x0 1x300 9x0",
    },
}
# m2, m1, m0, m0_30d
EXPECTED_TRAILING = {
    "cogs": {
        "VN_Supplier_A": (490, 590, 800, 210),
        "VN_Supplier_B": (2900, 3200, 2500, 200),
        "VN_Supplier_C": (250, 1550, 2150, 600),
    },
    "inv": {
        "VN_Supplier_A": (134.516129, 325.483871, 492.888889, 811.0),
        "VN_Supplier_B": (970.967742, 711.290323, 741.111111, 783.333333),
        "VN_Supplier_C": (169.354839, 616.935484, 686.111111, 800.0),
    },
    "payable": {
        "VN_Supplier_A": (522.580645, 531.451613, 531.666667, 501.666667),
        "VN_Supplier_B": (577.419355, 345.161290, 256.666667, 116.666667),
        "VN_Supplier_C": (169.354839, 987.903226, 842.777778, 503.333333),
    },
}
EXPECTED_L30_DAYS = {
    "VN_Supplier_A": 158.5,
    "VN_Supplier_B": None,
    "VN_Supplier_C": 24.615385,
}

MART_DDL = (
    "grass_region string, category_cluster string, supplier_name string, sku_id string, "
    "cdate date, color string, cogs_usd double, stock_on_hand int, "
    "inbound_value_usd double, acct_payables_usd double, inventory_value_usd double, "
    "payment_terms string, brand string, grass_date date, purchase_type string"
)


def mart_rows() -> list[tuple]:
    rows = []
    for sku, (category, supplier, terms, brand) in SKUS.items():
        columns = [unroll(m[sku]) for m in (COGS, UNITS, INBOUND, PAYABLES, INVENTORY)]
        for day, cogs, units, inbound, payables, inventory in zip(DAYS, *columns):
            rows.append(
                (REGION, category, supplier, sku, None, None, cogs, int(units), inbound)
                + (payables, inventory, terms, brand, day, "Outright")
            )
    return rows

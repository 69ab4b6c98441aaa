"""Lookup values of the product domain.

Everything marked "fixed values" decides results (which rule fires, which rate applies) and must
not be changed. Brand names and name templates carry no rule; they are built from a pattern and any
lookup can be replaced by a caller's own table, see :mod:`larder.lookups`.
"""

from __future__ import annotations

# ---- fixed values: departments, in the order in which products are numbered --------------------
# department | weight | margin | cost low, mode, high | private-label rate | brands in the pool
DEPARTMENTS_TEXT = """
Fresh Produce   | 200 | 0.30 | 1.00 3.00 12.00  | 0.05 | 4
Bakery          | 120 | 0.32 | 2.00 4.50 10.00  | 0.30 | 5
Dairy           | 160 | 0.25 | 1.50 5.00 18.00  | 0.30 | 5
Meat & Seafood  | 120 | 0.28 | 5.00 12.00 45.00 | 0.15 | 5
Pantry          | 500 | 0.25 | 1.00 4.00 25.00  | 0.35 | 6
Frozen          | 160 | 0.28 | 2.50 7.00 18.00  | 0.32 | 5
Beverages       | 240 | 0.30 | 1.00 3.50 15.00  | 0.20 | 6
Alcohol         | 100 | 0.20 | 8.00 18.00 80.00 | 0.05 | 6
Health & Beauty | 240 | 0.40 | 2.00 8.00 40.00  | 0.18 | 5
Household       | 160 | 0.30 | 1.50 6.00 25.00  | 0.40 | 5
"""

# ---- fixed values: order in which equal remainders receive a spare row -------------------------
ALLOCATION_ORDER = (
    "Pantry", "Health & Beauty", "Beverages", "Fresh Produce", "Frozen",
    "Dairy", "Household", "Bakery", "Meat & Seafood", "Alcohol",
)

# ---- fixed values: department | category | subcategories ---------------------------------------
TAXONOMY_TEXT = """
Fresh Produce   | Fruit                | Tropical Fruit, Stone Fruit, Berries, Pome Fruit, Citrus
Fresh Produce   | Vegetables           | Leafy Greens, Root Vegetables, Cruciferous, Salad Vegetables, Squash & Pumpkin
Fresh Produce   | Herbs & Specialty    | Fresh Herbs, Asian Vegetables, Pre-cut Salads
Bakery          | Bread                | Sliced Bread, Rolls, Specialty Loaves, Wraps & Flatbreads
Bakery          | Sweet Baked          | Cakes, Pastries, Doughnuts
Bakery          | Savoury Baked        | Pies & Pasties, Sausage Rolls, Quiche
Dairy           | Milk                 | Full Cream, Reduced Fat, Plant-Based, Flavoured
Dairy           | Cheese               | Block Cheese, Sliced Cheese, Specialty Cheese
Dairy           | Yoghurt & Eggs       | Yoghurt, Eggs, Cream
Meat & Seafood  | Beef & Lamb          | Mince, Steaks, Roasts, Lamb Cuts
Meat & Seafood  | Poultry              | Chicken Breast, Chicken Whole, Turkey
Meat & Seafood  | Pork & Smallgoods    | Pork Cuts, Bacon, Ham, Sausages
Meat & Seafood  | Seafood              | Fresh Fish, Prawns, Shellfish
Pantry          | Pasta & Rice         | Dried Pasta, Fresh Pasta, Rice, Noodles
Pantry          | Cooking Essentials   | Oils & Vinegars, Sauces & Condiments, Spices & Seasonings, Stock & Broth
Pantry          | Baking               | Flour & Sugar, Baking Mixes, Decorating
Pantry          | Breakfast            | Cereals, Spreads, Muesli & Granola
Pantry          | Snacks               | Chips & Crisps, Biscuits, Confectionery, Nuts & Seeds
Frozen          | Frozen Meals         | Ready Meals, Pizza, Frozen Asian
Frozen          | Frozen Veg & Fruit   | Frozen Vegetables, Frozen Berries
Frozen          | Ice Cream & Desserts | Ice Cream Tubs, Ice Cream Sticks, Frozen Desserts
Beverages       | Soft Drinks          | Cola, Lemonade, Energy Drinks, Mixers
Beverages       | Hot Drinks           | Coffee, Tea, Hot Chocolate
Beverages       | Juice & Water        | Fruit Juice, Bottled Water, Sparkling Water
Alcohol         | Beer                 | Premium Lager, Mainstream Lager, Craft, Cider
Alcohol         | Wine                 | Red Wine, White Wine, Sparkling, Cask
Alcohol         | Spirits              | Whisky, Vodka, Gin, Rum
Health & Beauty | Personal Care        | Hair Care, Skin Care, Oral Care, Deodorant
Health & Beauty | Health               | Vitamins, Pain Relief, First Aid
Health & Beauty | Baby                 | Nappies, Baby Food, Baby Toiletries
Household       | Cleaning             | Surface Cleaners, Laundry, Dishwashing
Household       | Paper                | Toilet Paper, Paper Towel, Tissues
Household       | Kitchen              | Foil & Wraps, Storage Bags, Bin Liners
"""

# ---- fixed values: GST-free goods; "*" stands for the whole department -------------------------
GST_FREE_TEXT = """
Fresh Produce  | *
Meat & Seafood | *
Bakery         | Bread
Dairy          | Milk
Dairy          | Yoghurt & Eggs
Pantry         | Breakfast
"""

# ---- fixed values: perishable departments; category | shelf life in days | wastage rate --------
PERISHABLE_DEPARTMENTS = ("Fresh Produce", "Bakery", "Dairy", "Meat & Seafood", "Frozen")
SHELF_LIFE_TEXT = """
Bread                | 3   | 0.08
Sweet Baked          | 4   | 0.12
Savoury Baked        | 3   | 0.10
Milk                 | 10  | 0.05
Yoghurt & Eggs       | 14  | 0.04
Cheese               | 30  | 0.03
Beef & Lamb          | 5   | 0.04
Poultry              | 4   | 0.04
Pork & Smallgoods    | 7   | 0.05
Seafood              | 3   | 0.06
Ice Cream & Desserts | 180 | 0.02
"""

# ---- fixed values: season patterns, January first ----------------------------------------------
SEASON_TEXT = """
ice_cream | 1.6 1.6 1.4 1.0 0.7 0.5 0.5 0.6 0.9 1.2 1.4 1.7
soup      | 0.6 0.7 0.9 1.2 1.5 1.7 1.7 1.5 1.2 1.0 0.7 0.6
barbecue  | 1.6 1.5 1.3 1.0 0.7 0.6 0.6 0.7 0.9 1.2 1.4 1.7
easter    | 0.8 0.9 1.6 2.2 1.0 0.9 0.9 0.9 0.9 1.0 1.0 1.4
christmas | 0.9 0.9 0.9 0.9 0.9 0.9 0.9 1.0 1.1 1.2 1.4 2.2
"""

# ---- fixed values: curated fresh goods ---------------------------------------------------------
# category | subcategory | unit | pack | cost | shelf life | wastage | months (blank: wobble)
FRESH_TEXT = """
Fruit      | Tropical Fruit   | each | 1   | 1.80 | 7  | 0.08 | 1.6 1.8 1.4 0.6 0.3 0.2 0.2 0.2 0.4 0.8 1.4 1.8
Fruit      | Tropical Fruit   | kg   | 1   | 1.95 | 6  | 0.05 |
Fruit      | Berries          | pack | 250 | 2.40 | 4  | 0.12 | 0.6 0.5 0.4 0.4 0.5 0.6 0.7 1.0 1.5 1.8 1.6 1.2
Fruit      | Tropical Fruit   | each | 1   | 1.20 | 10 | 0.07 | 1.2 1.1 0.9 0.7 0.9 1.1 1.2 1.2 1.1 1.0 1.1 1.2
Fruit      | Pome Fruit       | kg   | 1   | 3.10 | 30 | 0.03 | 0.7 0.7 0.8 1.2 1.4 1.4 1.3 1.2 1.1 0.9 0.7 0.6
Fruit      | Pome Fruit       | kg   | 1   | 2.80 | 30 | 0.03 |
Fruit      | Stone Fruit      | kg   | 1   | 4.50 | 5  | 0.10 | 1.4 1.2 1.0 0.4 0.2 0.1 0.1 0.1 0.2 0.5 0.9 1.3
Fruit      | Stone Fruit      | pack | 500 | 8.00 | 4  | 0.15 | 2.4 1.0 0.2 0.1 0.05 0.05 0.05 0.05 0.1 0.4 1.6 3.0
Fruit      | Tropical Fruit   | kg   | 1   | 1.40 | 14 | 0.06 | 1.5 1.5 1.2 0.6 0.3 0.2 0.2 0.3 0.5 0.9 1.3 1.6
Vegetables | Salad Vegetables | kg   | 1   | 3.20 | 10 | 0.06 |
Vegetables | Leafy Greens     | each | 1   | 1.80 | 7  | 0.10 |
Vegetables | Salad Vegetables | kg   | 1   | 3.50 | 10 | 0.07 |
Vegetables | Salad Vegetables | each | 1   | 1.50 | 10 | 0.08 |
Vegetables | Root Vegetables  | kg   | 1   | 1.50 | 30 | 0.04 |
Vegetables | Root Vegetables  | kg   | 1   | 2.20 | 60 | 0.03 |
Vegetables | Root Vegetables  | kg   | 1   | 1.80 | 60 | 0.03 |
Vegetables | Cruciferous      | kg   | 1   | 4.00 | 7  | 0.10 | 0.5 0.6 0.8 1.0 1.4 1.5 1.5 1.4 1.2 1.0 0.7 0.5
Vegetables | Cruciferous      | each | 1   | 3.50 | 10 | 0.08 | 0.5 0.6 0.8 1.0 1.4 1.5 1.5 1.4 1.2 1.0 0.7 0.5
Vegetables | Squash & Pumpkin | kg   | 1   | 2.20 | 60 | 0.04 | 0.6 0.7 1.2 1.5 1.5 1.4 1.3 1.1 0.9 0.7 0.6 0.6
Vegetables | Salad Vegetables | pack | 250 | 4.50 | 4  | 0.18 | 0.3 0.3 0.3 0.3 0.3 0.3 0.4 0.7 1.5 2.0 1.8 1.0
"""
FRESH_PACKS = (0.5, 1.0, 1.5, 2.0)

# ---- fixed values: scalar rules ----------------------------------------------------------------
PRICE_ENDINGS = ("0.49", "0.79", "0.95", "0.99")
UNITS = ("each", "kg", "g", "L", "mL", "pack")
PRIVATE_LABEL_BRAND = "Generic"
PEAK_THRESHOLD = 1.2
SUPPLIER_POOL = 60
LITRE_PACKS = (0.5, 1.0, 1.25, 2.0)
MEAT_PACKS = (0.3, 0.4, 0.5, 1.0, 1.5)
CARE_PACKS = (100.0, 150.0, 200.0, 400.0, 500.0, 750.0, 1000.0)
PANTRY_PACKS = (200.0, 250.0, 375.0, 500.0, 750.0, 1000.0)
FROZEN_PACKS = (300.0, 400.0, 500.0, 600.0, 800.0)

# ---- own values: names follow a pattern --------------------------------------------------------
# Subcategories without a template are named after themselves.
PLAIN_SUBCATEGORIES = ("Fresh Pasta", "Decorating")
NAME_PATTERNS = ("Classic {}", "{} Select", "Family {}")


def _records(text: str) -> list[list[str]]:
    return [[cell.strip() for cell in line.split("|")] for line in text.strip().splitlines()]


def _numbers(cell: str) -> list[float]:
    return [float(x) for x in cell.split()]


def departments() -> list[dict]:
    out = []
    for pos, (name, weight, margin, cost, rate, pool) in enumerate(_records(DEPARTMENTS_TEXT)):
        low, mode, high = cost.split()
        cats = [r for r in _records(TAXONOMY_TEXT) if r[0] == name]
        out.append(
            {
                "dept_no": pos,
                "department": name,
                "alloc_no": ALLOCATION_ORDER.index(name),
                "weight": int(weight),
                "margin": margin,
                "cost_low": float(low),
                "cost_mode": float(mode),
                "cost_high": float(high),
                "private_label_rate": float(rate),
                "brands": [f"{name} Brand {i + 1}" for i in range(int(pool))],
                "n_categories": len(cats),
                "n_subcategories": sum(len(r[2].split(",")) for r in cats),
            }
        )
    return out


def taxonomy() -> list[dict]:
    """One row per subcategory, numbered within its category and within its department."""
    dept_no = {d["department"]: d["dept_no"] for d in departments()}
    out: list[dict] = []
    for cat_no, (department, category, subs) in enumerate(_records(TAXONOMY_TEXT)):
        for sub_no, sub in enumerate(s.strip() for s in subs.split(",")):
            out.append(
                {
                    "dept_no": dept_no[department],
                    "department": department,
                    "cat_id": cat_no,
                    "category": category,
                    "sub_no": sub_no,
                    "flat_no": sum(r["department"] == department for r in out),
                    "subcategory": sub,
                }
            )
    return out


def categories() -> list[dict]:
    """One row per category with its subcategories as an array."""
    dept_no = {d["department"]: d["dept_no"] for d in departments()}
    out: list[dict] = []
    for cat_id, (department, category, subs) in enumerate(_records(TAXONOMY_TEXT)):
        out.append(
            {
                "dept_no": dept_no[department],
                "department": department,
                "cat_id": cat_id,
                "cat_no": sum(r["department"] == department for r in out),
                "category": category,
                "subcategories": [s.strip() for s in subs.split(",")],
            }
        )
    return out


def gst_free() -> list[dict]:
    return [
        {"department": d, "category": None if c == "*" else c} for d, c in _records(GST_FREE_TEXT)
    ]


def shelf_life() -> list[dict]:
    return [
        {"category": c, "shelf_life_days": float(days), "wastage_rate": float(rate)}
        for c, days, rate in _records(SHELF_LIFE_TEXT)
    ]


def seasons() -> dict[str, list[float]]:
    return {name: _numbers(v) for name, v in _records(SEASON_TEXT)}


def fresh_goods() -> list[dict]:
    """Names are our own, by a pattern: the subcategory and a running number."""
    keys = ("category", "subcategory", "unit_of_measure")
    out = []
    for no, row in enumerate(_records(FRESH_TEXT)):
        rec = dict(zip(keys, row[:3], strict=True))
        rec.update(
            spec_no=no,
            name=f"{row[1]} No. {no + 1}",
            pack_size=float(row[3]),
            cost=row[4],
            shelf_life_days=float(row[5]),
            wastage_rate=float(row[6]),
            months=_numbers(row[7]) or None,
        )
        out.append(rec)
    return out


def name_templates() -> list[dict]:
    return [
        {
            "subcategory": r["subcategory"],
            "templates": [p.format(r["subcategory"]) for p in NAME_PATTERNS],
        }
        for r in taxonomy()
        if r["department"] != "Fresh Produce" and r["subcategory"] not in PLAIN_SUBCATEGORIES
    ]

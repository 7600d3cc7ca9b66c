"""Rules, word lists, patterns and limits that the operators take as defaults.

Everything a caller may want to change is an argument of the operator that uses it;
this module only holds the default values.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class GroupRule:
    """Settings of one product group."""

    product_group: str
    query_list: tuple[str, ...] = ()
    irrelevant_categories: tuple[str, ...] = ()
    required_image: bool = False
    exact_voltage: bool = False
    exact_amperage: bool = False
    high_volts_only: bool = False


@dataclass(frozen=True)
class RecallLists:
    """Known recalled ids, models and brands. All lists may be empty."""

    ids: tuple[str, ...] = ()
    models: tuple[str, ...] = ()
    brands: tuple[str, ...] = ()


# --- Fixed values: product groups --------------------------------------------------

GROUP_RULES: tuple[GroupRule, ...] = (
    GroupRule(
        "Group A",
        query_list=(
            "Apple Phone Plug Charger",
            "Huawei Phone Plug Charger",
            "Android Phone Plug Charger",
            "Ultrafast Phone Plug Charger",
            "E-Bike Charger",
            "E-Scooter Charger",
            "Plug-in chargers",
            "Plug in Air Purifier",
            "Laptop Charger",
        ),
        irrelevant_categories=(
            "Air Purifier Filters",
            "Bathroom Cleaning Brushes",
            "Bike Backpacks",
            "Bike Covers",
            "Cycling Glasses",
            "Cycling Taillights",
            "GPS Chargers & Adapters",
            "International Power Adapters",
            "Mobile Phone Anti-Dust Plugs",
            "Mobile Phone Automobile Chargers",
        ),
        required_image=True,
        exact_voltage=True,
    ),
    GroupRule(
        "Group B",
        query_list=("Extension lead", "Outdoor Extension lead", "Smart plug"),
        irrelevant_categories=(
            "Home Fragrance",
            "International Power Adapters",
            "Laptop Chargers & Power Supplies",
            "Mobile Phone Anti-Dust Plugs",
            "Mobile Phone Mains Chargers",
            "Power Monitors",
            "Power Toothbrush Chargers",
            "Radiators",
            "Robotic Lawn Mowers",
            "Scented Oil Diffusers",
            "Single Window Curtain Rods",
            "Smartwatch Screen Protectors & Foils",
            "Surface Mounted Cases",
            "Surface Mounted Junction Boxes",
            "Unknown",
            "USB Cables",
        ),
        required_image=True,
        exact_amperage=True,
    ),
    GroupRule(
        "Group C",
        query_list=(
            "Portable plug in immersion heater",
            "Mini plug in immersion heater",
            "Mini portable plug in immersion heater",
            "Waterproof speakers",
            "Outdoor Extension Lead",
        ),
        irrelevant_categories=("Radiators", "Unknown", "USB Cables"),
        exact_voltage=True,
        high_volts_only=True,
    ),
    GroupRule(
        "Group D",
        query_list=(
            "E-Bike Conversion Kit",
            "Desktop Electric Fan",
            "Electric Blanket",
            "Electronic Suitcase",
            "Air Fryer",
            "Drone",
            "Hair Dryer",
            "Electric Screwdriver",
            "Blender",
            "Mains Powered Alarm Clock",
            "Floor Standing Electric Fan",
            "Head Shaver",
            "Kettle",
            "Folding Electric Treadmill",
            "Steam Iron",
            "Desk Monitor",
            "Slow Cooker",
            "Rice Cooker",
            "Portable Charger",
            "Vacuum Cleaner",
            "Hair Straighteners",
            "Food Processor",
            "Electric Razor",
        ),
        irrelevant_categories=(
            "Action Camera Cases",
            "Bags, Covers & Cases",
            "Barbecuing & Grilling eBooks",
            "Bedding & Linens",
            "Bike Brakes",
            "Cable Organiser Bags",
            "Dancehall & Ragga",
            "Desks",
            "Doctor Playsets",
            "Drill Bit Sets",
            "Fashion",
            "Fish Scales",
            "Hair Dryer Holders",
            "Hard Drive Bags & Cases",
            "Laptop Backpacks",
            "Laptop Computer Stands",
            "Laptop Roller Cases",
            "Luggage Cosmetic Cases",
            "Monitor Accessories",
            "Music Stands",
            "Packing Organisers",
            "Screwdriver Bit Sets",
            "Suitcase Covers",
            "Toiletry Bags",
            "Tool Bags",
            "Unknown",
            "Wheelchair & Mobility Scooter Bags & Baskets",
            "Wheelchair & Mobility Scooter Cushions",
        ),
        exact_voltage=True,
        high_volts_only=True,
    ),
    GroupRule(
        "Group E",
        query_list=("Travel Adaptor", "Cable Reel"),
        irrelevant_categories=(
            "Agricultural Fencing",
            "Audio & Video Adapters",
            "Cable Insertion & Extraction Tools",
            "Cat 5e Ethernet Cables",
            "Cat 6 Ethernet Cables",
            "Cat 7 Ethernet Cables",
            "Coaxial Cables (Electronics & Photo)",
            "Digital Interface Cables",
            "Electrical Cable Wall Clips",
            "Electrical Wire",
            "Ethernet Cables",
            "Garage Wall Racks",
            "Garden Hose Reels",
            "Hi-Fi & Home Audio Cables",
            "Line Spooling Accessories",
            "Motorhome Parts & Accessories",
            "Patch Cables",
            "Phone Cables",
            "Speaker Cables",
            "Switches & Dimmers",
            "Unknown",
        ),
        required_image=True,
    ),
)

NO_RECALLS = RecallLists()

# --- Fixed values: words, tags, columns, limits --------------------------------------

DANGER_KEYWORDS = (
    "Defect", "Non-compliant", "Danger", "Injured", "Overheat", "Fire", "Hot",
    "Spark", "Burn", "Melt", "Exploded", "Arcing", "Arc", "Shock", "Electrocution",
    "Electric Shock", "Electrocute", "Short Circuit", "Smoke", "Toxic", "Harmful",
)

SOCKET_TAGS = (
    "Socket section/Aus-North America non-compliant",
    "Socket section/UK-German non-compliant",
)

PRODUCT_COLUMNS = (
    "product_id", "marketplace", "product_group", "title", "text", "url", "seller_id",
    "amperage_info", "voltage_info", "wattage_info", "query", "category", "manufacturer",
)

REPORT_COLUMNS = (
    "product_id", "marketplace", "product_group", "title", "seller_id", "url",
    "final_non_compliant", "voltage_info", "amperage_info", "wattage_info",
    "manufacturer", "adjusted_danger_score", "waterproof_flag", "ip_rating",
    "adjusted_ip_incompliance", "recalled_flag", "is_recall_brand",
    "Socket section/UK-German non-compliant",
    "Socket section/Aus-North America non-compliant",
)

MODEL_FEATURES = (
    "voltage_score", "amperage_score", "wattage_score", "is_recall_brand",
    "adjusted_danger_score",
)
MODEL_CLASSES = ("compliant", "non_compliant")
DROPPED_CLASSES = ("ambiguous", "irrelevant")

MAX_TEXT_CHARS = 10_000
MAX_IDS_PER_QUERY = 12
UPLOAD_BATCH = 64
TOP_QUERIES = 30
TEXT_THRESHOLD = 0.5
TAG_THRESHOLD = 0.9
IP_MOISTURE_MIN = 4
AMPERAGE_LIMIT = 13.0
WATTAGE_LIMIT = 3000.0


def load_group_rules(path: str) -> tuple[GroupRule, ...]:
    """Read group rules from a JSON or YAML file of ``{group: {setting: value}}``.

    Absent settings take the defaults of :class:`GroupRule`; unknown ones are an error.
    """
    with open(path, encoding="utf-8") as handle:
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as err:
                raise ImportError("YAML rules need the optional package PyYAML") from err
            raw = yaml.safe_load(handle)
        else:
            raw = json.load(handle)
    return tuple(
        GroupRule(
            group,
            **{k: tuple(v) if isinstance(v, list) else v for k, v in (settings or {}).items()},
        )
        for group, settings in raw.items()
    )


def blank_queries(rules: Iterable[GroupRule]) -> dict[str, list[str]]:
    """Problems of the query lists: groups without queries or with blank ones."""
    problems: dict[str, list[str]] = {}
    for rule in rules:
        blank = [q for q in rule.query_list if not isinstance(q, str) or not q.strip()]
        if blank or not rule.query_list:
            problems[rule.product_group] = blank
    return problems


def check_queries(rules: Iterable[GroupRule]) -> None:
    """Raise when a group has an empty query list or a blank query."""
    problems = blank_queries(rules)
    if problems:
        raise ValueError(f"query lists must be non-empty and without blanks: {problems}")

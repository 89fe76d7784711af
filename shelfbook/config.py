"""Fixed business values and the settings of the three item populations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

# ---- Fixed values: they must equal the codes found in the source systems. ----

EXCLUDED_CODES = (
    "00000000000010199940", "00000000000010199941", "00000000000010199942", "00000000000010199943",
    "00000000000010199944", "00000000000010199945", "00000000000010199946", "00000000000010199947",
    "00000000000010199938", "00000000000010199939", "00000000000010211475", "00000000000010211476",
    "00000000000010200071", "00000000000010200072", "00000000000010200073",
    "00000000000010200074",
    "00000000000010051490", "00000000000010196953", "00000000000010200047",
)
EXCLUDED_PRODUCT_TYPES = ("HPBP", "PRMO", "CHA", "PGC", "EGC")
EXCLUDED_TAG = "SUP"
EXCLUDED_PURCHASE_VENDOR = "WHPBSUPPLY"
KEPT_PURCHASE_VENDORS = ("IDTXBKSTAP", "TEXASBKNON")
KEPT_VENDORS = ("IDTXBKSTAP", "IDPOLLOCKP")

PULL_SECTIONS = (
    "BLANK", "BOOKLIGHT", "BOOKMARK", "HEADPHONES", "NOTECARDS",
    "PUZZLES", "EYEGLASSES", "METALSIGNS", "DRINKWARE", "PLUSH",
)
REORDER_TAG = "TTB"
REORDER_VENDORS = ("TEXASBKMNA", "TEXASBKMNB", "TEXASBKNON", "TEXASSTATI")
MORE_REORDER_VENDORS = ("TEXASBKPUZ", "TEXASBKUPC")
GROUP_VENDORS = (
    "IDAURORA", "IDBENDONPU", "IDBKSALESI", "IDBOOKDEPO", "IDBRYBELLY", "IDC&DVISIO", "IDCRAZART",
    "IDCROWNB&C", "IDCROWNPOI", "IDCUDDLEBA", "IDEUROGRA", "IDFOUNDIMG", "IDIGLOOBOO", "IDKALANLPT",
    "IDKIKKERLA", "IDLBMAYASS", "IDMELISSA&", "IDMODERNPU", "IDNOSTIMAG", "IDOUTOFPRI", "IDPEEPERS",
    "IDSALESCOR", "IDTOYSMITH", "IDUNEMPLOY", "IDUSPLAYIN", "IDWISHPETS", "IFDISCONFO", "IFPROPERRE",
)

# Corrections by hand, in order; a later one wins. (codes, item or None, reporting item or None)
OVERRIDES = (
    (("00000000814229022213",), None, "00000000000010199979"),
    (("00000000713755003560",), "00000000000010086153", None),
    (("00000000000000202614", "00000000000000202626"), "00000000000000178790", None),
    (
        (
            "00000000000001703280", "00000000000001703279", "00000000000001703274", "00000000000001703273",
            "00000000830395033525", "00000000830395033518", "00000000830395033495", "00000000830395033501",
        ),
        "00000000000001404029",
        "00000000000001404029",
    ),
)

PUSH_TYPES = ("HPB Asso", "HPB Titl", "TTB Init", "TITLES")
PULL_TYPES = ("HPB REOR", "TTB REOR")
WHOLESALE_TYPES = ("TTB WHOL", "WEBORDER")

WAREHOUSE = "00944"
FIRST_UPC_CODE = "00000000000050000000"
CENTRE_OPENED = datetime(2010, 7, 1)
TRANSIT_KNOWN_AFTER = datetime(2010, 6, 1)
TRANSFER_CODES: Mapping[int, str] = {
    1: "Tsh", 2: "Dnt", 3: "StSo", 4: "Bsm", 5: "Mkt", 6: "vRtn", 7: "Dmg",
}
FIRST_OUTLET = "00150"

# ---- Settings ----


@dataclass(frozen=True)
class ExcludeRule:
    codes: Sequence[str] = EXCLUDED_CODES
    product_types: Sequence[str] = EXCLUDED_PRODUCT_TYPES
    tag: str = EXCLUDED_TAG
    purchase_vendor: str = EXCLUDED_PURCHASE_VENDOR
    kept_purchase_vendors: Sequence[str] = KEPT_PURCHASE_VENDORS
    kept_vendors: Sequence[str] = KEPT_VENDORS


@dataclass(frozen=True)
class ItemRule:
    """An item belongs if any of the given conditions holds."""

    sections: Sequence[str] = ()
    purchase_vendors: Sequence[str] = ()
    recent_tag: str | None = None
    recent_days: int = 367
    either_vendors: Sequence[str] = ()


@dataclass(frozen=True)
class Window:
    """Load window [start, end); ``start`` None means that only new items are loaded."""

    start: datetime | None
    end: datetime


@dataclass(frozen=True)
class LedgerConfig:
    items: ItemRule
    exclude: ExcludeRule = field(default_factory=ExcludeRule)
    overrides: Sequence[tuple] = OVERRIDES
    not_in_population: str | None = None  # items of this population are left to it
    active_stores_only: bool = False
    archives_in_order_types: int = 2
    window_policy: str = "two_days"  # two_days | since_last_update | last_week
    item_in_key: bool = True


GENERAL = LedgerConfig(
    ItemRule(PULL_SECTIONS, REORDER_VENDORS + MORE_REORDER_VENDORS, REORDER_TAG, either_vendors=GROUP_VENDORS)
)
NEW_GOODS = LedgerConfig(
    ItemRule(PULL_SECTIONS, REORDER_VENDORS, REORDER_TAG),
    active_stores_only=True,
    archives_in_order_types=1,
    item_in_key=False,
)
VENDOR_GROUP = LedgerConfig(
    ItemRule(either_vendors=GROUP_VENDORS),
    not_in_population="new_goods",
    active_stores_only=True,
    window_policy="since_last_update",
)


def day_start(moment: datetime | date) -> datetime:
    return datetime(moment.year, moment.month, moment.day)


def fixed_window(policy: str, as_of: datetime) -> Window:
    """Windows that depend on the run date alone."""
    today = day_start(as_of)
    if policy == "two_days":
        return Window(today - timedelta(days=2), today)
    if policy == "last_week":  # Sunday to Sunday
        end = today - timedelta(days=(today.weekday() + 1) % 7)
        return Window(end - timedelta(days=7), end)
    raise ValueError(f"unknown window policy {policy!r}")

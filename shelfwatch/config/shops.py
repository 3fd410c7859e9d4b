"""One entry per shop that takes part in the combined table."""

from __future__ import annotations

from dataclasses import dataclass, field

from shelfwatch.config import classes as C
from shelfwatch.schema import KID, MAN, WOMAN


@dataclass(frozen=True)
class Shop:
    name: str
    genders: dict[str, str] = field(default_factory=dict)
    men: tuple[C.ClassRule, ...] = field(default_factory=C.men_words)
    women: tuple[C.ClassRule, ...] = field(default_factory=C.women_words)
    shift_root: str | None = None
    price_divisor: int = 1
    needs_name: bool = False


# Each shop's words for the genders, and which prices are pence. Other roots
# (home, gifts, sale ...) need no entry, as only MAN and WOMAN reach the combined table.
# John Lewis is collected but takes no part in the combined table.
AGGREGATED = (
    Shop("ASOS", {"men": MAN, "women": WOMAN}, C.ASOS_MEN, C.ASOS_WOMEN),
    Shop("HM", {"men": MAN, "ladies": WOMAN, "kids": KID}, C.HM_MEN, C.HM_WOMEN),
    Shop("MS", {"men": MAN, "women": WOMAN, "kids": KID}),
    Shop("NEWLOOK", {"mens": MAN, "womens": WOMAN, "girls": KID}),
    Shop("GAP", {"men": MAN, "women": WOMAN, "girls": KID, "boys": KID}, shift_root="gap"),
    Shop("PRIMARK", {"men": MAN, "women": WOMAN, "kids": KID}, C.PRIMARK_MEN, C.PRIMARK_WOMEN,
         price_divisor=100, needs_name=True),
    Shop("TKMAXX", {
        "men": MAN,
        "mens-contemporary-designers": MAN,
        "mens-mod-box": MAN,
        "mens-gold-label": MAN,
        "mens-early-access": MAN,
        "women": WOMAN,
        "womens-contemporary-designers": WOMAN,
        "womens-plus-size": WOMAN,
        "womens-gold-label": WOMAN,
        "womens-mod-box": WOMAN,
        "womens-early-access": WOMAN,
        "kids": KID,
    }),
    Shop("ZARA", price_divisor=100, needs_name=True),
)

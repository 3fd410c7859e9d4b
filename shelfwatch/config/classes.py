"""Common taxonomy and the rules that map each shop's own names and categories to it."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: common taxonomy ----------------------------------------------------------

SWEATSHIRT = "SWEATSHIRT"
JACKET = "JACKET/COAT"
SHIRT = "SHIRT"
TSHIRT = "TSHIRT"
JEANS = "JEANS"
DRESS = "DRESS"
SKIRTS = "SKIRTS"

PARENT = {
    SWEATSHIRT: "TOP",
    JACKET: "TOP",
    SHIRT: "TOP",
    TSHIRT: "TOP",
    JEANS: "BOTTOM",
    DRESS: "BOTTOM",
    SKIRTS: "BOTTOM",
}


@dataclass(frozen=True)
class ClassRule:
    """All given conditions must hold. Rules are ordered and the last one that holds wins.

    ``words``/``without`` look into the lower-cased name, the rest compares source levels as is.
    """

    label: str
    words: tuple[str, ...] = ()
    without: tuple[str, ...] = ()
    taxo2: str | None = None
    taxo3: tuple[str, ...] = ()
    taxo3_not: str | None = None


def men_words(fix_exclusion: bool = False, fix_waistcoat: bool = False) -> tuple[ClassRule, ...]:
    """Name rules for men. By default the blank-t-blank exclusion of SHIRT is off and the
    waistcoat exclusion is spelt "waiscoat", which is what the tracked history was built with."""
    shirt_without = (" t ", "polo") if fix_exclusion else ("polo",)
    coat_without = "waistcoat" if fix_waistcoat else "waiscoat"
    # fixed values
    return (
        ClassRule(TSHIRT, (" t-shirt",)),
        ClassRule(TSHIRT, (" t shirt",)),
        ClassRule(SHIRT, (" shirt",), shirt_without),
        ClassRule(JACKET, ("jacket",)),
        ClassRule(JACKET, ("coat",), (coat_without,)),
        ClassRule(SWEATSHIRT, ("sweatshirt",)),
        ClassRule(SWEATSHIRT, ("sweater",)),
        ClassRule(SWEATSHIRT, ("hoodie",)),
        ClassRule(JEANS, ("jeans",)),
    )


def women_words(fix_waistcoat: bool = False) -> tuple[ClassRule, ...]:
    """Name rules for women."""
    coat_without = "waistcoat" if fix_waistcoat else "waiscoat"
    # fixed values
    return (
        ClassRule(SWEATSHIRT, ("sweatshirt",)),
        ClassRule(SWEATSHIRT, ("sweater",)),
        ClassRule(SWEATSHIRT, ("hoodie",)),
        ClassRule(SHIRT, (" shirt",)),
        ClassRule(SHIRT, ("blouse",)),
        ClassRule(SHIRT, (" t-shirt",)),
        ClassRule(SHIRT, (" t shirt",)),
        ClassRule(JACKET, ("jacket",)),
        ClassRule(JACKET, ("coat",), (coat_without,)),
        ClassRule(SKIRTS, ("skirt",)),
        ClassRule(DRESS, ("dress",)),
        ClassRule(JEANS, ("jeans",)),
    )


# --- fixed values: exact rules per shop -----------------------------------------------------

ASOS_MEN = (
    ClassRule(TSHIRT, taxo2="t-shirts-vests"),
    ClassRule(SHIRT, taxo2="shirts"),
    ClassRule(JACKET, taxo2="jackets-coats"),
    ClassRule(SWEATSHIRT, taxo2="hoodies-sweatshirts"),
    ClassRule(JEANS, taxo2="jeans"),
)
ASOS_WOMEN = (
    ClassRule(SWEATSHIRT, taxo2="tops", taxo3=("sweatshirts",)),
    ClassRule(SHIRT, taxo2="tops", taxo3=(
        "shirts", "casual-shirts", "shirts-blouses", "check-shirts", "denim-shirts",
    )),
    ClassRule(JACKET, taxo2="coats-jackets"),
    ClassRule(SKIRTS, taxo2="skirts"),
    ClassRule(DRESS, taxo2="dresses"),
    ClassRule(JEANS, taxo2="jeans"),
)
HM_MEN = (
    ClassRule(TSHIRT, taxo2="t-shirts-and-vests", taxo3_not="polo"),
    ClassRule(SHIRT, taxo2="shirts"),
    ClassRule(JACKET, taxo2="jackets-and-coats"),
    ClassRule(SWEATSHIRT, taxo2="hoodies-and-sweatshirts"),
    ClassRule(JEANS, taxo2="jeans"),
)
HM_WOMEN = (
    ClassRule(SWEATSHIRT, taxo2="hoodies-sweatshirts"),
    ClassRule(SHIRT, taxo2="shirts-and-blouses"),
    ClassRule(JACKET, taxo2="jackets-and-coats"),
    ClassRule(SKIRTS, taxo2="skirts"),
    ClassRule(DRESS, taxo2="dresses"),
    ClassRule(JEANS, taxo2="jeans"),
)
PRIMARK_MEN = (
    ClassRule(TSHIRT, taxo2="T-Shirts"),
    ClassRule(SHIRT, taxo2="Shirts"),
    ClassRule(JACKET, taxo2="Coats & Jackets"),
    ClassRule(SWEATSHIRT, taxo2="Hoodies & Sweatshirts"),
    ClassRule(JEANS, taxo2="Jeans"),
)
PRIMARK_WOMEN = (
    ClassRule(SWEATSHIRT, words=("hoody", "sweatshirt")),
    ClassRule(SHIRT, words=(" shirt", " blouse"), taxo2="Tops"),
    ClassRule(JACKET, taxo2="Coats & Jackets"),
    ClassRule(SKIRTS, taxo2="Skirts"),
    ClassRule(DRESS, taxo2="Dresses"),
    ClassRule(JEANS, taxo2="Jeans"),
)

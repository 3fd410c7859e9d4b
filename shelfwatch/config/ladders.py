"""Ranking rules per shop: which of several listings of one product is the best classified."""

from __future__ import annotations

from shelfwatch.functions.conditions import (
    EQUAL,
    IN,
    IS_NUMBER,
    START_WITH,
    Bucket,
    Ladder,
    Test,
)

# --- fixed values -------------------------------------------------------------------------

ASOS_CLEAR = (
    Test("taxo2", IN, (
        "accessories", "coats-jackets", "dresses", "hoodies-sweatshirts", "jackets-coats",
        "jeans", "jumpers-cardigans", "jumpsuits-playsuits", "lingerie-nightwear",
        "polo-shirts", "shirts", "shoes", "shoes-boots-trainers", "shorts", "skirts",
        "socks-tights", "suits", "suits-separates", "swimwear-beachwear", "tops",
        "tracksuits", "trousers-chinos", "trousers-leggings", "t-shirts-vests",
        "underwear-socks", "vests", "goingout", "petite", "tall",
    )),
)
ASOS_VAGUE = (
    Test("taxo2", IN, ("ctas", "living-gifts", "outlet", "sale")),
    Test("taxo3", IN, ("ctas", "None")),
)
ASOS_BANNER = (
    Test("taxo2", IN, ("ctas",)),
    Test("taxo3", IN, ("ctas",)),
)
HM_SPECIAL = (
    Test("taxo2", IN, (
        "extended size", "extendedsize", "plus sizes", "maternity wear_maternity wear",
        "nightwear_nightwear", "EXTENDEDSIZES_EXTENDEDSIZES",
    )),
    Test("taxo3", IN, ("VIEWALL_VIEW_ALL",)),
)
HM_BROAD = (Test("taxo2", IN, ("bottom", "TOPS_VIEW_ALL")),)
NEWLOOK_VAGUE = (
    Test("taxo2", EQUAL, ("goingout", "maternity", "curves", "petite", "tall")),
    Test("taxo3", EQUAL, (
        "brands", "collection", "department", "viewall", "image", "petite", "tall", "curves",
        "dept", "oc", "newin", "collections", "departmentt", "", "knitwear",
    )),
    Test("taxo4", EQUAL, (
        "category:uk-mens", "category:uk-womens", "category:uk-teens", "nan",
        "category:uk-mens-clothing", "category:uk-mens-footwear", "category:uk-teens-clothing",
        "category:uk-womens-clothing",
    )),
)
NEWLOOK_ROOT = (
    Test("taxo4", EQUAL, (
        "category:uk-mens", "category:uk-womens", "category:uk-teens", "nan",
        "category:uk-mens-clothing", "category:uk-mens-footwear",
    )),
)
ZARA_CAMPAIGN = (
    Test("taxo2", IN, (
        "FROM ", "Shoes | Bags", "NEW IN", "Collection", "Basics", "DRESS TIME", "JOIN LIFE",
        "MUM", "MUST HAVE", "None", "KNITWEAR", "Flats", " OFF",
    )),
)
ZARA_VIEW_ALL = (Test("taxo3", EQUAL, ("View All",)),)
ZARA_CATEGORY = (
    Test("taxo2", IN, (
        "ACCESSORIES", "BLAZERS", "COATS", "DRESSES", "JACKETS", "JEANS", "KNITWEAR", "POLOS",
        "SHIRTS", "SHIRTS | BLOUSES", "SHOES ", "SKIRTS", "SHORTS", "SUITS", "SWEATSHIRTS",
        "TROUSERS", "T-SHIRTS",
    )),
)
TKMAXX_NUMERIC = (Test("taxo3", IS_NUMBER),)
TKMAXX_VAGUE = (
    Test("taxo2", EQUAL, ("c", "biggest-savings", "clothing", "big-brand-delivery", "last-chance")),
    Test("taxo3", EQUAL, ("c", "clothing", "new-in-boys")),
)
GAP_SALE = (
    Test("taxo1", EQUAL, ("sale", "deals", "new-and-now")),
    Test("taxo2", START_WITH, ("last-", "up-to-", "sale", "deals", "new-and-now")),
    Test("taxo3", START_WITH, ("last-", "up-to-")),
)
GAP_NEW = (
    Test("taxo2", IN, (
        "new-and-now", "special-sizes", "featured-shops", "gapbody", "the-schoolwear-shop",
    )),
)

# --- ladders ------------------------------------------------------------------------------

PRODUCT_LADDERS = {
    "ASOS": Ladder(
        (Bucket(ASOS_CLEAR, True, 0), Bucket(ASOS_VAGUE, False, 1), Bucket(ASOS_BANNER, False, 2)),
        last=3,
    ),
    "HM": Ladder((Bucket(HM_SPECIAL, True, 2), Bucket(HM_BROAD, True, 1)), last=0),
    "NEWLOOK": Ladder((Bucket(NEWLOOK_VAGUE, False, 0), Bucket(NEWLOOK_ROOT, False, 1)), last=2),
    "ZARA": Ladder((Bucket(ZARA_CAMPAIGN, True, 2), Bucket(ZARA_VIEW_ALL, True, 1)), last=0),
    "TKMAXX": Ladder((Bucket(TKMAXX_NUMERIC, True, 2), Bucket(TKMAXX_VAGUE, True, 1)), last=0),
}
CATEGORY_LADDERS = {
    "GAP": Ladder((Bucket(GAP_SALE, True, 2), Bucket(GAP_NEW, True, 1)), last=0),
    "ZARA": Ladder((Bucket(ZARA_CATEGORY, True, 0),), last=1),
}

# Shops whose clean step only orders the rows and keeps every listing.
KEEP_ALL_LISTINGS = ("HM",)

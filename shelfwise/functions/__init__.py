"""Column functions: pure ``Column -> Column`` Catalyst expressions."""

from shelfwise.functions.dates import batch_id_of, calendar_columns, parse_batch_date
from shelfwise.functions.money import (base_discount_pct, card_discount_pct, card_price,
                                       money_round, pct_of)
from shelfwise.functions.nested import (best_discount, category_levels, channel,
                                        delivery_flags, first_item, first_seller,
                                        label_flags, offer_of, seller_name, sku)
from shelfwise.functions.text import (bundle_pattern, clean_upper, fold_accents,
                                      is_bundle_name, is_yes, normalize_key, slugify)
from shelfwise.functions.util import as_col, first

__all__ = [
    "as_col", "base_discount_pct", "batch_id_of", "best_discount", "bundle_pattern",
    "calendar_columns", "card_discount_pct", "card_price", "category_levels", "channel",
    "clean_upper", "delivery_flags", "first", "first_item", "first_seller", "fold_accents",
    "is_bundle_name", "is_yes", "label_flags", "money_round", "normalize_key", "offer_of",
    "parse_batch_date", "pct_of", "seller_name", "sku", "slugify",
]

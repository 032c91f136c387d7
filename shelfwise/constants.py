"""Fixed values of the retail catalogue domain.

These literals must equal the source system's vocabulary for results to be
right; they are kept here together, in their natural order, as plain text.
"""

# --- fixed values -----------------------------------------------------------

# Raw landing keys that differ only by case, mapped to their own column names.
KEY_OVERRIDES = {
    "Tipo De Producto": "tipo_especifico_producto",
    "Tipo de Producto": "canal_venta",
}

# Words that mark promotional bundles in a product name (unanchored match).
BUNDLE_WORDS = ["pack", "combo", "promo", "llévate", "lleva"]
# Top-level category that holds bundles.
BUNDLE_CATEGORIES = ["Packs"]

# Sales channels kept in the snapshot, and the default for a missing channel.
VALID_CHANNELS = ["SUPERMERCADO", "SELLERCENTER"]
DEFAULT_CHANNEL = "SUPERMERCADO"

# Seller placeholder values that fall back to the offer's seller name.
SELLER_PLACEHOLDERS = ["marcas aliadas", "", "none"]
# SKU placeholder values that fall back to the item id.
SKU_PLACEHOLDERS = ["", "-"]

# Promotion teaser parameter that carries the card discount amount.
DISCOUNT_PARAMETER = "PromotionalPriceTableItemsDiscount"

# Nutritional warning labels tracked by the label dimension.
LABEL_SODIUM = "altoensodio"
LABEL_SUGAR = "altoenazucar"
LABEL_SATURATED = "altoengrasassaturadas"
# Label counts pre-filled in the junk dimension (0 to 3 labels).
LABEL_COUNTS = [0, 1, 2, 3]

# Delivery values.
YES_VALUES = ["Si", "Sí"]
HOME_DELIVERY = "Despacho a domicilio"
STORE_PICKUP = "Recojo en tienda"

# Batch states of the control table.
STATUS_IN_PROGRESS = "IN_PROGRESS"
STATUS_COMPLETED = "COMPLETED"
STATUS_FAILED = "FAILED"

# Churn tags.
TAG_NEW = "Nuevo"
TAG_GONE = "Descontinuado"

# Stock-state labels.
STATE_INVALID_PRICE = "Precio invalido"
STATE_UNAVAILABLE = "Producto no disponible"
STATE_AVAILABLE = "Producto disponible"

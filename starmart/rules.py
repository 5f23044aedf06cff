"""Field rules per source entity. Order matters: reasons are reported in this order."""

from __future__ import annotations

from dataclasses import dataclass

from starmart.functions.text import SPACE


@dataclass(frozen=True)
class Rule:
    name: str           # flattened name, as it appears in reasons
    kind: str           # int, float, str, datetime or list
    path: str           # where the value sits in the record
    required: bool = True
    above: int | None = None
    at_least: int | None = None
    at_most: int | None = None
    pattern: str | None = None


# One @, text on both sides, a dot in the domain.
EMAIL = rf"^[^@{SPACE}]+@[^@{SPACE}]+\.[^@{SPACE}]+$"

# The rule catalogs.
PRODUCT_RULES = [
    Rule("id", "int", "$.id", above=0),
    Rule("title", "str", "$.title"),
    Rule("price", "float", "$.price", above=0),
    Rule("category", "str", "$.category"),
    Rule("description", "str", "$.description", required=False),
    Rule("image", "str", "$.image", required=False),
    Rule("rating_rate", "float", "$.rating.rate", required=False, at_least=0, at_most=5),
    Rule("rating_count", "int", "$.rating.count", required=False, at_least=0),
]

USER_RULES = [
    Rule("id", "int", "$.id", above=0),
    Rule("email", "str", "$.email", pattern=EMAIL),
    Rule("username", "str", "$.username"),
    Rule("name_firstname", "str", "$.name.firstname"),
    Rule("name_lastname", "str", "$.name.lastname"),
    Rule("phone", "str", "$.phone", required=False),
    Rule("address_city", "str", "$.address.city"),
    Rule("address_street", "str", "$.address.street", required=False),
    Rule("address_number", "int", "$.address.number", required=False),
    Rule("address_zipcode", "str", "$.address.zipcode", required=False),
    Rule("address_geolocation_lat", "float", "$.address.geolocation.lat", required=False, at_least=-90, at_most=90),
    Rule("address_geolocation_long", "float", "$.address.geolocation.long", required=False, at_least=-180, at_most=180),
]

CART_RULES = [
    Rule("id", "int", "$.id", above=0),
    Rule("userId", "int", "$.userId", above=0),
    Rule("date", "datetime", "$.date"),
    Rule("products", "list", "$.products"),
]

# A line's own fields. Its cart_id, user_id and order_date come from a valid cart, where the
# same rules have already held.
LINE_RULES = [
    Rule("product_id", "int", "$.productId", above=0),
    Rule("quantity", "int", "$.quantity", above=0),
]

RULES = {"products": PRODUCT_RULES, "users": USER_RULES, "carts": CART_RULES, "cart_items": LINE_RULES}
ENTITY_KEYS = {
    "products": ["id"], "users": ["id"], "carts": ["id"], "cart_items": ["cart_id", "product_id"],
}
# Sources that may be empty, and fields that never reach storage.
MAY_BE_EMPTY = {"products": False, "users": False, "carts": True}
SECRET_FIELDS = ["password"]

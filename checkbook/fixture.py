"""Deliveries with known defects, derived from the driver's tables by key.

Each field lists (condition, JSON token, expected reason) in order; the first condition that
holds decides, else the default token stands. The SQL text is plain enough for Spark and DuckDB
alike, so both sides see the same records, while the expected reasons are stated here and not
computed by the engine. k is the table's key, c is 1 for the extra copy that some records get.
"""

from __future__ import annotations


def text(sql: str) -> str:
    """SQL for a JSON string token around a SQL string expression."""
    return f"'\"' || {sql} || '\"'"


def num(sql: str) -> str:
    return f"cast({sql} as string)"


PRICE = "cast((p_retailprice - 899) * 1.5 as decimal(10,2))"

# entity -> field path -> ([(condition, token, reason)], default token); a null token leaves the field out
FIELDS = {
    "products": {
        "id": ([
            ("c = 0 AND k % 79 = 3", "'\"abc\"'", "invalid_type:id(expected int)"),
            ("c = 0 AND k % 83 = 4", "'true'", "invalid_type:id(expected int)"),
            ("c = 0 AND k % 89 = 5", "'0'", "out_of_range:id(must be > 0)"),
            ("k % 23 = 6", text(num("k + 1")), None),
        ], num("k + 1")),
        "title": ([
            ("c = 1", text("p_name || ' again'"), None),
            ("k % 37 = 3", "null", "missing_required:title"),
            ("k % 41 = 4", "'5'", "invalid_type:title(expected str)"),
        ], text("'  ' || p_name || '   ' || p_brand || ' '")),
        "price": ([
            ("c = 1", num(PRICE), None),
            ("k % 43 = 5", "'\"not-a-number\"'", "invalid_type:price(expected float)"),
            ("k % 47 = 6", "'-5'", "out_of_range:price(must be > 0)"),
            ("k % 101 = 7", "'null'", "missing_required:price"),
            ("k % 31 = 2", "'\"19.99\"'", None),
        ], num(PRICE)),
        "category": ([
            ("c = 0 AND k % 67 = 1", "'\"   \"'", "missing_required:category"),
            ("k % 2 = 0", text("lower(p_type) || '  goods'"), None),
        ], text("p_type || ' Goods'")),
        "description": ([("k % 13 = 0", "null", None)], text("' About ' || p_name || ' '")),
        "image": ([("k % 17 = 0", "'null'", None)], text(f"'http://img/' || {num('k')} || '.png'")),
        "rating.rate": ([
            ("c = 0 AND k % 29 = 1 AND k % 103 <> 9", "'7'", "out_of_range:rating_rate(must be <= 5)"),
            ("p_size % 13 = 0", "'null'", None),
        ], f"{num('cast(floor(p_size / 10.0) as int)')} || '.' || {num('p_size % 10')}"),
        "rating.count": ([
            ("c = 0 AND k % 73 = 2 AND k % 103 <> 9", "'2.5'", "invalid_type:rating_count(expected int)"),
            ("c = 0 AND k % 97 = 3 AND k % 103 <> 9", "'-1'", "out_of_range:rating_count(must be >= 0)"),
        ], num("k % 500")),
    },
    "users": {
        "id": ([("c = 0 AND k % 107 = 12", "'-4'", "out_of_range:id(must be > 0)")], num("k + 1")),
        "email": ([
            ("c = 0 AND k % 53 = 3", "'\"no-at-sign\"'", "invalid_format:email"),
            ("c = 0 AND k % 59 = 4", "null", "missing_required:email"),
            ("c = 0 AND k % 61 = 5", "'\"a b@c.d\"'", "invalid_format:email"),
        ], text("' ' || replace(c_name, '#', '') || '@' || c_mktsegment || '.com '")),
        "username": ([("c = 0 AND k % 101 = 6", "'\"\"'", "missing_required:username")],
                     text(f"' User' || {num('k')} || ' '")),
        "password": ([], "'\"s3cret\"'"),
        "name.firstname": ([
            ("c = 0 AND k % 109 = 13", "null", "missing_required:name_firstname"),
            ("c = 0 AND k % 67 = 6", "'\"  \"'", "missing_required:name_firstname"),
        ], text("lower(c_mktsegment) || '  the'")),
        "name.lastname": ([("c = 0 AND k % 109 = 13", "null", "missing_required:name_lastname")],
                          text(f"'van  der ' || {num('k')}")),
        "phone": ([("k % 7 = 0", "null", None)], text(f"' 1-' || {num('k')}")),
        "address.city": ([("c = 0 AND k % 71 = 7", "'\" \"'", "missing_required:address_city")],
                         text("'old  ' || lower(n_name)")),
        "address.street": ([("k % 19 = 0", "'null'", None)], text("' old  mill road '")),
        "address.number": ([
            ("c = 0 AND k % 79 = 9", "'\"12a\"'", "invalid_type:address_number(expected int)"),
            ("k % 11 = 0", "null", None),
        ], num("k % 1000")),
        "address.zipcode": ([], text(f"{num('k % 99')} || '-1'")),
        "address.geolocation.lat": ([
            ("c = 0 AND k % 73 = 8", "'\"91.5\"'", "out_of_range:address_geolocation_lat(must be <= 90)"),
            ("c = 0 AND k % 83 = 1", "'\"abc\"'", "invalid_type:address_geolocation_lat(expected float)"),
        ], text(f"{num('k % 90')} || '.25'")),
        "address.geolocation.long": ([
            ("c = 0 AND k % 103 = 2", "'\"-180.5\"'", "out_of_range:address_geolocation_long(must be >= -180)"),
        ], text(f"'-' || {num('k % 180')} || '.5'")),
    },
    "carts": {
        "id": ([], num("k + 1")),
        "userId": ([
            ("c = 0 AND k % 107 = 2", "'0'", "out_of_range:userId(must be > 0)"),
            ("c = 0 AND k % 109 = 3", "'999999999'", None),
        ], num("o_custkey + 1")),
        "date": ([
            ("c = 0 AND k % 103 = 1", "'\"yesterday\"'", "invalid_type:date(expected datetime)"),
            ("k % 3 = 0", text("cast(cast(o_orderdate as date) as string) || 'T23:30:00.000Z'"), None),
            ("k % 3 = 1", text("cast(cast(o_orderdate as date) as string)"), None),
        ], text("cast(cast(o_orderdate as date) as string) || 'T23:30:00-05:00'")),
        "products": ([
            ("c = 1", "'[{\"productId\":1,\"quantity\":1}]'", None),
            ("k % 101 = 0 OR line_texts IS NULL", "'[]'", "missing_required:products"),
        ], "'[' || line_texts || ']'"),
    },
    "cart_items": {
        "productId": ([
            ("l_partkey % 87 = 7 OR l_partkey % 89 = 1", "'null'", "missing_required:product_id"),
        ], num("l_partkey + 1")),
        "quantity": ([
            ("l_partkey % 87 = 7", "'null'", "missing_required:quantity"),
            ("l_partkey % 97 = 0", "'0'", "out_of_range:quantity(must be > 0)"),
            ("l_partkey % 83 = 2", "'\"x\"'", "invalid_type:quantity(expected int)"),
            ("l_partkey % 79 = 3", "'2.5'", "invalid_type:quantity(expected int)"),
        ], num("cast(l_quantity as int)")),
    },
}

# Records that are not objects at all, and fields of objects left out as a whole.
SHAPES = {
    "products": [("c = 0 AND k % 53 = 7", "'\"junk\"'"), ("c = 0 AND k % 59 = 8", "'42'"), ("c = 0 AND k % 61 = 9", "'null'")],
    "users": [("c = 0 AND k % 89 = 10", "'[1]'")],
    "carts": [("c = 0 AND k % 113 = 4", "'\"junk\"'")],
    "cart_items": [("l_partkey % 87 = 7", "'\"oops\"'")],
}
ABSENT = {"rating": "k % 103 = 9", "name": "c = 0 AND k % 109 = 13"}
COPIES = {"products": "k % 71 = 5", "users": "k % 97 = 11", "carts": "k % 127 = 5"}


def _case(options: list[tuple[str, str]], default: str) -> str:
    if not options:
        return default
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in options) + f" ELSE {default} END"


def token(entity: str, path: str) -> str:
    options, default = FIELDS[entity][path]
    return _case([(c, t) for c, t, _ in options], default)


def _object(entity: str, prefix: str = "") -> str:
    """SQL that puts the tokens below a prefix into one JSON object."""
    seen, parts = [], []
    for path in FIELDS[entity]:
        if not path.startswith(prefix):
            continue
        name = path[len(prefix):].split(".")[0]
        if name in seen:
            continue
        seen.append(name)
        inner = path != prefix + name
        value = _object(entity, f"{prefix}{name}.") if inner else token(entity, path)
        if inner and name in ABSENT:
            value = f"CASE WHEN {ABSENT[name]} THEN null ELSE {value} END"
        parts.append(f"'\"{name}\":' || ({value})")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def record(entity: str) -> str:
    return _case(SHAPES[entity], _object(entity))


def shapeless(entity: str) -> str:
    return " OR ".join(f"({c})" for c, _ in SHAPES[entity])


def expected_reasons(entity: str) -> list[str]:
    """Per field the SQL of its expected reason, null where the field is fine."""
    out = []
    for options, _ in FIELDS[entity].values():
        if any(r for _, _, r in options):
            out.append(_case([(c, f"'{r}'" if r else "null") for c, _, r in options], "null"))
    return out


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_partkey"]

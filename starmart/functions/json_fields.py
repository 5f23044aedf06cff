"""Type-faithful reading of JSON fields through VARIANT.

A rule has to tell the number 5 from the text "5" and true from 1, which an inferred struct
loses. So every field keeps the type of its JSON token next to its text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from starmart.functions.text import is_space, lstrip, strip
from starmart.functions.values import iso_timestamp
from starmart.rules import Rule

# What counts as a number when it comes as text.
NUMBER_TEXT = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\z"


def is_object(variant: Column, text: Column) -> Column:
    """Valid JSON is an object exactly when it opens with a brace; the schema of a large record costs more."""
    return variant.isNotNull() & lstrip(text).startswith("{")


class Field:
    """One rule applied to one field.

    The work is laid out in steps, each a set of columns over the one before: raw parts, then
    what they are, then the typed value, then the messages. So no test repeats another's work,
    and all of it stays in generated code.
    """

    def __init__(self, rule: Rule, flattened: bool):
        self.rule = rule
        # a flattened record has no objects left at its fields, so an object there is a missing field
        self.object_is_blank = "OBJECT<" if flattened else "OBJECT<>"

    def _col(self, part: str) -> Column:
        return F.col(f"{self.rule.name}__{part}")

    def part(self, variant: Column) -> dict[str, Column]:
        """What the record holds at the rule's path, and the type of its token."""
        found = F.variant_get(variant, self.rule.path, "variant")
        token = F.schema_of_variant(found)
        if self.rule.kind == "list":
            # only a list with entries has a first one; it need not be looked through
            has_first = F.variant_get(variant, f"{self.rule.path}[0]", "variant").isNotNull()
            token = F.when(has_first, "ARRAY").otherwise(token)
        return {f"{self.rule.name}__part": found, f"{self.rule.name}__token": token}

    def text(self) -> dict[str, Column]:
        """The token's text; an empty list is the text [], other lists keep none. A whole number's JSON is its text, and costs a fraction
        of a cast, which sets itself up for every value."""
        part, token = self._col("part"), self._col("token")
        text = F.try_variant_get(part, "$", "string")
        if self.rule.kind == "list":
            text = F.when(token != "ARRAY", text)
        if self.rule.kind in ("int", "float"):
            text = F.when(token == "BIGINT", F.to_json(part)).otherwise(text)
        return {f"{self.rule.name}__text": text}

    def kinds(self) -> dict[str, Column]:
        """Whether the field is blank, and what its text says as a number or an instant."""
        kind, token, text = self.rule.kind, self._col("token"), self._col("text")
        is_text = token == "STRING"
        empty = (is_text & is_space(text)) | (token.startswith("ARRAY") & (text == "[]"))
        blank = token.isNull() | (token == "VOID") | token.startswith(self.object_is_blank) | empty
        out = {f"{self.rule.name}__blank": F.coalesce(blank, F.lit(False))}
        is_number = token.isin("BIGINT", "DOUBLE", "FLOAT") | token.startswith("DECIMAL")
        if kind in ("int", "float"):
            digits = F.when(is_number, text).when(is_text & strip(text).rlike(NUMBER_TEXT), strip(text))
            out[f"{self.rule.name}__digits"] = digits
        if kind == "datetime":
            out[f"{self.rule.name}__stamp"] = F.when(is_text | is_number, iso_timestamp(text))
        return out

    def numbers(self) -> dict[str, Column]:
        if self.rule.kind not in ("int", "float"):
            return {}
        return {f"{self.rule.name}__number": self._col("digits").try_cast("double")}

    def value(self) -> Column:
        """The typed value, null when the token does not fit the rule's type or the field is blank."""
        kind, token, text = self.rule.kind, self._col("token"), self._col("text")
        if kind in ("int", "float"):
            number = self._col("number")
            if kind == "float":
                return F.when(F.abs(number) < F.lit(float("inf")), number)
            exact = self._col("digits").try_cast("decimal(38,0)").try_cast("bigint")
            small = F.abs(number) < float(1 << 53)
            return F.when(number == F.floor(number), F.when(small, number.cast("bigint")).otherwise(exact))
        if kind == "datetime":
            return F.when(self._col("stamp").isNotNull(), text)
        if kind == "list":
            return F.when(token.startswith("ARRAY"), F.lit(True))
        return F.when(token == "STRING", text)

    def reasons(self) -> list[Column]:
        """One message or null per test, in the order in which they are reported."""
        rule, value, present = self.rule, F.col(self.rule.name), ~self._col("blank")
        out = []
        if rule.required:
            out.append(F.when(~present, f"missing_required:{rule.name}"))
        out.append(F.when(present & value.isNull(), f"invalid_type:{rule.name}(expected {rule.kind})"))
        for sign, bound, broken in (
            (">", rule.above, lambda b: value <= b),
            (">=", rule.at_least, lambda b: value < b),
            ("<=", rule.at_most, lambda b: value > b),
        ):
            if bound is not None:
                out.append(F.when(present & broken(bound), f"out_of_range:{rule.name}(must be {sign} {bound})"))
        if rule.pattern:
            out.append(F.when(present & ~strip(value).rlike(rule.pattern), f"invalid_format:{rule.name}"))
        return out

"""Columns out of JSON documents: one parse per row, then typed paths."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.functions.normalize import quoted
from lakeferry.functions.times import zoned_text

_PARSED = "__document"


@dataclass(frozen=True)
class JsonField:
    """One output column. The first of ``paths`` that gives a value wins.

    Kinds: ``document`` (JSON text, strings keep their quotes), ``text``,
    ``numeric``, ``boolean``, ``integer``, ``timestamp`` and ``texts`` (array).
    """

    name: str
    paths: tuple[str, ...]
    kind: str = "document"


# Spark types of the cast kinds.
_CASTS = {"numeric": "decimal(38,9)", "integer": "bigint"}
_NUMBERS = {"numeric": r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$", "integer": r"^\s*[+-]?\d+\s*$"}
_CHECKED = ("numeric", "integer", "boolean", "timestamp")


def document_at(document: Column, path: str) -> Column:
    """JSON text at a path of a parsed document; a JSON null counts as missing.

    Keys are in alphabetical order and numbers in their shortest form.
    """
    value = document if path == "$" else F.try_variant_get(document, path, "variant")
    return F.when(~F.is_variant_null(value), F.to_json(value))


def is_nested(document: Column) -> Column:
    """Is a parsed value an object or an array?"""
    return F.schema_of_variant(document).rlike("^(OBJECT|ARRAY)")


def text_at(document: Column, path: str) -> Column:
    """Plain text of a scalar at a path; null for objects and arrays."""
    value = document if path == "$" else F.try_variant_get(document, path, "variant")
    return F.when(~is_nested(value), F.try_variant_get(value, "$", "string"))


def any_text(document: Column, path: str) -> Column:
    """Text of a value at a path; JSON text for objects and arrays."""
    return F.try_variant_get(document, path, "string")


def texts_at(document: Column, path: str) -> Column:
    """Array of the scalars at a path; null when the value is not an array of scalars."""
    items = F.try_variant_get(document, path, "array<variant>")
    return F.when(~F.exists(items, is_nested), F.transform(items, lambda x: F.try_variant_get(x, "$", "string")))


def lenient_timestamp(text: Column) -> Column:
    """Timestamp from ISO text or from text like ``Tue, 05 Mar 2024 10:11:12 GMT``; else null.

    Text without a zone is UTC, whatever the session zone is.
    """
    iso = text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}")
    zoned = zoned_text(text)
    # the weekday is cut off because Spark does not read weekday names
    mail = F.regexp_extract(text, r"^\s*[A-Za-z]{3},\s*(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} \S+)\s*$", 1)
    return F.coalesce(
        F.when(iso, zoned.try_cast("timestamp")),
        F.when(mail != "", F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss z"))),
    )


def typed(value: Column, kind: str) -> Column:
    """Value of a field kind from its text; null when the text does not fit.

    Text that is no number is sorted out before the cast, because a failing cast is slow.
    """
    if kind == "timestamp":
        return lenient_timestamp(value)
    if kind == "boolean":
        flag = F.lower(value)
        return F.when(flag.isin("true", "false"), flag == "true")
    if kind in _CASTS:
        return F.when(value.rlike(_NUMBERS[kind]), value.try_cast(_CASTS[kind]))
    return value


class _Leaves:
    """Struct types that fetch many paths of a parsed document in one lookup each.

    Paths that cannot share a struct (one leads through the other, or their keys
    differ in case only) go to different structs.
    """

    def __init__(self, prefix: str):
        self.prefix = prefix
        self.trees: list[dict] = []
        self.places: dict[str, int] = {}

    def add(self, path: str) -> None:
        if path in self.places:
            return
        steps = _steps(path)
        for number, tree in enumerate(self.trees):
            if _grafted(tree, steps):
                self.places[path] = number
                return
        self.trees.append({})
        _grafted(self.trees[-1], steps)
        self.places[path] = len(self.trees) - 1

    def structs(self, document: Column) -> list[Column]:
        return [
            F.try_variant_get(document, "$", self._type(tree)).alias(f"{self.prefix}{i}")
            for i, tree in enumerate(self.trees)
        ]

    def value(self, path: str) -> Column:
        column = F.col(f"{self.prefix}{self.places[path]}")
        for step in _steps(path):
            column = F.get(column, F.lit(step)) if isinstance(step, int) else column.getField(step)
        return column

    def _type(self, node: dict) -> str:
        if not node:
            return "variant"
        if any(isinstance(k, int) for k in node):
            items = [self._type(child) for child in node.values()]
            return f"array<{items[0]}>"
        return "struct<" + ", ".join(f"{quoted(k)}: {self._type(child)}" for k, child in node.items()) + ">"


_STEP = re.compile(r"""\.([^.\[\]'"\s]+)|\[(\d+)\]|\['([^']*)'\]|\["([^"]*)"\]""")


def _steps(path: str) -> list[str | int]:
    """Keys and list positions of a path such as ``$.a.b[0]`` or ``$['a b']``; any other text is refused."""
    steps: list[str | int] = []
    at = 1
    while path.startswith("$") and at < len(path):
        step = _STEP.match(path, at)
        if step is None:
            break
        key, index, single, double = step.groups()
        steps.append(int(index) if index is not None else next(k for k in (key, single, double) if k is not None))
        at = step.end()
    if not path.startswith("$") or at < len(path):
        raise ValueError(f"no JSON path: {path}")
    return steps


def _grafted(tree: dict, steps: list[str | int]) -> bool:
    """Add a path to a tree, unless it cannot share the tree's struct type."""
    node = tree
    for i, step in enumerate(steps):
        if step not in node:
            fresh = i == 0 or bool(node)
            taken = any(isinstance(k, int) or isinstance(step, int) or k.lower() == step.lower() for k in node)
            if not fresh or taken:
                return False
            for rest in steps[i:]:
                node = node.setdefault(rest, {})
            return True
        node = node[step]
    return False


def project_json(
    df: DataFrame, column: str, fields: Sequence[JsonField], rejects: str | None = None
) -> DataFrame:
    """Add one column per field from the JSON text in ``column``.

    The text is parsed once, all paths are fetched together, and the casts come after
    that. A value that does not fit its type becomes null; with ``rejects`` the names
    of such fields are listed in an extra array column, and the name of ``column`` itself
    where the text could not be read at all.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    document = F.col(_PARSED)
    leaves = _Leaves(f"{_PARSED}_part")
    for f in fields:
        for path in f.paths:
            if path != "$":
                leaves.add(path)
    readers = {"document": document_at, "texts": texts_at, "text": text_at}

    # the text of an object or array fits none of the other kinds, so a single path needs no check
    reader_of = {f.name: readers.get(f.kind, any_text if len(f.paths) == 1 else text_at) for f in fields}
    read: dict = {}
    for f in fields:
        for path in f.paths:
            read.setdefault(reader_of[f.name], {}).setdefault(path, len(read.get(reader_of[f.name], {})))

    def all_read(reader, paths: dict[str, int]) -> Column:
        """What a reader makes of all its paths, as one array: one expression instead of one for each path."""
        parts = [document if path == "$" else leaves.value(path) for path in paths]
        return F.transform(F.array(*parts), lambda part: reader(part, "$")).alias(f"{_PARSED}_{reader.__name__}")

    def value(field: JsonField, path: str) -> Column:
        reader = reader_of[field.name]
        return F.get(F.col(f"{_PARSED}_{reader.__name__}"), F.lit(read[reader][path]))

    found = [F.coalesce(*[value(f, p) for p in f.paths]).alias(f"{_PARSED}_{f.name}") for f in fields]
    values = {f.name: F.col(f"{_PARSED}_{f.name}") for f in fields}
    added = [typed(values[f.name], f.kind).alias(f.name) for f in fields]
    parsed = df.withColumn(_PARSED, F.try_parse_json(F.col(column)))
    fetched = parsed.select(*kept, document, *leaves.structs(document))
    unread = F.when(F.col(column).isNotNull() & document.isNull(), F.lit(column)).alias(f"{_PARSED}_unread")
    texts = fetched.select(*kept, unread, *[all_read(reader, paths) for reader, paths in read.items()])
    rows = texts.select(*kept, *found, F.col(f"{_PARSED}_unread"))
    if rejects is None:
        return rows.select(*kept, *added)
    checked = [f for f in fields if f.kind in _CHECKED]
    bad = [
        F.when(values[f.name].isNotNull() & typed(values[f.name], f.kind).isNull(), F.lit(f.name)) for f in checked
    ]
    bad.append(F.col(f"{_PARSED}_unread"))
    none = F.array(F.lit(None).cast("string"))
    return rows.select(*kept, *added, F.array_except(F.array(*bad), none).alias(rejects))


# Documents under $.data of a credit policy document (output column: key).
POLICY_DOCUMENTS = {
    "rdm": "Rdm",
    "kalp": "Kalp",
    "limit": "Limit",
    "pricing": "Pricing",
    "request_schema": "Request",
    "request": "request",
    "capacity": "Capacity",
    "customer": "Customer",
    "response_schema": "Response",
    "uc_lookup": "UCLookup",
    "response": "response",
    "pep_screen": "PepScreen",
    "rejection": "Rejection",
    "decisions": "decisions",
    "reverselookup": "ReverseLookup",
    "current_pricing": "CurrentPricing",
    "internal_lookup": "InternalLookup",
    "sanction_screen": "SanctionScreen",
    "customer_matcher": "CustomerMatcher",
    "suggested_pricing": "SuggestedPricing",
    "new_customer_policy": "NewCustomerPolicy",
    "new_customer_scoring": "NewCustomerScoring",
    "returning_customer_scoring": "ReturningCustomerScoring",
    "scoring": "Scoring",
    "returning_customer_policy": "ReturningCustomerPolicy",
    "primary_credit_criteria": "PrimaryCreditCriteria",
    "labelling_reject_reasons": "labelling_reject_reasons",
    "labelling_warning_reasons": "labelling_warning_reasons",
    "labelling_auto_reject_reasons": "labelling_auto_reject_reasons",
    "asiakastieto_lookup": "AsiakastietoLookup",
    "asiakastieto_ccis_lookup": "AsiakastietoCcisLookup",
    "kalp_new": "KalpNew",
    "customer_policy": "CustomerPolicy",
    "customer_matcher_schufa_id": "CustomerMatcherSchufaId",
    "sc_lookup": "SCLookup",
    "crif_buergel_lookup": "CRIFBuergelLookup",
}

# Typed columns of a credit policy document.
POLICY_VALUES = (
    JsonField("exposure", ("$.data.InternalLookup.exposure",), "numeric"),
    JsonField("loan_balance", ("$.data.request.loanBalance",), "numeric"),
    JsonField("is_returning", ("$.data.Customer.returning",), "boolean"),
    JsonField("uc_credit_used_blanco", ("$.data.UCLookup.credit_history[0].credit_used_blanco",), "integer"),
    JsonField("uc_credit_used_account", ("$.data.UCLookup.credit_history[0].credit_used_account",), "integer"),
    JsonField("uc_credit_used_instalment", ("$.data.UCLookup.credit_history[0].credit_used_instalment",), "integer"),
    JsonField("uc_created_at", ("$.data.UCLookup._ts",), "timestamp"),
    JsonField("response_reasons", ("$.data.response.reasons",), "texts"),
    JsonField("customer_provided_income_gross", ("$.data.InternalLookup.customer_provided_income_gross",)),
    JsonField("new_monthly_payment", ("$.data.Pricing.new.monthlyPayment",), "text"),
    JsonField("old_monthly_payment", ("$.data.Pricing.old.monthlyPayment",), "text"),
    JsonField("scorecard_version", ("$.response.scorecard_version",), "text"),
    JsonField("internal_lookup_id", ("$.data.InternalLookup._id",), "integer"),
    JsonField("suggested_limit", ("$.data.Limit.limit", "$.data.Limit.suggested_limit")),
    JsonField("customer_type", ("$.data.Limit.limit_source", "$.data.Limit.customer_type"), "text"),
    JsonField("asiakastieto_lookup_id", ("$.data.AsiakastietoLookup._id",)),
    JsonField("asiakastieto_ccis_lookup_id", ("$.data.AsiakastietoCcisLookup._id",)),
    JsonField("schufa_lookup_id", ("$.data.SCLookup._id",)),
    JsonField("crif_buergel_lookup_id", ("$.data.CRIFBuergelLookup._id",)),
)

POLICY_FIELDS = (
    tuple(JsonField(name, (f"$.data.{key}",)) for name, key in POLICY_DOCUMENTS.items()) + POLICY_VALUES
)
